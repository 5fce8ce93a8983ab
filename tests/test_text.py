import re

from pyspark.sql import functions as F

from skeinworks.functions import queries as Q, text as T
from skeinworks.operators.lexical import synonym_expansion, triggered_expansion


def one(spark, col, **values):
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(col.alias("x")).first()["x"]


def test_redaction(spark):
    cases = {
        "Ph: 555-123-4567. SSN: 123-45-6789. Claim": "Ph: [REDACTED_PHONE]. SSN: [REDACTED_SSN]. Claim",
        "  No \n PII.  ": "No PII.",
        "1555-123-45678": "1555-123-45678",
    }
    for raw, want in cases.items():
        assert one(spark, T.redact_pii("t"), t=raw) == want


def test_clean_text_keeps_letters_of_any_language(spark):
    assert one(spark, T.clean_text("t"), t=" Größe #1: ¡año «x»! ") == "Größe 1: año x!"


def test_overlap_similarity_matches_the_formula(spark):
    a, b = "the cat sat", "The cat ran off"
    x, y = set(a.lower().split()), set(b.lower().split())
    want = 0.4 * len(x & y) / len(x | y) + 0.6 * len(x & y) / len(y)
    assert abs(one(spark, T.overlap_similarity("a", "b"), a=a, b=b) - want) < 1e-12
    assert one(spark, T.overlap_similarity("a", "b"), a="", b="x") == 0.0


def test_topics_and_intent(spark):
    assert one(spark, T.topic_labels("t"), t="A study of software for the school doctor") == [
        "technology", "science", "health",
    ]
    got = one(spark, T.intent("t"), t="How many in total? count them")
    assert got["intent"] == "aggregation" and abs(got["confidence"] - 3 / 7) < 1e-12
    assert tuple(one(spark, T.intent("t"), t="xyz")) == ("factual", 0.5)


def test_survey_sentence_leaves_out_nulls(spark):
    d = spark.createDataFrame([(7, 4.0, 5, None, "")], "id int, s double, p int, a string, c string")
    x = d.select(T.survey_sentence("id", "s", product="p", area="a", comments="c").alias("x")).first()["x"]
    assert x == "Customer 7 was satisfied overall with their experience. They rated the product 5/5. "


def test_form_fields(spark):
    form = (
        "\nFull Name: Ann Lee\nPolicy Number: POL-12\nDate of Incident: 2024-02-03\n"
        "Estimated Repair Cost (Claim Amount): $9,099.70\n\nDESCRIPTION OF INCIDENT\n-----------------------\n"
        "A tree fell.\n\n-----------------------\nEnd"
    )
    r = one(spark, T.form_fields("t"), t=form)
    assert (r["claimant_name"], r["policy_number"], r["claim_amount"]) == ("Ann Lee", "POL-12", 9099.7)
    assert str(r["incident_date"]) == "2024-02-03" and r["description"] == "A tree fell."
    empty = one(spark, T.form_fields("t"), t="nothing here")
    assert empty["claim_amount"] is None and empty["incident_date"] is None


def test_parsed_json_keeps_what_does_not_parse(spark):
    schema = "score double, factors array<string>"
    good = one(spark, T.parsed_json("t", schema), t='{"score": 0.5, "factors": ["a"]}')
    assert good["ok"] and good["value"]["score"] == 0.5 and good["raw"] is None
    bad = one(spark, T.parsed_json("t", schema), t="not json")
    assert not bad["ok"] and bad["raw"] == "not json"


def test_topics_lower_the_text_once(spark):
    d = spark.createDataFrame([(1, "AI Software and RESEARCH"), (2, ""), (3, None)], "id int, t string").select("id", T.topic_labels("t").alias("x"))
    assert d._jdf.queryExecution().analyzed().toString().count("lower(t#") == 1
    assert {r["id"]: r["x"] for r in d.collect()} == {1: ["technology", "science"], 2: [], 3: []}


def test_term_counts(spark):
    d = spark.createDataFrame([(1, "b a b c a b"), (2, "")], "id int, t string").withColumn("w", T.words("t"))
    got = {r["id"]: {x["term"]: x["tf"] for x in r["tc"]} for r in T.term_counts(d, "w", "tc").collect()}
    assert got == {1: {"a": 2, "b": 3, "c": 1}, 2: {}}


def test_expansions(spark):
    assert one(spark, synonym_expansion(F.col("t")), t="Libro de bautismo") == (
        "libro de bautismo registro documento bautizo sacramento"
    )
    assert one(spark, triggered_expansion(F.col("t")), t="python data") == sorted(
        ["python data", "programming", "coding", "development", "dataset", "information", "analytics"]
    )


def test_query_forms(spark):
    def q(f, t):
        return one(spark, f(F.col("t")), t=t)

    assert q(Q.normalise, "Bautiso en yglesia de Sn Juan, 1600s") == "bautizo en iglesia de San Juan, siglo XVII"
    assert q(Q.to_statement, "¿Dónde fue Juan Pérez?") == "lugar de Juan Pérez"
    assert q(Q.to_statement, "who was Ana?") == "Ana"
    assert q(Q.with_context, "libros") == "libros en registros de bautismo colonial"
    assert q(Q.with_context, "período colonial x") == "período colonial x"
    assert q(Q.is_complex, "uno y dos") and not q(Q.is_complex, "solo uno")
    assert [s["query"] for s in q(Q.decompose, "Who? Where?")] == ["Who?", "Where?"]
    assert [s["query"] for s in q(Q.decompose, "find it and then count")] == ["find it", "count"]
    got = one(spark, Q.listed_subqueries(F.col("g"), F.col("o")), g="Sure:\n1. First\n2) Then with it\n- usando esto", o="x")
    assert [(r["query"], r["dependent"]) for r in got] == [("First", False), ("Then with it", True), ("usando esto", True)]
    assert q(lambda c: Q.variations(c), "libro") == [
        "libro", "libro registro documento", "libro en registros de bautismo colonial",
    ]


def test_entities_ignore_case(spark):
    text = "ana maria vio a San Juan en 1650, padre Luis"
    want = list(dict.fromkeys(re.findall(r"[A-Z][a-zá-ú]+ [A-Z][a-zá-ú]+", text, re.IGNORECASE)))
    assert one(spark, T.entities("t", "names"), t=text) == want
    assert one(spark, T.entities("t", "dates"), t=text) == ["1650"]
