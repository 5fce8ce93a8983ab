import re

from pyspark.sql import functions as F

from llm.pseudonyms import KINDS, _permuted, op3_pseudonyms, pseudonymised
from tests.llm.conftest import SF


def luhn(s):
    return sum(sum(divmod(int(c) * 2, 10)) if k % 2 else int(c) for k, c in enumerate(reversed(s))) % 10 == 0


def test_it_is_a_permutation(spark):
    a, b = F.lit(7).cast("long"), F.lit(11).cast("long")
    got = [r[0] for r in spark.range(77).select(_permuted(F.col("id"), a, b, F.lit("k"), "t")).collect()]
    assert sorted(got) == list(range(77)) and got != list(range(77))


def test_formats_links_and_validity(spark):
    text = "a bob.x1@mail8.example.com, 4041894974608795 then 12.197.240.125 and +1 (784) 555-8120 or 784-555-8120. 2020-02-29 2021-02-31 123-45-6789 4041-8949-7460-8795 4041894974608796 v1.2.3 end"
    docs = spark.createDataFrame([(1, text), (2, f"again {text}")], "doc_id long, text string")
    one, two = (r.text for r in pseudonymised(docs, "k").orderBy("doc_id").collect())
    assert two == f"again {one}" and len(one) >= len(text) - 12
    for old in ("bob.x1@", "4041894974608795", "12.197.240.125", "784", "2020-02-29", "123-45-6789", "4041-8949"):
        assert old not in one
    assert "2021-02-31" in one and "4041894974608796" in one and "v1.2.3 end" in one
    card, spaced = re.search(r"(?<!\d)\d{16}(?!\d)", one)[0], re.search(r"\d{4}-\d{4}-\d{4}-\d{4}", one)[0]
    assert luhn(card) and spaced.replace("-", "") == card
    first, second = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4})", one).groups(), re.search(r"or (\d{3})-(\d{3})-(\d{4})\.", one).groups()
    assert first == second and first[0][0] in "23456789"
    assert pseudonymised(docs, "other").first().text != one
    assert set(pseudonymised(docs, "k").first().private) == set(KINDS)


def test_values_beside_other_digits(spark):
    card = "4111 1111 1111 1111"
    texts = [f"{card} 12/27", f"{card} 123", f"12 {card}", f"1234567 {card} 99", f"{card} 10.20.30.40", f"{card} 2020-02-29 {card}", "call 555-123-4567 2025", "+1-555-123-4567", "1-555-123-4567", "+15551234567", "4041894974608796 12", " ".join(["1000"] * 60) + f" {card}"]
    kinds = [["card"]] * 4 + [["card", "ip"], ["card", "date"]] + [["phone"]] * 4 + [[], ["card"]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r for r in pseudonymised(docs, "k").orderBy("doc_id").collect()]
    for r, old, want in zip(got, texts, kinds, strict=True):
        assert set(want) == set(r.private), (old, r)
        assert re.sub(r"\d", "0", r.text.split(".")[0]) == re.sub(r"\d", "0", old.split(".")[0]) or "ip" in want
        for value in (card, "10.20.30.40", "2020-02-29", "555-123-4567", "5551234567"):
            assert value not in r.text
    assert got[5].private == {"card": 2, "date": 1} and got[0].text.endswith(" 12/27") and got[2].text.startswith("12 ") and got[10].text == texts[10]
    assert got[7].text[3:] == got[8].text[2:] and got[9].text[2:] == re.sub(r"\D", "", got[8].text[2:])


def test_values_of_the_documents_are_gone(spark):
    old = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    pattern = re.compile("|".join(KINDS[k] for k in ("email", "ip", "phone")))
    for r in op3_pseudonyms(spark, "/root/testdata/sf0.01").collect():
        found = set(pattern.findall(old[r.doc_id]))
        assert not [v for v in found if v in r.text]
        assert (r.text == old[r.doc_id]) == (not any(r[f"n_{k}"] for k in KINDS))
    assert SF


def test_odd_rows(spark, odd, none):
    got = pseudonymised(odd, "k").collect()
    assert len(got) == 9 and sorted(str(r.text) for r in got) == sorted(str(r.text) for r in odd.collect()) and all(r.private == {} for r in got)
    assert pseudonymised(none, "k").count() == 0
