"""Queries on cleaning, labelling and chunking text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv, text as T
from ..operators import chunking as C
from . import views as V
from .registry import documents, query, table

SP = fv.SPACE.replace("'", "''")


def sql_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{SP}+'), lambda w: w <> '')"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SP}+|{SP}+$', '', 'g')"


def sql_collapse(x: str) -> str:
    return sql_strip(f"regexp_replace({x}, '{SP}+', ' ', 'g')")


def sql_hits(low: str, kws: list[str]) -> str:
    return " + ".join(f"CASE WHEN contains({low}, '{k}') THEN 1 ELSE 0 END" for k in kws)


SQL_REDACT = sql_collapse(
    f"regexp_replace(regexp_replace(raw_text, '{fv.SSN}', '{fv.SSN_MARK}', 'g'), '{fv.PHONE}', '{fv.PHONE_MARK}', 'g')"
)
SQL_CLEAN = sql_strip(
    f"regexp_replace(regexp_replace(text, '{SP}+', ' ', 'g'), '[^\\p{{L}}\\p{{N}}_ .,!?;:\\-''\"]', '', 'g')"
)


@query("text_redact_pii", V.with_views("claims") + f"SELECT claim_id, {SQL_REDACT} AS redacted FROM claims")
def _(spark, sf):
    return V.claims(spark, sf).select("claim_id", T.redact_pii("raw_text").alias("redacted"))


@query("text_clean", f"SELECT doc_id, md5({SQL_CLEAN}) AS cleaned_md5, length({SQL_CLEAN}) AS n FROM documents")
def _(spark, sf):
    c = T.clean_text("text")
    return documents(spark, sf).select("doc_id", F.md5(c).alias("cleaned_md5"), F.length(c).alias("n"))


@query(
    "text_document_metrics",
    f"""WITH m AS (SELECT doc_id, text, length(text) AS character_count, len({sql_words("text")}) AS word_count,
          length(regexp_replace(text, '{SP}', '', 'g')) AS letters FROM documents)
    SELECT doc_id, character_count, word_count, CAST(floor(word_count / 0.75::DOUBLE) AS BIGINT) AS estimated_tokens,
      round(letters / greatest(word_count, 1), 9) AS avg_word_length,
      regexp_matches(text, '\\p{{Nd}}') AS has_numbers,
      contains(lower(text), 'http') OR contains(lower(text), 'www.') AS has_urls,
      CASE WHEN letters / greatest(word_count, 1) < 4 THEN 'basic'
           WHEN letters / greatest(word_count, 1) < 6 THEN 'intermediate' ELSE 'advanced' END AS reading_level
    FROM m""",
)
def _(spark, sf):
    d = T.document_metrics(documents(spark, sf).select("doc_id", "text")).drop("text")
    return d.withColumn("avg_word_length", F.round("avg_word_length", 9))


def sql_topics() -> str:
    items = ", ".join(
        f"{{'hits': {sql_hits('lower(text)', k)}, 'pos': {-i}, 'topic': '{t}'}}"
        for i, (t, k) in enumerate(fv.TOPIC_KEYWORDS.items())
    )
    return f"""SELECT doc_id, coalesce(array_to_string(list_transform(list_slice(list_sort(
        list_filter([{items}], lambda s: s.hits > 0), 'DESC'), 1, 3), lambda s: s.topic), ','), '') AS topics
      FROM documents"""


@query("text_topic_labels", sql_topics())
def _(spark, sf):
    return documents(spark, sf).select("doc_id", F.array_join(T.topic_labels("text"), ",").alias("topics"))


@query(
    "text_path_facts",
    """WITH p AS (SELECT page_id, regexp_replace(url, '^[a-z]+:/', '') || CASE page_id % 5 WHEN 0 THEN '/technical/' WHEN 1
         THEN '/research/' WHEN 2 THEN '/policies/' WHEN 3 THEN '/reddit/' ELSE '/misc/' END || 'Page.HTML' AS path FROM pages)
    SELECT page_id, CASE WHEN contains(path, '/technical/') THEN 'technical_docs' WHEN contains(path, '/research/')
        THEN 'research_papers' WHEN contains(path, '/policies/') THEN 'policies' WHEN contains(path, '/reddit/')
        THEN 'reddit_data' ELSE 'general' END AS category,
      CASE WHEN contains(path, '.') THEN lower(string_split(path, '.')[-1]) ELSE 'unknown' END AS file_type,
      translate(path, '/.', '__') AS path_id FROM p""",
)
def _(spark, sf):
    seg = F.array(*[F.lit(s) for s in ("/technical/", "/research/", "/policies/", "/reddit/", "/misc/")])
    path = F.concat(
        F.regexp_replace("url", "^[a-z]+:/", ""), F.get(seg, (F.col("page_id") % 5).cast("int")), F.lit("Page.HTML")
    )
    d = table(spark, sf, "pages").select("page_id", T.path_facts(path).alias("f"))
    return d.select("page_id", "f.category", "f.file_type", F.col("f.doc_id").alias("path_id"))


_QC = f"""length(text) >= 10 AS min_length, regexp_matches(text, '(?i){fv.PRODUCT_PATTERN}') AS has_product_reference,
   regexp_matches(text, '(?i){fv.OPINION_PATTERN}') AS has_opinion,
   NOT regexp_matches(text, '(?i){fv.PROFANITY_PATTERN}') AS no_profanity, contains(text, '.') AS has_structure"""


@query(
    "text_quality_checks",
    f"""WITH q AS (SELECT doc_id, {_QC} FROM documents)
    SELECT *, (min_length::INT + has_product_reference::INT + has_opinion::INT + no_profanity::INT
      + has_structure::INT) / 5::DOUBLE AS quality_score FROM q""",
)
def _(spark, sf):
    return documents(spark, sf).select("doc_id", T.quality_checks("text").alias("q")).select("doc_id", "q.*")


_SURVEY_SQL = """survey AS (SELECT c_custkey AS customer_id,
    CASE c_nationkey % 6 WHEN 0 THEN 'Very Dissatisfied' WHEN 1 THEN 'Dissatisfied' WHEN 2 THEN 'Neutral'
      WHEN 3 THEN 'Satisfied' WHEN 4 THEN 'Very Satisfied' ELSE '3' END AS overall_satisfaction,
    1 + c_custkey % 5 AS product_rating,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS improvement_area,
    CASE WHEN c_acctbal > 5000 THEN c_name END AS comments FROM customer)"""


def survey(spark, sf):
    words = F.array(*[F.lit(w) for w in (*fv.RATING_VALUES, "3")])
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.get(words, (F.col("c_nationkey") % 6).cast("int")).alias("overall_satisfaction"),
        (1 + F.col("c_custkey") % 5).alias("product_rating"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("improvement_area"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_name")).alias("comments"),
    )


_RATING_SQL = """CASE overall_satisfaction WHEN 'Very Dissatisfied' THEN 1 WHEN 'Dissatisfied' THEN 2 WHEN 'Neutral' THEN 3
   WHEN 'Satisfied' THEN 4 WHEN 'Very Satisfied' THEN 5 ELSE TRY_CAST(overall_satisfaction AS DOUBLE) END"""


@query("text_survey_rating", f"WITH {_SURVEY_SQL} SELECT customer_id, CAST({_RATING_SQL} AS DOUBLE) AS rating FROM survey")
def _(spark, sf):
    return survey(spark, sf).select("customer_id", T.rating_value("overall_satisfaction").alias("rating"))


@query(
    "text_survey_sentence",
    f"""WITH {_SURVEY_SQL}, r AS (SELECT *, {_RATING_SQL} AS s FROM survey)
    SELECT customer_id, 'Customer ' || CAST(customer_id AS VARCHAR) || ' was ' || CASE WHEN s >= 4 THEN 'satisfied'
      WHEN s = 3 THEN 'neutral' ELSE 'dissatisfied' END || ' overall with their experience. '
      || 'They rated the product ' || CAST(product_rating AS VARCHAR) || '/5. '
      || coalesce('They suggested improvements in the area of ' || improvement_area || '. ', '')
      || coalesce('Their comments: ''' || comments || '''', '') AS summary FROM r""",
)
def _(spark, sf):
    return survey(spark, sf).select(
        "customer_id",
        T.survey_sentence(
            "customer_id", T.rating_value("overall_satisfaction"), product="product_rating",
            area="improvement_area", comments="comments",
        ).alias("summary"),
    )


_SURVEY_STATS = f"""WITH {_SURVEY_SQL}, r AS (SELECT *, {_RATING_SQL} AS s FROM survey WHERE customer_id IS NOT NULL)"""


@query(
    "survey_statistics",
    _SURVEY_STATS
    + """, issues AS (SELECT improvement_area AS k, count(*) AS n FROM r WHERE improvement_area IS NOT NULL
           GROUP BY 1 ORDER BY n DESC, k LIMIT 3)
    SELECT 'total_surveys' AS item, '' AS key, count(*)::DOUBLE AS value FROM r
    UNION ALL SELECT 'avg_satisfaction', '', round(avg(s), 9) FROM r
    UNION ALL SELECT 'satisfaction', CAST(CAST(s AS INT) AS VARCHAR), count(*)::DOUBLE FROM r GROUP BY s
    UNION ALL SELECT 'top_issue', k, n::DOUBLE FROM issues""",
)
def _(spark, sf):
    from ..operators import scoring as S

    d = survey(spark, sf).dropna(subset=["customer_id"]).withColumn("s", T.rating_value("overall_satisfaction"))
    return S.survey_statistics(d, rating="s", issue="improvement_area")


@query(
    "text_overlap_similarity",
    f"""WITH w AS (SELECT conv_id, turn, list_distinct({sql_words("lower(text)")}) AS a,
        list_distinct({sql_words("lower(lead(text) OVER (PARTITION BY conv_id ORDER BY turn))")}) AS b FROM conversations)
    SELECT conv_id, turn, round(CASE WHEN len(a) > 0 AND len(b) > 0 THEN 0.4::DOUBLE * len(list_intersect(a, b))
       / len(list_distinct(list_concat(a, b))) + 0.6::DOUBLE * len(list_intersect(a, b)) / len(b) ELSE 0 END, 6) AS similarity
    FROM w WHERE b IS NOT NULL""",
)
def _(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("following"))
    return c.join(nxt, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.round(T.overlap_similarity("text", "following"), 6).alias("similarity")
    )


@query(
    "text_assembled",
    """SELECT p_partkey AS id, p_name || '. ' || p_type AS item_text,
      'Question: ' || p_name || chr(10) || 'Answer: ' || p_brand AS training_text,
      CASE WHEN p_size > 25 THEN p_name || chr(10) || chr(10) || p_type ELSE p_name END AS post_text FROM part""",
)
def _(spark, sf):
    p = table(spark, sf, "part").withColumn("body", F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(""))
    return p.select(
        F.col("p_partkey").alias("id"),
        T.item_text("p_name", "p_type").alias("item_text"),
        T.training_text("p_name", "p_brand").alias("training_text"),
        T.post_text("p_name", "body").alias("post_text"),
    )


@query("text_content_key", "SELECT doc_id, md5(text) AS content_key FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", F.md5("text").alias("content_key"))


@query(
    "text_truncated",
    """SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS preview,
      length(CASE WHEN length(text) > 500 THEN substr(text, 1, 500) ELSE text END) AS n500,
      length(CASE WHEN length(text) > 2000 THEN substr(text, 1, 2000) ELSE text END) AS n2000 FROM documents""",
)
def _(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        T.truncate("text", 200, "...").alias("preview"),
        F.length(T.truncate("text", 500)).alias("n500"),
        F.length(T.truncate("text", 2000)).alias("n2000"),
    )


_FORM_SQL = """forms AS (SELECT c_custkey, chr(10) || 'INSURANCE CLAIM SUBMISSION FORM' || chr(10) || 'CLAIMANT DETAILS' || chr(10)
   || '----------------' || chr(10) || 'Full Name: ' || c_name || chr(10) || 'Policy Number: POL-' || CAST(c_custkey AS VARCHAR)
   || chr(10) || chr(10) || 'Date of Incident: 2024-03-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') || chr(10)
   || 'Estimated Repair Cost (Claim Amount): $9,' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '.70' || chr(10) || chr(10)
   || 'DESCRIPTION OF INCIDENT' || chr(10) || '-----------------------' || chr(10) || c_mktsegment || ' damage' || chr(10) || chr(10)
   || '-----------------------' || chr(10) || 'End of Document' AS form FROM customer)"""


def forms(spark, sf):
    key = F.col("c_custkey").cast("string")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(
            F.lit("\nINSURANCE CLAIM SUBMISSION FORM\nCLAIMANT DETAILS\n----------------\nFull Name: "),
            F.col("c_name"),
            F.lit("\nPolicy Number: POL-"),
            key,
            F.lit("\n\nDate of Incident: 2024-03-"),
            F.lpad((1 + F.col("c_custkey") % 28).cast("string"), 2, "0"),
            F.lit("\nEstimated Repair Cost (Claim Amount): $9,"),
            F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"),
            F.lit(".70\n\nDESCRIPTION OF INCIDENT\n-----------------------\n"),
            F.col("c_mktsegment"),
            F.lit(" damage\n\n-----------------------\nEnd of Document"),
        ).alias("form"),
    )


@query(
    "text_form_fields",
    f"""WITH {_FORM_SQL} SELECT c_custkey, trim(regexp_extract(form, 'Full Name: *([^\\n]*)', 1)) AS claimant_name,
      regexp_extract(form, '(POL-\\d+)', 1) AS policy_number,
      regexp_extract(form, 'Incident: (\\S+)', 1) AS incident_date,
      CAST(replace(regexp_extract(form, '\\$([\\d,.]+)', 1), ',', '') AS DOUBLE) AS claim_amount,
      regexp_extract(form, 'INCIDENT\\n-+\\n([^\\n]*)', 1) AS description FROM forms""",
)
def _(spark, sf):
    d = forms(spark, sf).select("c_custkey", T.form_fields("form").alias("f")).select("c_custkey", "f.*")
    return d.withColumn("incident_date", F.col("incident_date").cast("string"))


@query(
    "json_typed_or_raw",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 END AS score,
      CASE WHEN event_type = 'error' THEN 'broken ' || props END AS raw_text,
      event_type <> 'error' AS parsed,
      event_type <> 'error' AND CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 BETWEEN 0 AND 1 AS valid FROM events""",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("double") / 100
    doc = F.when(F.col("event_type") == "error", F.concat(F.lit("broken "), F.col("props"))).otherwise(
        F.to_json(
            F.struct(
                k.alias("fraud_probability_score"),
                F.array("event_type").alias("risk_factors"),
                F.lit("seen").alias("executive_summary"),
            )
        )
    )
    from ..operators import filters as P

    p = e.select("event_id", T.parsed_json(doc, P.RISK_SCHEMA).alias("p"))
    return p.select(
        "event_id",
        F.col("p.value.fraud_probability_score").alias("score"),
        F.col("p.raw").alias("raw_text"),
        F.col("p.ok").alias("parsed"),
        P.risk_result_valid(F.col("p")).alias("valid"),
    )


@query(
    "text_entities",
    "WITH x AS (SELECT doc_id, "
    + ", ".join(
        f"regexp_extract_all(text, '(?i){p}', 0) AS {k}_all" for k, p in fv.ENTITY_PATTERNS.items()
    )
    + " FROM documents) SELECT doc_id, "
    + ", ".join(
        f"len(list_distinct({k}_all)) AS n_{k}, coalesce({k}_all[1], '') AS first_{k}" for k in fv.ENTITY_PATTERNS
    )
    + " FROM x",
)
def _(spark, sf):
    d = documents(spark, sf)
    cols = []
    for k in fv.ENTITY_PATTERNS:
        e = T.entities("text", k)
        cols += [F.size(e).alias(f"n_{k}"), F.coalesce(F.get(e, 0), F.lit("")).alias(f"first_{k}")]
    return d.select("doc_id", *cols)


# ---- chunking -------------------------------------------------------------------------

_WW = f"""w AS (SELECT doc_id, text, {sql_words("text")} AS ws FROM documents),
  c AS (SELECT doc_id, text, ws, unnest(range(0, len(ws), 351)) AS s FROM w)"""


@query(
    "chunk_word_windows",
    f"""WITH {_WW}, k AS (SELECT doc_id, s // 351 AS chunk_index, CASE WHEN len(ws) <= 390 THEN text
         ELSE array_to_string(ws[s + 1 : s + 390], ' ') END AS t FROM c WHERE s = 0 OR len(ws) > 390)
    SELECT doc_id, chunk_index, md5(t) AS chunk_md5, length(t) AS chunk_length FROM k
    UNION ALL SELECT doc_id, 0, md5(text), length(text) FROM w WHERE len(ws) = 0""",
)
def _(spark, sf):
    d = C.word_windows(documents(spark, sf).select("doc_id", "text"))
    return d.select("doc_id", "chunk_index", F.md5("chunk_text").alias("chunk_md5"), F.length("chunk_text").alias("chunk_length"))


@query(
    "chunk_word_windows_strict",
    f"""WITH {_WW} SELECT doc_id, s // 351 AS chunk_index, md5(array_to_string(ws[s + 1 : s + 390], ' ')) AS chunk_md5 FROM c""",
)
def _(spark, sf):
    d = C.word_windows(documents(spark, sf).select("doc_id", "text"), keep_short_text=False)
    return d.select("doc_id", "chunk_index", F.md5("chunk_text").alias("chunk_md5"))


_SNAP = f"""WITH RECURSIVE c(doc_id, text, n, s, e) AS (
   SELECT doc_id, text, length(text), 0, e FROM (SELECT doc_id, text, @end0@ AS e FROM documents WHERE length(text) > 0)
   UNION ALL
   SELECT doc_id, text, n, s2, @end1@ FROM (SELECT doc_id, text, n, greatest(e - 100, s + 1) AS s2 FROM c
      WHERE e < n AND greatest(e - 100, s + 1) < n))
 SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS chunk_index, s AS start_pos, e AS end_pos,
   md5({sql_strip("substr(text, s + 1, e - s)")}) AS chunk_md5 FROM c WHERE {sql_strip("substr(text, s + 1, e - s)")} <> ''"""


def _snap_end(s: str, size: int = 1000) -> str:
    half = size // 2 + 1
    found = f"length(regexp_extract(substr(text, {s} + {half + 1}, {size - half + 1}), '^(.*[.?!]) ', 1, 's'))"
    return f"""CASE WHEN {s} + {size} >= length(text) THEN length(text)
       WHEN {found} > 0 THEN {s} + {half} + {found} ELSE {s} + {size} END"""


@query("chunk_sentence_windows", _SNAP.replace("@end0@", _snap_end("0")).replace("@end1@", _snap_end("s2")))
def _(spark, sf):
    d = C.sentence_windows(documents(spark, sf).select("doc_id", "text"))
    return d.select("doc_id", "chunk_index", "start_pos", "end_pos", F.md5("chunk_text").alias("chunk_md5"))


_TITLE = "regexp_replace(string_split({b}, chr(10))[1], '^#+|#+$', '', 'g')"
_SECT = (
    V.with_views("md_docs")
    + f""", a AS (SELECT doc_id, string_split(text, chr(10) || '## ') AS ss FROM md_docs),
  b AS (SELECT doc_id, unnest(ss) AS section, unnest(range(1, len(ss) + 1)) AS sn FROM a),
  b2 AS (SELECT doc_id, sn, section, string_split(section, chr(10) || '### ') AS subs FROM b WHERE {sql_strip("section")} <> ''),
  d AS (SELECT doc_id, sn, section, unnest(subs) AS body, unnest(range(0, len(subs))) AS sub FROM b2),
  f AS (SELECT doc_id, sn, sub, CASE WHEN sub = 0 THEN section ELSE body END AS body, section FROM d
        WHERE sub = 0 OR {sql_strip("body")} <> ''),
  g AS (SELECT doc_id, sn, sub, CASE WHEN sub = 0 THEN 'section' ELSE 'subsection' END AS level,
          {sql_strip(_TITLE.format(b="body"))} AS title,
          CASE WHEN sub > 0 THEN {sql_strip(_TITLE.format(b="section"))} END AS parent_section, md5(body) AS chunk_md5 FROM f)"""
)


@query(
    "chunk_sections",
    _SECT
    + """ SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sn, sub) - 1 AS chunk_index, level, title,
       parent_section, chunk_md5 FROM g""",
)
def _(spark, sf):
    d = C.sections(V.md_docs(spark, sf))
    return d.select("doc_id", "chunk_index", "level", "title", "parent_section", F.md5("chunk_text").alias("chunk_md5"))


@query(
    "chunk_sections_only",
    _SECT
    + """ SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sn) - 1 AS chunk_index, title, chunk_md5
       FROM g WHERE level = 'section'""",
)
def _(spark, sf):
    d = C.sections(V.md_docs(spark, sf), subsections=False)
    return d.select("doc_id", "chunk_index", "title", F.md5("chunk_text").alias("chunk_md5"))


@query("chunk_recursive")
def _(spark, sf):
    return C.recursive_windows(documents(spark, sf).select("doc_id", "text"), size=1000, overlap=150)


@query(
    "chunk_coarse_sections",
    """WITH c AS (SELECT doc_id, text, unnest(CASE WHEN length(text) > 4000 THEN range(0, length(text), 3500) ELSE [0] END) AS s
        FROM documents)
    SELECT doc_id, s // 3500 AS section_index, md5(CASE WHEN length(text) > 4000 THEN substr(text, s + 1, 4000) ELSE text END)
      AS section_md5 FROM c""",
)
def _(spark, sf):
    d = C.coarse_sections(documents(spark, sf).select("doc_id", "text"))
    return d.select("doc_id", "section_index", F.md5("section_text").alias("section_md5"))


@query(
    "chunk_marked",
    f"""WITH m AS (SELECT doc_id, text, CASE WHEN n_chars % 7 = 0 THEN '---CHUNK---' ELSE
          replace(text, chr(10), chr(10) || '---CHUNK---') END AS g FROM documents),
     p AS (SELECT doc_id, text, list_filter(list_transform(string_split(g, '---CHUNK---'), lambda x: {sql_strip("x")}),
          lambda x: x <> '') AS parts FROM m),
     q AS (SELECT doc_id, CASE WHEN len(parts) > 0 THEN parts ELSE list_transform(range(0, length(text), 2000),
          lambda s: substr(text, s + 1, 2000)) END AS parts FROM p)
    SELECT doc_id, unnest(range(0, len(parts))) AS chunk_index, md5(unnest(parts)) AS chunk_md5 FROM q""",
)
def _(spark, sf):
    d = documents(spark, sf)
    g = F.when(F.col("n_chars") % 7 == 0, "---CHUNK---").otherwise(
        F.replace("text", F.lit("\n"), F.lit("\n---CHUNK---"))
    )
    out = C.marked_chunks(d.select("doc_id", "text", g.alias("g")), "g", "text")
    return out.select("doc_id", "chunk_index", F.md5("chunk_text").alias("chunk_md5"))


@query("chunk_semantic_fallback")
def _(spark, sf):
    return C.semantic_fallback(documents(spark, sf).select("doc_id", "text"))


@query(
    "chunk_claims",
    V.with_views("claims")
    + f"""SELECT claim_id, 0 AS chunk_index, claim_id || '_chunk_0' AS chunk_id,
      'Claim Context: ' || {SQL_REDACT} || chr(10) || 'Resolution Notes: ' || notes AS chunk_text
    FROM claims WHERE fraud_confirmed""",
)
def _(spark, sf):
    return C.claim_chunks(V.claims(spark, sf))


@query(
    "chunk_links",
    f"""WITH {_WW}, k AS (SELECT doc_id, s // 351 AS i, array_to_string(ws[s + 1 : s + 390], ' ') AS t, len(ws) AS n FROM c)
    SELECT doc_id, i AS chunk_index, CAST(doc_id AS VARCHAR) || '_chunk_' || CAST(i AS VARCHAR) AS chunk_id,
      count(*) OVER w AS total_chunks, i = 0 AS is_first_chunk, i = max(i) OVER w AS is_last_chunk,
      length(t) AS chunk_length, least(390, n - i * 351) AS chunk_word_count,
      CASE WHEN i > 0 THEN CAST(doc_id AS VARCHAR) || '_chunk_' || CAST(i - 1 AS VARCHAR) END AS previous_chunk_id,
      CASE WHEN i < max(i) OVER w THEN CAST(doc_id AS VARCHAR) || '_chunk_' || CAST(i + 1 AS VARCHAR) END AS next_chunk_id
    FROM k WINDOW w AS (PARTITION BY doc_id)""",
)
def _(spark, sf):
    d = C.word_windows(documents(spark, sf).select("doc_id", "text"), keep_short_text=False)
    return C.linked_chunks(d).drop("chunk_text")


@query(
    "chunk_page_markers",
    """SELECT conv_id, turn, chr(10) || '--- Page ' || CAST(turn + 1 AS VARCHAR) || ' ---' || chr(10) || text AS marked_text
    FROM conversations""",
)
def _(spark, sf):
    c = table(spark, sf, "conversations").withColumn("page", F.col("turn") + 1)
    return C.page_markers(c, "page", "text").select("conv_id", "turn", "marked_text")


@query(
    "chunk_pages_joined",
    """SELECT conv_id, md5(string_agg(chr(10) || '--- Page ' || CAST(turn + 1 AS VARCHAR) || ' ---' || chr(10) || coalesce(text, ''), '' ORDER BY turn, text)) AS text_md5
    FROM conversations GROUP BY 1""",
)
def _(spark, sf):
    """The pages of each document as one text, in order."""
    c = table(spark, sf, "conversations").withColumn("page", F.col("turn") + 1)
    return C.joined_pages(c, "conv_id", "page", "text").select("conv_id", F.md5("text").alias("text_md5"))


@query(
    "chunk_store_records",
    f"""WITH {_WW} SELECT 'word_' || CAST(s // 351 AS VARCHAR) AS chunk_id, doc_id AS document_id, 'word' AS strategy,
       md5(array_to_string(ws[s + 1 : s + 390], ' ')) AS text_md5, s // 351 AS chunk_index,
       '2024-01-31 00:00:00' AS created_at FROM c""",
)
def _(spark, sf):
    d = C.word_windows(documents(spark, sf).select("doc_id", "text"), keep_short_text=False)
    r = C.store_records(d, "word", created_at=F.lit("2024-01-31 00:00:00"))
    return r.select(
        "chunk_id", "document_id", "strategy", F.md5("text").alias("text_md5"), "metadata.chunk_index", "created_at"
    )
