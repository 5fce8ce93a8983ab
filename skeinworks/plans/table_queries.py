"""Queries on filters, joins, sorts, set operations, refresh, sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv, text as T
from ..operators import build as B, chunking as C, filters as P, joins as J, refresh as H, vector as VV
from ..session import fresh_folder
from ..sources import readers as RD, versions as VS, writers as W
from ..streaming import jobs as X
from . import views as V
from .registry import documents, query, table
from .text_queries import SP, SQL_CLEAN, SQL_REDACT, sql_collapse, sql_strip, sql_topics, sql_words

AS_OF = "TIMESTAMP_NTZ '2024-01-31 00:00:00'"


def as_of():
    return F.expr(AS_OF)


def _r(df, digits, *names):
    return df.select(*[F.round(c, digits).alias(c) if c in names else c for c in df.columns])


# ---- filters --------------------------------------------------------------------------


@query("filter_confirmed", V.with_views("claims") + "SELECT claim_id, notes FROM claims WHERE fraud_confirmed")
def _(spark, sf):
    return P.only_true(V.claims(spark, sf), "fraud_confirmed").select("claim_id", "notes")


@query("filter_not_null", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IS NOT NULL AND c_acctbal IS NOT NULL")
def _(spark, sf):
    return table(spark, sf, "customer").dropna(subset=["c_custkey", "c_acctbal"]).select("c_custkey", "c_name")


@query("filter_min_length", f"SELECT conv_id, turn FROM conversations WHERE length({sql_strip('text')}) >= 40")
def _(spark, sf):
    return P.min_length(table(spark, sf, "conversations"), "text", 40).select("conv_id", "turn")


@query("filter_min_length_raw", "SELECT doc_id, n_chars FROM documents WHERE length(text) >= 10")
def _(spark, sf):
    return P.min_length(documents(spark, sf), "text", stripped=False).select("doc_id", "n_chars")


@query("filter_metadata", "SELECT doc_id, lang, source FROM documents WHERE lang = 'fr' AND source IN ('src1', 'src2', 'src3')")
def _(spark, sf):
    d = P.metadata_filter(table(spark, sf, "documents"), {"lang": "fr", "source": ["src1", "src2", "src3"]})
    return d.select("doc_id", "lang", "source")


@query(
    "filter_best_scored",
    """SELECT event_id, score FROM (SELECT event_id, coalesce(CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INT) / 100::DOUBLE END, 0) AS score
    FROM events) WHERE score >= 0.5 ORDER BY score DESC, event_id LIMIT 10""",
)
def _(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int") / 100.0
    d = table(spark, sf, "events").select("event_id", F.when(F.col("event_type") != "error", k).alias("score"))
    return P.best_scored(d, "score", tie=["event_id"])


@query(
    "filter_look_back",
    """SELECT event_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 240 HOUR""",
)
def _(spark, sf):
    return P.look_back(table(spark, sf, "events"), "ts", as_of(), 240).select("event_id", "event_type")


@query("filter_past_retention", "SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY")
def _(spark, sf):
    return P.past_retention(table(spark, sf, "events"), "ts", as_of()).select("event_id")


@query(
    "filter_recent_with_notes",
    "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 24 MONTH AND o_orderpriority IS NOT NULL",
)
def _(spark, sf):
    at = F.expr("TIMESTAMP_NTZ '2001-08-01 00:00:00'")
    return P.recent_with_notes(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority", at).select("o_orderkey")


@query("project_columns", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS query_group_id FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("query_group_id"))


@query(
    "sample_by_hash",
    """SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)), 1, 8))::BIGINT % 1000 = 0""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return P.hash_sample(li.withColumn("k", key), "k").drop("k")


_REQ = """r AS (SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_name END AS claim_text,
   CASE WHEN c_acctbal < 0 THEN 'n/a' ELSE CAST(c_custkey AS VARCHAR) END AS claim_amount FROM customer)"""


def _requests(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(~(F.col("c_acctbal") > 9000), F.col("c_name")).alias("claim_text"),
        F.when(F.col("c_acctbal") < 0, "n/a").otherwise(F.col("c_custkey").cast("string")).alias("claim_amount"),
    )


@query(
    "validate_records",
    f"""WITH {_REQ} SELECT c_custkey, claim_text IS NOT NULL AND TRY_CAST(claim_amount AS DOUBLE) IS NOT NULL AS valid,
      concat_ws('; ', CASE WHEN claim_text IS NULL THEN 'claim_text missing' END,
        CASE WHEN TRY_CAST(claim_amount AS DOUBLE) IS NULL THEN 'claim_amount not a number' END) AS errors FROM r""",
)
def _(spark, sf):
    d = P.validated(_requests(spark, sf), ["c_custkey", "claim_text", "claim_amount"], ["claim_amount"])
    return d.select("c_custkey", "valid", F.array_join("errors", "; ").alias("errors"))


@query(
    "validate_rejects",
    f"WITH {_REQ} SELECT c_custkey FROM r WHERE claim_text IS NULL OR TRY_CAST(claim_amount AS DOUBLE) IS NULL",
)
def _(spark, sf):
    d = P.validated(_requests(spark, sf), ["c_custkey", "claim_text", "claim_amount"], ["claim_amount"])
    return d.where(~F.col("valid")).select("c_custkey")


_TRI = """t AS (SELECT o_orderkey, o_totalprice / 500000 AS score, o_orderstatus = 'F' AS confirmed FROM orders)"""


@query(
    "triage_precision",
    f"WITH {_TRI} SELECT count(*) AS flagged, count(*) FILTER (confirmed) AS confirmed, round(avg(confirmed::INT), 6) AS precision FROM t WHERE score >= 0.7",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select(
        (F.col("o_totalprice") / 500000).alias("score"), (F.col("o_orderstatus") == "F").alias("confirmed")
    )
    return _r(P.triage_precision(o, "score", "confirmed"), 6, "precision")


# ---- joins ----------------------------------------------------------------------------


@query(
    "join_resolve_ids",
    """SELECT e.vec_id AS id, length(d.text) AS chars, d.text IS NOT NULL AS resolved FROM embeddings e LEFT JOIN documents d
    ON d.doc_id = e.vec_id AND d.lang <> 'es'""",
)
def _(spark, sf):
    hits = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    store = documents(spark, sf).where("lang <> 'es'").select(F.col("doc_id").alias("id"), "text")
    return J.resolved_ids(hits, store).select("id", F.length("text").alias("chars"), "resolved")


@query(
    "join_unresolved_count",
    "SELECT count(*) AS unresolved FROM embeddings e WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = e.vec_id AND d.lang <> 'es')",
)
def _(spark, sf):
    hits = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    store = documents(spark, sf).where("lang <> 'es'").select(F.col("doc_id").alias("id"), "text")
    return J.unresolved_count(hits, store)


_BEST = """b AS (SELECT event_type AS use_case, 'model-' || CAST(max(user_id % 3) AS VARCHAR) AS chosen FROM events WHERE event_type <> 'view' GROUP BY 1)"""


@query("join_lookup_default", f"WITH {_BEST} SELECT e.event_id, e.event_type AS use_case, coalesce(b.chosen, 'model-primary') AS chosen FROM events e LEFT JOIN b ON b.use_case = e.event_type")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("event_type").alias("use_case"), "user_id")
    best = (
        e.where("use_case <> 'view'")
        .groupBy("use_case")
        .agg(F.concat(F.lit("model-"), F.max(F.col("user_id") % 3).cast("string")).alias("chosen"))
    )
    return J.looked_up(e.drop("user_id"), best, "use_case", "chosen", F.lit("model-primary")).select("event_id", "use_case", "chosen")


@query(
    "join_relevance_flag",
    """SELECT o_orderkey, o_custkey, EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o_custkey AND c.c_acctbal < 0) AS relevant FROM orders""",
)
def _(spark, sf):
    judged = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return J.relevant_flag(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), judged, ["o_custkey"])


_CH = f"""w AS (SELECT doc_id, {sql_words("text")} AS ws FROM documents), c AS (SELECT doc_id, unnest(range(0, len(ws), 351)) // 351 AS chunk_index FROM w)"""


def _chunks(spark, sf):
    return C.word_windows(documents(spark, sf).select("doc_id", "text"), keep_short_text=False)


@query("join_parent_metadata", f"WITH {_CH} SELECT doc_id, chunk_index, lang, source FROM c JOIN documents USING (doc_id)")
def _(spark, sf):
    return J.with_parent(_chunks(spark, sf), documents(spark, sf), "doc_id", ["lang", "source"]).drop("chunk_text")


@query("join_zipped", f"WITH {_CH} SELECT c.doc_id, chunk_index, label FROM c JOIN embeddings e ON e.vec_id = c.doc_id AND chunk_index = 0")
def _(spark, sf):
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(0).alias("chunk_index"), "label")
    return J.zipped(_chunks(spark, sf), v, ["doc_id", "chunk_index"]).select("doc_id", "chunk_index", "label")


# ---- sorts, limits, sets --------------------------------------------------------------


@query("sort_by_key", "SELECT o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_orderkey")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_custkey", "o_orderkey").orderBy("o_custkey", "o_orderkey")


@query("sort_top_scores", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 100")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(100)


@query("limit_ordered", "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 5000")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").orderBy("l_orderkey", "l_linenumber").limit(5000)


@query(
    "union_all_concat",
    "SELECT doc_id AS id, text, lang FROM documents UNION ALL SELECT item_id, text, NULL FROM benchmark",
)
def _(spark, sf):
    d = documents(spark, sf).select(F.col("doc_id").alias("id"), "text", "lang")
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    return d.unionByName(b, allowMissingColumns=True)


@query(
    "array_ordered_distinct",
    f"""WITH w AS (SELECT item_id, unnest({sql_words("text")}) AS w, unnest(range(0, len({sql_words("text")}))) AS p FROM benchmark),
     f AS (SELECT item_id, w, min(p) AS p FROM w GROUP BY ALL) SELECT item_id, string_agg(w, ' ' ORDER BY p) AS words FROM f GROUP BY 1""",
)
def _(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", F.array_join(F.array_distinct(T.words("text")), " ").alias("words"))


@query(
    "array_set_sizes",
    f"""WITH w AS (SELECT conv_id, turn, {sql_words("lower(text)")} AS a, {sql_words("lower(role || ' ' || text || ' the')")} AS b FROM conversations)
    SELECT conv_id, turn, len(list_distinct(list_intersect(a, b))) AS common, len(list_distinct(list_concat(a, b))) AS together FROM w""",
)
def _(spark, sf):
    a = T.words(F.lower("text"))
    b = T.words(F.lower(F.concat(F.col("role"), F.lit(" "), F.col("text"), F.lit(" the"))))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.size(F.array_intersect(a, b)).alias("common"), F.size(F.array_union(a, b)).alias("together")
    )


# ---- refresh --------------------------------------------------------------------------

_URL = """regexp_replace(trim(url), '#.*$', '')"""
_NURL = f"""regexp_replace(lower(regexp_extract({_URL}, '^([A-Za-z]+://[^/?]*)', 1)), ':(80|443)$', '') || regexp_replace(regexp_replace({_URL}, '^[A-Za-z]+://[^/?]*', ''), '/$', '')"""
_CONTENT = sql_collapse(
    "regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<title.*?</title>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"
)
_TITLE = sql_collapse("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")


@query(
    "pages_extracted",
    f"""WITH p AS (SELECT page_id, {_NURL} AS url, {_TITLE} AS title, md5({_CONTENT}) AS content_md5, len(regexp_extract_all(html, '(?i)<a [^>]*href=')) AS links FROM pages)
    SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1""",
)
def _(spark, sf):
    d = H.distinct_pages(H.page_facts(table(spark, sf, "pages")), "page_id")
    return d.select("page_id", "url", "title", F.md5("content").alias("content_md5"), "links")


_UNI = """u AS (SELECT 'documents' AS source, CAST(doc_id AS VARCHAR) AS record_id, source AS title, text FROM documents
   UNION ALL SELECT 'conversations', CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), role, text FROM conversations
   UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), url, html FROM pages)"""


def _unified(spark, sf):
    d, c, p = (table(spark, sf, n) for n in ("documents", "conversations", "pages"))
    cid = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return H.unified(
        {
            "documents": (d, {"record_id": F.col("doc_id"), "title": F.col("source"), "text": F.col("text")}),
            "conversations": (c, {"record_id": cid, "title": F.col("role"), "text": F.col("text")}),
            "pages": (p, {"record_id": F.col("page_id"), "title": F.col("url"), "text": F.col("html")}),
        }
    )


@query("records_unified", f"WITH {_UNI} SELECT source, record_id, title, length(text) AS length, sha256(text) AS checksum FROM u")
def _(spark, sf):
    return _unified(spark, sf).drop("text")


@query(
    "records_registry",
    f"""WITH {_UNI} SELECT source, count(*) AS records, count(DISTINCT sha256(text)) AS distinct_texts, round(avg(length(text)), 6) AS mean_length,
      count(*) FILTER (length(text) = 0) AS empty FROM u GROUP BY 1""",
)
def _(spark, sf):
    return _r(H.source_registry(_unified(spark, sf)), 6, "mean_length")


_VERS = f"""old AS (SELECT d.doc_id AS id, d.text FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS DISTINCT FROM 0),
   new AS (SELECT d.doc_id AS id, CASE WHEN lang = 'en' THEN {SQL_CLEAN} ELSE text END AS text FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.toxic IS DISTINCT FROM 1),
   ch AS (SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN o.text = n.text THEN 'unchanged' ELSE 'changed' END AS change,
      list_distinct({sql_words("lower(n.text)")}) AS a, list_distinct({sql_words("lower(o.text)")}) AS b FROM old o FULL JOIN new n ON o.id = n.id)"""


def _versions(spark, sf):
    """Two states of the documents: before and after moderation (toxic out, low quality in, English cleaned)."""
    d = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left").withColumnRenamed("doc_id", "id")
    old = d.where(~F.col("quality").eqNullSafe(0)).select("id", "text")
    new = d.where(~F.col("toxic").eqNullSafe(1)).select(
        "id", F.when(F.col("lang") == "en", T.clean_text("text")).otherwise(F.col("text")).alias("text")
    )
    return old, new


@query(
    "changes_detected",
    f"""WITH {_VERS} SELECT id, change, round(CASE change WHEN 'unchanged' THEN 0 WHEN 'changed' THEN 1 - CASE WHEN len(a) > 0 AND len(b) > 0 THEN
        0.4::DOUBLE * len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) + 0.6::DOUBLE * len(list_intersect(a, b)) / len(b) ELSE 0 END ELSE 1 END, 6) AS significance FROM ch""",
)
def _(spark, sf):
    return _r(H.changes(*_versions(spark, sf), "id", "text"), 6, "significance").select("id", "change", "significance")


@query(
    "changes_work_list",
    f"""WITH {_VERS} SELECT n.id, length(n.text) < 100 AS short, CASE WHEN length(n.text) < 100 THEN 'failed' ELSE 'completed' END AS status,
      (length(n.text) < 100)::INT AS retries FROM new n JOIN ch ON ch.id = n.id WHERE change IN ('added', 'changed')""",
)
def _(spark, sf):
    old, new = _versions(spark, sf)
    todo = H.work_list(H.changes(old, new, "id", "text"), new, "id")
    none = spark.createDataFrame([], "id long, retries int")
    st = H.attempt_status(todo, F.length("text") < 100, none, "id", as_of())
    return st.select("id", (F.col("status") == "failed").alias("short"), "status", "retries")


@query(
    "freshness_by_source",
    """SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen, round(avg((value < 45)::INT), 6) AS success_rate, count(*) AS records,
      round(date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31 00:00:00') / 60000000, 6) AS age_minutes, round(1 - avg((value < 45)::INT), 6) AS error_rate,
      date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31 00:00:00') / 60000000 > 30 AS stale FROM events GROUP BY 1""",
)
def _(spark, sf):
    d = H.freshness(table(spark, sf, "events"), "event_type", "ts", F.col("value") < 45, as_of=as_of(), limit_minutes=30)
    d = d.withColumn("last_seen", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss"))
    return _r(d, 6, "success_rate", "error_rate", "age_minutes")


_DUE = """s AS (SELECT user_id, CASE user_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS priority, max(ts) AS last FROM events GROUP BY 1)"""


@query(
    "refresh_due_list",
    f"""WITH {_DUE}, i AS (SELECT *, CASE priority WHEN 'high' THEN 15 WHEN 'medium' THEN 60 ELSE 1440 END AS interval_minutes FROM s)
    SELECT user_id, priority, interval_minutes FROM i WHERE last + to_minutes(interval_minutes) <= TIMESTAMP '2024-01-31 00:00:00'""",
)
def _(spark, sf):
    p = F.when(F.col("user_id") % 3 == 0, "high").when(F.col("user_id") % 3 == 1, "medium").otherwise("low")
    s = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last")).withColumn("priority", p)
    d = H.due_for_refresh(s, last="last", priority="priority", as_of=as_of(), minutes={"high": 15, "medium": 60, "low": 1440})
    return d.select("user_id", "priority", "interval_minutes")


# ---- sources and sinks: the given tables written in each layout and read back -----------


@query("source_csv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, sf):
    out = fresh_folder(spark, "csv")
    W.write_csv(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), out)
    return RD.read_csv(spark, out, "c_custkey long, c_name string, c_acctbal double")


@query(
    "source_quoted_lines_csv",
    "SELECT p_name AS \"Text\", p_brand AS \"Sentiment\", p_size AS \"UserID\", p_retailprice AS \"ConfidenceScore\" FROM part",
)
def _(spark, sf):
    out = fresh_folder(spark, "quoted")
    p = table(spark, sf, "part")
    cells = F.concat_ws(
        ", ", F.concat(F.lit('""'), F.col("p_name"), F.lit('""')), F.concat(F.lit(" "), F.col("p_brand")), F.col("p_size").cast("string"), F.col("p_retailprice").cast("string")
    )
    line = F.concat(F.lit('  "'), F.regexp_replace(cells, '""', ""), F.lit('" '))
    head = spark.createDataFrame([('"Text, Sentiment, User ID, Confidence Score"',)], "value string")
    p.select(line.alias("value")).unionByName(head).write.text(out)
    schema = "Text string, Sentiment string, UserID string, ConfidenceScore string"
    d = RD.read_quoted_lines_csv(spark, out, "Text, Sentiment, User ID, Confidence Score", schema)
    return d.select("Text", "Sentiment", F.col("UserID").cast("int").alias("UserID"), F.col("ConfidenceScore").cast("double").alias("ConfidenceScore"))


@query(
    "source_review_files",
    "SELECT md5(text) AS text_md5, count(*) AS n FROM (SELECT regexp_replace(text, chr(10), ' ', 'g') AS text FROM benchmark UNION ALL SELECT text FROM benchmark) GROUP BY 1",
)
def _(spark, sf):
    """Text and JSON files, one review each, in one folder."""
    out = fresh_folder(spark, "reviews")
    b = table(spark, sf, "benchmark")
    flat = b.select(F.regexp_replace("text", "\n", " ").alias("value"))
    flat.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(out + "/plain")
    b.select(F.col("text").alias("review_text")).write.option("maxRecordsPerFile", 1).json(out + "/coded")
    d = RD.read_reviews(spark, out + "/*")
    ended = F.regexp_replace("text", "\n$", "")  # the writer's end of line
    text = F.when(F.col("path").endswith(".txt"), ended).otherwise(F.col("text"))
    return d.groupBy(F.md5(text).alias("text_md5")).agg(F.count(F.lit(1)).alias("n"))


@query("source_json_records", "SELECT conv_id, turn, role FROM conversations")
def _(spark, sf):
    out = fresh_folder(spark, "json")
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    files = -(-c.count() // 500)
    spread = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(files))
    arrays = c.groupBy(spread.alias("file")).agg(F.to_json(F.collect_list(F.struct("conv_id", "turn", "role"))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(out)
    return RD.read_json_records(spark, out, "conv_id long, turn long, role string")


@query("source_bulk_ndjson", "SELECT vec_id, label, len(embedding) AS dims FROM embeddings")
def _(spark, sf):
    out = fresh_folder(spark, "bulk")
    W.write_bulk_ndjson(table(spark, sf, "embeddings"), out, index="items", id_col="vec_id")
    d = RD.read_bulk_ndjson(spark, out, "vec_id long, embedding array<float>, label int")
    return d.select("vec_id", "label", F.size("embedding").alias("dims"))


@query("source_daily_partition", "SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def _(spark, sf):
    out = fresh_folder(spark, "daily")
    table(spark, sf, "events").withColumn("day", F.col("ts").cast("date")).repartition("day").write.partitionBy("day").parquet(out)
    return RD.read_day(spark, out, "2024-01-15").select("event_id", "event_type")


@query("source_listed_objects", "SELECT count(DISTINCT event_type) AS files, TRUE AS all_have_bytes FROM events")
def _(spark, sf):
    out = fresh_folder(spark, "listed")
    table(spark, sf, "events").write.partitionBy("event_type").json(out)
    d = RD.list_objects(spark, out, suffix=".json")
    kind = F.nullif(F.regexp_extract("path", "event_type=([^/]*)/[^/]*$", 1), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return d.agg(F.countDistinct(kind).alias("files"), (F.min("length") > 0).alias("all_have_bytes"))


@query("source_catalogued", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(spark, sf):
    out = fresh_folder(spark, "catalogued")
    W.write_csv(table(spark, sf, "nation"), out)
    RD.catalogued(spark, out, "catalogued_nation")
    return spark.table("catalogued_nation")


@query(
    "sink_vector_jsonl",
    "SELECT CAST(vec_id AS VARCHAR) || '_chunk_0' AS id, len(embedding) AS dims, 'doc_id' AS namespace, CAST(vec_id AS VARCHAR) AS allowed FROM embeddings",
)
def _(spark, sf):
    out = fresh_folder(spark, "vectors")
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(0).alias("chunk_index"), "embedding")
    W.write_vector_jsonl(e, out, owner="doc_id")
    d = spark.read.schema("id string, embedding array<double>, restricts array<struct<namespace string, allow array<string>>>").json(out)
    r = F.col("restricts")[0]
    return d.select("id", F.size("embedding").alias("dims"), r["namespace"].alias("namespace"), r["allow"][0].alias("allowed"))


@query(
    "sink_text_store",
    V.with_views("claims")
    + f"SELECT claim_id || '_chunk_0' AS id, md5('Claim Context: ' || {SQL_REDACT} || chr(10) || 'Resolution Notes: ' || notes) AS text_md5 FROM claims WHERE fraud_confirmed",
)
def _(spark, sf):
    out = fresh_folder(spark, "texts")
    c = C.claim_chunks(V.claims(spark, sf))
    W.write_text_store(c, out + "/store", id_col="chunk_id", text="chunk_text")
    W.write_text_map(c, out + "/map", id_col="chunk_id", text="chunk_text")
    a = spark.read.parquet(out + "/store")
    b = spark.read.schema("id string, text string").json(out + "/map").withColumnRenamed("text", "mapped")
    return a.join(b, "id").where("text = mapped").select("id", F.md5("text").alias("text_md5"))


@query("sink_reports_by_source", "SELECT source, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1")
def _(spark, sf):
    out = fresh_folder(spark, "reports")
    d = documents(spark, sf).select("source", F.struct("doc_id", "n_chars", T.quality_checks("text").alias("checks")).alias("report"))
    W.write_reports(d, out)
    back = spark.read.schema("report struct<doc_id: long, n_chars: long>, source string").json(out)
    return back.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("report.n_chars").alias("chars"))


@query(
    "sink_keyed_merge",
    """WITH x AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders)
    SELECT o_custkey, o_orderkey, o_totalprice FROM x QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
)
def _(spark, sf):
    """Orders merged status by status into one row per customer, the latest order winning."""
    out = fresh_folder(spark, "merge")
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    for n, status in enumerate(("F", "O", "P", "P")):  # the last batch comes twice and changes nothing
        VS.merge(o.where(F.col("o_orderstatus") == status), out, "o_custkey", [F.col("o_orderkey")], batch=("orders", min(n, 2)))
    return VS.read(spark, out).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "sink_versions",
    """WITH v AS (SELECT * FROM (VALUES (1, 'F'), (2, 'O'), (3, 'P')) t(version, last)),
      x AS (SELECT version, o_custkey, max(o_orderkey) AS o_orderkey FROM orders JOIN v ON o_orderstatus <= last GROUP BY ALL)
    SELECT version, count(*) AS customers, sum(o_orderkey)::BIGINT AS keys FROM x GROUP BY 1""",
)
def _(spark, sf):
    """Every version a merge has left can still be read."""
    out = fresh_folder(spark, "versions")
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    for status in ("F", "O", "P"):
        VS.merge(o.where(F.col("o_orderstatus") == status), out, "o_custkey", [F.col("o_orderkey")])
    found = None
    for n in VS.versions(spark, out):
        one = VS.read(spark, out, n).agg(
            F.lit(n).alias("version"), F.count(F.lit(1)).alias("customers"), F.sum("o_orderkey").alias("keys")
        )
        found = one if found is None else found.unionByName(one)
    return found


@query(
    "sink_status_merge",
    """WITH o AS (SELECT doc_id AS id, 'pending' AS status, n_chars AS size FROM documents),
     u AS (SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'completed' ELSE 'failed' END AS status, CASE WHEN quality = 0 THEN 'low quality' END AS error FROM labels)
    SELECT coalesce(u.id, o.id) AS id, coalesce(u.status, o.status) AS status, o.size, u.error FROM o FULL JOIN u ON o.id = u.id""",
)
def _(spark, sf):
    old = documents(spark, sf).select(F.col("doc_id").alias("id"), F.lit("pending").alias("status"), F.col("n_chars").alias("size"))
    upd = table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("quality") == 1, "completed").otherwise("failed").alias("status"),
        F.when(F.col("quality") == 0, "low quality").alias("error"),
    )
    return W.status_merged(old, upd, "id")


@query("sink_store_records", f"WITH {_CH} SELECT 'word' AS strategy, count(*) AS n FROM c")
def _(spark, sf):
    out = fresh_folder(spark, "records")
    W.write_store_records(C.store_records(_chunks(spark, sf), "word", created_at=as_of()), out)
    return spark.read.parquet(out).groupBy("strategy").agg(F.count(F.lit(1)).alias("n"))


# ---- whole document build -------------------------------------------------------------


_DIMS = 64


@query(
    "document_build",
    f"""WITH w AS (SELECT doc_id, text, {sql_words("text")} AS ws, length(regexp_replace(text, '{SP}', '', 'g')) AS letters FROM documents)
    SELECT doc_id, length(text) AS character_count, len(ws) AS word_count, CAST(ceil(len(ws) / 351::DOUBLE) AS BIGINT) AS chunks,
      CAST(ceil(len(ws) / 351::DOUBLE) AS BIGINT) AS embeddings, topics,
      CASE WHEN letters / greatest(len(ws), 1) < 4 THEN 'basic' WHEN letters / greatest(len(ws), 1) < 6 THEN 'intermediate' ELSE 'advanced' END AS reading_level,
      CASE WHEN len(ws) = 0 THEN 'failed' ELSE 'completed' END AS status FROM w JOIN ({sql_topics()}) USING (doc_id)""",
)
def _(spark, sf):
    """Metadata, topics, chunks, vectors, merged tables, and what came of each document."""
    out = fresh_folder(spark, "build")
    docs = documents(spark, sf).select("doc_id", "text")
    d = B.rebuild(docs, out, VV.word_hash_encoder(_DIMS), dims=_DIMS, run=1)
    return d.withColumn("topics", F.array_join("topics", ",")).drop("checksum", "error", "retries", "run")


@query(
    "changes_rebuilt",
    f"""WITH {_VERS}, s AS (SELECT d.doc_id AS id, o.text AS t1, n.text AS t2, d.text AS t3 FROM documents d LEFT JOIN old o ON o.id = d.doc_id LEFT JOIN new n ON n.id = d.doc_id),
     f AS (SELECT *, length(t1) < 100 AS f1, length(t2) < 100 AS f2, length(t3) < 100 AS f3, coalesce(t1 = t2, false) AS s12, coalesce(t2 = t3, false) AS s23 FROM s),
     r AS (SELECT *, CASE WHEN s12 THEN f1::INT ELSE 0 END + f2::INT AS r2 FROM f),
     g AS (SELECT *, CASE WHEN NOT f3 THEN t3 WHEN NOT f2 THEN t2 WHEN t2 IS NOT NULL AND NOT f1 THEN t1 END AS good FROM r)
    SELECT id AS doc_id, CASE WHEN f3 THEN 'failed' ELSE 'completed' END AS status, CAST(CASE WHEN s23 THEN r2 ELSE 0 END + f3::INT AS BIGINT) AS retries,
      CAST(CASE WHEN NOT s23 OR f2 THEN 3 WHEN NOT s12 OR f1 THEN 2 ELSE 1 END AS BIGINT) AS run,
      CAST(coalesce(ceil(len({sql_words("good")}) / 351::DOUBLE), 0) AS BIGINT) AS stored_chunks FROM g""",
)
def _(spark, sf):
    """Three states of the documents, each built on top of the one before: only what is open is built again.

    Texts under 100 characters fail and are tried again; their last good chunks stay.
    """
    out = fresh_folder(spark, "rebuild")
    old, new = (d.withColumnRenamed("id", "doc_id") for d in _versions(spark, sf))
    for n, docs in enumerate((old, new, documents(spark, sf)), 1):
        done = B.rebuild(docs, out, VV.word_hash_encoder(_DIMS), dims=_DIMS, run=n, min_chars=100)
        for name in ("chunks", "vectors", "status"):  # nobody reads the states before
            VS.expire(spark, f"{out}/{name}", keep=1)
    held = VS.read(spark, f"{out}/chunks").groupBy("doc_id").agg(F.count(F.lit(1)).alias("stored_chunks"))
    return done.join(held, "doc_id", "left").select(
        "doc_id", "status", "retries", "run", F.coalesce("stored_chunks", F.lit(0)).alias("stored_chunks")
    )


@query(
    "encoding_store",
    """WITH k AS (SELECT md5(substr(text, 1, 2000)) AS k, length(substr(text, 1, 2000)) < 100 AS failed, lang = 'en' AS en FROM documents),
      t AS (SELECT k, any_value(failed) AS failed, count(*) AS c, CASE WHEN any_value(failed) AND bool_or(en) THEN 2 ELSE 1 END AS attempts FROM k GROUP BY 1)
    SELECT CASE WHEN failed THEN 'failed' ELSE 'completed' END AS status, attempts::BIGINT AS attempts, sum(c)::BIGINT AS n, count(*) AS texts FROM t GROUP BY ALL""",
)
def _(spark, sf):
    """English documents are encoded, then all: the second run sees only new texts and those that had failed."""
    out = fresh_folder(spark, "vectors")
    docs, words = documents(spark, sf).select("doc_id", "lang", "text"), VV.word_hash_encoder(_DIMS)

    def encoder(texts):
        if any(len(t) < 100 for t in texts):
            raise ValueError("too short for this encoder")
        return words(texts)

    B.encode_new(docs.where("lang = 'en'"), "text", out, encoder, dims=_DIMS)
    d = B.encode_new(docs, "text", out, encoder, dims=_DIMS)
    attempts = VS.read(spark, out).select("content_key", "attempts")
    return d.join(attempts, "content_key").groupBy(F.col("encoding").alias("status"), "attempts").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("content_key").alias("texts")
    )


# ---- streams --------------------------------------------------------------------------


def _stream(spark, sf, name):
    # a pattern, so that the table may be a single file as well as a folder
    return X.arriving(spark, f"{sf}/{name}.parque?", table(spark, sf, name).schema)


_QC = f"""SELECT doc_id, (length(text) >= 10)::INT + regexp_matches(text, '(?i){fv.PRODUCT_PATTERN}')::INT + regexp_matches(text, '(?i){fv.OPINION_PATTERN}')::INT
   + (NOT regexp_matches(text, '(?i){fv.PROFANITY_PATTERN}'))::INT + contains(text, '.')::INT AS n FROM documents"""


@query("stream_review_checks", f"SELECT doc_id, n / 5::DOUBLE AS quality_score FROM ({_QC})")
def _(spark, sf):
    out = fresh_folder(spark, "stream-reviews")
    X.run_to_files(X.reviewed(_stream(spark, sf, "documents")), out + "/rows", out + "/checkpoint")
    return spark.read.parquet(out + "/rows").select("doc_id", "quality_score")


@query(
    "stream_chunk_store",
    f"""WITH w AS (SELECT doc_id, t, {sql_words("t")} AS ws FROM (SELECT doc_id, {SQL_CLEAN} AS t FROM documents)),
     c AS (SELECT doc_id, t, ws, unnest(CASE WHEN len(ws) <= 390 THEN [0] ELSE range(0, len(ws), 351) END) AS s FROM w)
    SELECT CAST(doc_id AS VARCHAR) || '_chunk_' || CAST(s // 351 AS VARCHAR) AS chunk_id,
      md5(CASE WHEN len(ws) <= 390 THEN t ELSE array_to_string(ws[s + 1 : s + 390], ' ') END) AS chunk_md5 FROM c""",
)
def _(spark, sf):
    out = fresh_folder(spark, "stream-chunks")
    X.chunk_store(_stream(spark, sf, "documents"), out + "/store", out + "/checkpoint")
    return VS.read(spark, out + "/store/chunks").select("chunk_id", F.md5("chunk_text").alias("chunk_md5"))


def _window_sql(minutes: int, by: str = "") -> str:
    cols = f"{by}, " if by else ""
    return f"""WITH w AS (SELECT time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '2000-01-01') AS s, {cols}value FROM events)
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, {cols}count(*) AS count, round(avg(value), 6) AS average, round(sum(value), 4) AS total,
      min(value) AS min, max(value) AS max FROM w GROUP BY ALL"""


def _in_two_runs(events, src, run, late="false"):
    """The first half of the time arrives and is run, then the rest, with the `late` rows among it."""
    half = events.agg(F.min("ts") + (F.max("ts") - F.min("ts")) / 2).scalar()
    split = events.withColumn("_half", half)
    second = F.coalesce((F.col("ts") >= F.col("_half")) | F.expr(late), F.lit(False))
    for part in (~second, second):
        split.where(part).drop("_half").write.mode("append").parquet(src)
        run()


def _windowed(spark, sf, width, by=()):
    out, events = fresh_folder(spark, "stream-windows"), table(spark, sf, "events")

    def run():
        e = X.arriving(spark, out + "/events", events.schema)
        X.merged_windows(e, out + "/windows", out + "/checkpoint", "ts", "value", by=list(by), width=width)

    _in_two_runs(events, out + "/events", run, "ts >= _half - INTERVAL 8 MINUTES AND event_id % 2 = 1")
    d = VS.read(spark, out + "/windows").withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))
    return _r(_r(d, 6, "average"), 4, "total").select("window_start", *by, "count", "average", "total", "min", "max")


@query("stream_window_averages", _window_sql(5))
def _(spark, sf):
    """All windows, open ones too; rows that come late by less than the delay are counted."""
    return _windowed(spark, sf, "5 minutes")


@query("stream_window_by_type", _window_sql(1440, "event_type"))
def _(spark, sf):
    return _windowed(spark, sf, "1 day", ["event_type"])


@query(
    "stream_circuit_states",
    V.with_views("search_log")
    + """, s AS (SELECT *, sum(success::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seg FROM search_log),
    c AS (SELECT *, sum((NOT success)::INT) OVER (PARTITION BY user_id, seg ORDER BY ts, event_id) AS fc FROM s),
    l AS (SELECT user_id, fc::BIGINT AS state FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, event_id, fc::BIGINT AS failure_count, fc > 5 AS is_open, state FROM c JOIN l USING (user_id)""",
)
def _(spark, sf):
    """Attempts counted in two batches, and the state each circuit is left in."""
    out, events = fresh_folder(spark, "stream-circuit"), table(spark, sf, "events")

    def run():
        e = X.arriving(spark, out + "/events", events.schema)
        e = e.select("event_id", "user_id", "ts", (F.col("event_type") != "error").alias("ok"))
        X.circuit_states(e, out, out + "/checkpoint", key="user_id", ts="ts", tie="event_id", ok="ok")

    _in_two_runs(events, out + "/events", run)
    states = VS.read(spark, out + "/states").select("user_id", F.col("failures").alias("state"))
    attempts = spark.read.parquet(out + "/attempts").select("user_id", "event_id", "failure_count", "is_open")
    return attempts.join(states, "user_id")


@query(
    "stream_recent_turns",
    """WITH r AS (SELECT conv_id, turn, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 3)
    SELECT conv_id, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS turns, md5(string_agg(text, '|' ORDER BY turn)) AS text_md5 FROM r GROUP BY 1""",
)
def _(spark, sf):
    out = fresh_folder(spark, "stream-turns")
    t = X.recent_turns(_stream(spark, sf, "conversations"), conversation="conv_id", turn="turn", text="text", keep=3)
    X.run_batches(t, X.numbered_batches(out + "/rows"), out + "/checkpoint", mode="update")
    last = W.latest(spark.read.parquet(out + "/rows"), "conv_id", [F.col("batch")])
    return last.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda x: x.cast("string")), ",").alias("turns"),
        F.md5(F.array_join("texts", "|")).alias("text_md5"),
    )


@query("stream_distinct_events", "SELECT DISTINCT event_id, event_type FROM events")
def _(spark, sf):
    """The events delivered twice, each kept once."""
    out = fresh_folder(spark, "stream-distinct")
    e = _stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    twice = e.select("event_id", "event_type", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    X.run_to_files(X.distinct_arrivals(twice, "event_id", "ts"), out + "/rows", out + "/checkpoint")
    return spark.read.parquet(out + "/rows").select("event_id", "event_type")
