"""Views over the given tables that stand in for the logs, claims and ranking tables.

Each view exists twice: as a DataFrame and as the SQL a twin query starts from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .registry import documents, table

SQL: dict[str, str] = {}


def with_views(*names: str) -> str:
    """`WITH a AS (...), b AS (...)` for the named views."""
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + " "


SQL["search_log"] = """
  SELECT event_id, ts, user_id, event_type AS search_type, value AS latency_ms,
         CAST(json_extract_string(props, '$.k') AS INT) AS result_count,
         event_type <> 'error' AS success
  FROM events"""


def search_log(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.select(
        "event_id",
        "ts",
        "user_id",
        F.col("event_type").alias("search_type"),
        F.col("value").alias("latency_ms"),
        F.get_json_object("props", "$.k").cast("int").alias("result_count"),
        (F.col("event_type") != "error").alias("success"),
    )


SQL["rag_log"] = SQL["search_log"].replace(
    "event_type <> 'error' AS success",
    """event_type <> 'error' AS success, value AS total_time,
         CAST(json_extract_string(props, '$.k') AS INT) % 2 = 0 AS from_cache,
         CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS variant""",
)


def rag_log(spark: SparkSession, folder: str) -> DataFrame:
    return search_log(spark, folder).select(
        "*",
        F.col("latency_ms").alias("total_time"),
        (F.col("result_count") % 2 == 0).alias("from_cache"),
        F.when(F.col("user_id") % 2 == 0, "A").otherwise("B").alias("variant"),
    )


SQL["model_eval"] = """
  SELECT event_id, ts, 'model-' || CAST(user_id % 3 AS VARCHAR) AS model_id, event_type AS use_case,
         value AS latency, CAST(json_extract_string(props, '$.k') AS INT) / CAST(100 AS DOUBLE) AS similarity,
         value / CAST(1000 AS DOUBLE) AS cost,
         CAST(json_extract_string(props, '$.k') AS INT) AS tokens, event_type <> 'error' AS success
  FROM events"""


def model_eval(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        "event_id",
        "ts",
        F.concat(F.lit("model-"), (F.col("user_id") % 3).cast("string")).alias("model_id"),
        F.col("event_type").alias("use_case"),
        F.col("value").alias("latency"),
        (k / F.lit(100.0)).alias("similarity"),
        (F.col("value") / 1000).alias("cost"),
        k.alias("tokens"),
        (F.col("event_type") != "error").alias("success"),
    )


SQL["claims"] = """
  SELECT 'C-' || CAST(c_custkey AS VARCHAR) AS claim_id, c_acctbal,
         'Ph:  555-' || substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 3, 3) || '-'
           || substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 6, 4)
           || '.  SSN: ' || substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 1, 3) || '-'
           || substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 4, 2) || '-'
           || substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 6, 4)
           || '. ' || c_mktsegment || ' claim' AS raw_text,
         c_acctbal < 0 AS fraud_confirmed, c_name AS notes
  FROM customer"""


def claims(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    key = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    return c.select(
        F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("claim_id"),
        "c_acctbal",
        F.concat(
            F.lit("Ph:  555-"), key.substr(3, 3), F.lit("-"), key.substr(6, 4),
            F.lit(".  SSN: "), key.substr(1, 3), F.lit("-"), key.substr(4, 2), F.lit("-"), key.substr(6, 4),
            F.lit(". "), F.col("c_mktsegment"), F.lit(" claim"),
        ).alias("raw_text"),
        (F.col("c_acctbal") < 0).alias("fraud_confirmed"),
        F.col("c_name").alias("notes"),
    )


SQL["md_docs"] = """
  SELECT doc_id, replace(replace(text, '.' || chr(10), '.' || chr(10) || '## '),
                         '. ', '.' || chr(10) || '### ') AS text
  FROM documents"""


def md_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its paragraphs as sections and its sentences as subsections."""
    t = F.replace(F.col("text"), F.lit(".\n"), F.lit(".\n## "))
    return documents(spark, folder).select(
        "doc_id", F.replace(t, F.lit(". "), F.lit(".\n### ")).alias("text")
    )


SQL["ltr_pos"] = """
  SELECT CAST(o_custkey AS VARCHAR) AS query_group_id, l_partkey AS product_id, l_orderkey, l_linenumber,
         p_type AS category, p_retailprice AS retail_price, 0.5::DOUBLE * p_retailprice + p_size AS cost, 1 AS label
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
  WHERE o_orderstatus = 'F'"""


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("retail_price"),
        (F.lit(0.5) * F.col("p_retailprice") + F.col("p_size")).alias("cost"),
    )


SQL["products"] = """
  SELECT p_partkey AS product_id, p_type AS category, p_retailprice AS retail_price,
         0.5::DOUBLE * p_retailprice + p_size AS cost FROM part"""

SQL["pred"] = """
  SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice AS y_true,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS y_pred
  FROM lineitem"""


def pred(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.col("l_extendedprice").alias("y_true"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("y_pred"),
    )


SQL["doc_vec"] = """
  SELECT d.doc_id, d.text, d.lang, d.source, e.embedding, e.label
  FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id"""


def doc_vec(spark: SparkSession, folder: str) -> DataFrame:
    d = documents(spark, folder).select("doc_id", "text", "lang", "source")
    e = table(spark, folder, "embeddings").withColumnRenamed("vec_id", "doc_id")
    return d.join(e, "doc_id")


SQL["doc_all"] = SQL["doc_vec"].replace("JOIN embeddings", "LEFT JOIN embeddings")


def doc_all(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, those without a vector too."""
    d = documents(spark, folder).select("doc_id", "text", "lang", "source")
    e = table(spark, folder, "embeddings").withColumnRenamed("vec_id", "doc_id")
    return d.join(e, "doc_id", "left")


SQL["text_queries"] = """
  SELECT b.item_id AS query_id, b.text AS query, e.embedding, e.label
  FROM benchmark b JOIN embeddings e ON b.item_id = e.vec_id"""


def text_queries(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    e = table(spark, folder, "embeddings").withColumnRenamed("vec_id", "query_id")
    return b.join(e, "query_id")
