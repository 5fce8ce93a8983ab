"""Keyword scoring: term weights per document, term joins, synonym expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fv, text as T
from .vector import fits, rank_top


def keyword_weights(df: DataFrame, text: str, out: str = "terms") -> DataFrame:
    """array<struct<term, weight>> with weight = occurrences per 1000 tokens."""
    d = T.term_counts(df.withColumn("_tok", T.tokens(text)), "_tok", "_tc")
    n = F.size("_tok")
    w = F.transform("_tc", lambda t: F.struct(t["term"].alias("term"), (t["tf"] / n * 1000).alias("weight")))
    return d.withColumn(out, w).drop("_tok", "_tc")


def bm25_weights(
    df: DataFrame, text: str, out: str = "terms", *, k1: float = 1.5, b: float = 0.75, avg_len: float | Column = 100.0
) -> DataFrame:
    """array<struct<term, weight>> with the saturated, length-normalised frequency of each term."""
    d = T.term_counts(df.withColumn("_tok", T.words(F.lower(F.col(text)))), "_tok", "_tc")
    avg = avg_len if isinstance(avg_len, Column) else F.lit(float(avg_len))
    d = d.withColumn("_norm", k1 * (1 - b + b * F.size("_tok") / avg))
    w = F.transform(
        "_tc",
        lambda t: F.struct(t["term"].alias("term"), (t["tf"] * (k1 + 1) / (t["tf"] + F.col("_norm"))).alias("weight")),
    )
    return d.withColumn(out, w).drop("_tok", "_tc", "_norm")


def query_terms(tokens: Column) -> Column:
    """Distinct tokens with weight 1."""
    return F.transform(
        F.array_distinct(tokens), lambda t: F.struct(t.alias("term"), F.lit(1.0).alias("weight"))
    )


def corpus_idf(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(term, idf) of the wanted terms over the documents, log form, never negative.

    Only postings of wanted terms are counted and shuffled.
    """
    n = docs.agg(F.count(F.lit(1))).scalar()
    terms = docs.select(F.explode_outer(F.array_distinct(T.words(F.lower(F.col(text))))).alias("term"))
    asked = wanted.select("term").distinct()
    if fits(asked, F.octet_length("term")):
        asked = F.broadcast(asked)
    df = terms.join(asked, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.withColumn("_n", n).select(
        "term", F.log(1 + (F.col("_n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")
    )


def fan_out(df: DataFrame, id_col: str, terms: str) -> DataFrame:
    """(id, term, weight) rows. The outer form keeps the optimiser from testing the array's size
    first, which would compute the array twice."""
    return df.select(id_col, F.inline_outer(terms)).where(F.col("term").isNotNull())


def term_join_top_k(
    queries: DataFrame, docs: DataFrame, k: int, *, terms: str = "terms", keep_zero: bool = True
) -> DataFrame:
    """The k documents with the largest summed weights of the query's terms.

    `docs` must be partitioned by doc_id, best while they are still plain text. The broadcast
    join, the sum per (query, document) and the cut to k rows then all stay in that partition,
    however common a term is, and only k rows per query and task are shuffled.

    With `keep_zero`, documents without any query term stay eligible, lowest id first.
    """
    postings = fan_out(docs, "doc_id", terms)
    asked = fan_out(queries, "query_id", "q_terms").withColumnRenamed("weight", "asked")
    if fits(queries, F.coalesce(F.size("q_terms"), F.lit(0)) * 96):
        asked = F.broadcast(asked)
    hits = postings.join(asked, "term")
    scored = hits.groupBy("query_id", "doc_id").agg(F.sum(F.col("weight") * F.col("asked")).alias("score"))
    best = rank_top(scored.withColumn("score", F.round("score", 9)), "query_id", "score", "doc_id", k)
    if not keep_zero:
        return best
    # k documents are enough to fill up: at most k of them can be hits already
    lowest = docs.select("doc_id").orderBy("doc_id").limit(k).agg(F.collect_list("doc_id").alias("ids")).scalar()
    fill = queries.select("query_id", lowest.alias("ids")).select(
        "query_id", F.explode_outer("ids").alias("doc_id"), F.lit(0.0).alias("score")
    ).where(F.col("doc_id").isNotNull())
    both = best.drop("rank").unionByName(fill).groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    return rank_top(both, "query_id", "score", "doc_id", k)


#: A task scores documents of about so many bytes: it holds a row for each of them and each query that it answers.
TASK_BYTES = 4 << 20


def _placed(docs: DataFrame, text: str, sized_by: DataFrame | None = None) -> DataFrame:
    """Documents by id, as many tasks as the texts (or those of `sized_by`, which are cheaper to read) have pieces of TASK_BYTES."""
    held = (docs if sized_by is None else sized_by).agg(F.sum(F.octet_length(text))).first()[0] or 0
    if held <= TASK_BYTES:  # one task could have them all, so Spark may choose
        return docs.select("doc_id", text).repartition("doc_id")
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-held // TASK_BYTES))
    return docs.select("doc_id", text).repartition(tasks, "doc_id")


def keyword_search(
    queries: DataFrame, docs: DataFrame, k: int = 5, *, query: str = "query", text: str = "text", sized_by: DataFrame | None = None
) -> DataFrame:
    """Best k documents by query-term occurrences per 1000 tokens."""
    q = queries.select("query_id", query_terms(T.tokens(query)).alias("q_terms"))
    return term_join_top_k(q, keyword_weights(_placed(docs, text, sized_by), text), k)


def bm25_search(
    queries: DataFrame, docs: DataFrame, k: int = 5, *, query: str = "query", text: str = "text",
    k1: float = 1.5, b: float = 0.75, corpus_statistics: bool = False,
) -> DataFrame:
    """Best k documents by BM25; plain statistics (idf 1, length 100) or those of the corpus."""
    q = queries.select("query_id", query_terms(T.words(F.lower(F.col(query)))).alias("q_terms"))
    d = _placed(docs, text)
    if not corpus_statistics:
        return term_join_top_k(q, bm25_weights(d, text, k1=k1, b=b), k)
    avg = d.agg(F.avg(T.word_count(text))).scalar()
    weighted = bm25_weights(d.withColumn("_avg", avg), text, k1=k1, b=b, avg_len=F.col("_avg")).drop("_avg")
    wanted = fan_out(q, "query_id", "q_terms")
    rare = wanted.join(corpus_idf(docs, text, wanted), "term")
    q = rare.groupBy("query_id").agg(
        F.collect_list(F.struct("term", F.col("idf").alias("weight"))).alias("q_terms")
    )
    return term_join_top_k(q, weighted, k)


def triggered_expansion(query: Column) -> Column:
    """The query and the expansions of every trigger it contains, sorted, without repeats."""
    low = F.lower(query)
    parts = [
        F.when(low.contains(k), F.array(*[F.lit(s) for s in syn])).otherwise(F.array().cast("array<string>"))
        for k, syn in fv.TRIGGER_EXPANSIONS.items()
    ]
    return F.array_sort(F.array_distinct(F.concat(F.array(query), *parts)))


def synonym_expansion(query: Column, *, per_term: int = 2) -> Column:
    """The lower-cased words followed by the first synonyms of each, as one text."""
    pairs = []
    for k, syn in fv.DOMAIN_SYNONYMS.items():
        pairs += [F.lit(k), F.array(*[F.lit(s) for s in syn[:per_term]])]
    table = F.create_map(*pairs)
    ws = T.words(F.lower(query))
    more = F.flatten(
        F.transform(ws, lambda w: F.coalesce(F.try_element_at(table, w), F.array().cast("array<string>")))
    )
    return F.array_join(F.concat(ws, more), " ")
