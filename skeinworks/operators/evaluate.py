"""Retrieval and answer evaluation: ranking metrics, topic metrics, gates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import overlap_similarity
from ..session import ship


def _safe(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def ranking_metrics(hits: DataFrame, queries: DataFrame, k: int, *, rel: str = "rel") -> DataFrame:
    """Precision@k, recall@k, reciprocal rank and DCG/NDCG@k per query.

    hits: query_id, rank (from 1), `rel` (grade, 0 when not relevant). queries: query_id,
    n_relevant. The ideal order sorts the retrieved grades. Queries without hits count as 0.
    """
    w = Window.partitionBy("query_id").orderBy(F.desc(rel), "rank")
    d = hits.withColumn("_ideal", F.row_number().over(w))
    hit = F.col(rel) > 0

    def gain(place):
        return F.sum(F.when(F.col(place) <= k, F.col(rel) / F.log2(F.col(place) + 1.0)))

    per = d.groupBy("query_id").agg(
        F.count_if(hit & (F.col("rank") <= k)).alias("hits"),
        F.min(F.when(hit, F.col("rank"))).alias("first"),
        gain("rank").alias("dcg"),
        gain("_ideal").alias("_idcg"),
    )
    full = queries.select("query_id", "n_relevant").join(per, "query_id", "left")
    found = F.coalesce("hits", F.lit(0))
    return full.select(
        "query_id",
        (found / F.lit(k) if k else F.lit(0.0)).alias("precision"),
        _safe(found, F.col("n_relevant")).alias("recall"),
        F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("reciprocal_rank"),
        F.coalesce("dcg", F.lit(0.0)).alias("dcg"),
        F.coalesce(_safe(F.col("dcg"), F.col("_idcg")), F.lit(0.0)).alias("ndcg"),
    )


def method_summary(per_query: DataFrame, *, by: list[str] = (), latency: str | None = None) -> DataFrame:
    """Mean metrics over all queries, per method when `by` is given."""
    return per_query.groupBy(*by).agg(
        F.avg("precision").alias("mean_precision"),
        F.avg("recall").alias("mean_recall"),
        F.avg("reciprocal_rank").alias("mrr"),
        F.avg("ndcg").alias("mean_ndcg"),
        *([F.avg(latency).alias("mean_latency")] if latency else []),
        F.count(F.lit(1)).alias("queries_evaluated"),
    )


#: Characters of the runs by which documents find the topics they may hold.
GRAM = 6


def _with_grams(df: DataFrame, text: str, lengths: list[int]) -> DataFrame:
    """`df` with `_grams`: a number for each distinct run of the given lengths in a text.

    Equal runs have equal numbers; different ones almost always different ones. Length 0 is the empty run.
    """
    ship(df.sparkSession)
    odd = np.uint64(0x9E3779B97F4A7C15)

    def numbered(points: np.ndarray, n: int) -> np.ndarray:
        count = max(len(points) - n + 1, 0)
        h = np.full(count, n, np.uint64)
        for k in range(n):
            h = (h ^ points[k : k + count]) * odd
            h ^= h >> np.uint64(29)
        return h if n else h[:1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = []
            for t in b.column(text).to_pylist():
                points = np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
                sets.append(np.unique(np.concatenate([numbered(points, n) for n in lengths])) if t is not None else points)
            ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32))
            flat = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, flat)], [*b.schema.names, "_grams"])

    kinds = ", ".join(f"{c} {t}" for c, t in df.dtypes)
    return df.mapInArrow(run, f"{kinds}, _grams array<long>")


def topic_matches(docs: DataFrame, topics: DataFrame, *, block_bytes: int = 32 << 20) -> DataFrame:
    """(doc_id, query_id) for every document holding any topic of the query as a substring.

    A document can only hold a topic if it holds the topic's rarest run of GRAM characters (a shorter
    topic is its own run), counted over all documents. So documents give their distinct runs, meet in an
    equi-join the topics filed under them, and `contains` decides. Topics go to every task in blocks of
    about `block_bytes`; however many there are, the blocks only become more. Case does not count; null
    topics are left out, the empty one is in every text that is not null.
    """
    asked = topics.select("query_id", F.explode(F.transform("topics", F.lower)).alias("topic")).where("topic is not null").distinct()
    size = asked.agg(
        F.coalesce(F.sum(F.octet_length("topic") + 96), F.lit(0)).alias("bytes"),
        F.count(F.lit(1)).alias("n"),
        F.collect_set(F.least(F.length("topic"), F.lit(GRAM))).alias("lengths"),
    ).first()  # at most GRAM + 1 lengths
    blocks = max(1, min(size["n"], -(-size["bytes"] // block_bytes)))
    names = asked.select("topic").distinct()
    runs = None
    for n in size["lengths"]:
        own = _with_grams(names.where(F.least(F.length("topic"), F.lit(GRAM)) == n), "topic", [n]).select("topic", F.explode("_grams").alias("_gram"))
        runs = own if runs is None else runs.union(own)
    if runs is None:  # no topics, so no matches
        return docs.join(asked.withColumnRenamed("topic", "text"), "text").select("doc_id", "query_id")
    low = docs.select("doc_id", F.lower("text").alias("_text"))
    grams = _with_grams(low, "_text", sorted(size["lengths"]))
    held = grams.select(F.explode("_grams").alias("_gram"))

    def met(block: int) -> DataFrame:
        here = F.pmod(F.xxhash64("topic"), F.lit(blocks)) == block
        mine = runs.where(here)
        counts = held.join(F.broadcast(mine.select("_gram").distinct()), "_gram").groupBy("_gram").agg(F.count(F.lit(1)).alias("n"))
        rarity = mine.join(counts, "_gram", "left").groupBy("topic").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "_gram")).alias("r"))
        filed = asked.where(here).join(rarity, "topic").select("query_id", "topic", F.col("r._gram").alias("_gram"))
        pairs = grams.select("doc_id", "_text", F.explode("_grams").alias("_gram")).join(F.broadcast(filed), "_gram")
        return pairs.where(F.contains("_text", "topic")).select("doc_id", "query_id")

    found = met(0)
    for block in range(1, blocks):
        found = found.union(met(block))
    return found.distinct()


def topic_metrics(hits: DataFrame, docs: DataFrame, topics: DataFrame, k: int = 5) -> DataFrame:
    """Precision, recall and F1 where a document counts when it holds any topic of the query."""
    top = hits.where(F.col("rank") <= k).groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("_hits"))
    matches = topic_matches(docs, topics).join(top, ["query_id", "doc_id"], "left")
    found = matches.groupBy("query_id").agg(F.count(F.lit(1)).alias("total_relevant"), F.sum("_hits").alias("relevant_retrieved"))
    d = topics.select("query_id").join(found, "query_id", "left").na.fill(0)
    return _f1(
        d.withColumn("precision", F.col("relevant_retrieved") / F.lit(k)).withColumn(
            "recall", _safe(F.col("relevant_retrieved"), F.col("total_relevant"))
        )
    )


def topic_coverage(hits: DataFrame, texts: DataFrame, topics: DataFrame, k: int = 5) -> DataFrame:
    """Topics found in the retrieved texts, over retrieved texts (may exceed 1) and over topics."""
    few = hits.where(F.col("rank") <= k).join(texts.select("doc_id", F.lower("text").alias("text")), "doc_id")
    asked = (
        few.join(topics, "query_id")
        .select("query_id", "text", F.explode_outer("topics").alias("topic"))
        .select("query_id", "topic", F.col("text").contains(F.lower("topic")).alias("in_text"))
    )
    per_topic = asked.groupBy("query_id", "topic").agg(F.max("in_text").alias("found"))
    found = per_topic.groupBy("query_id").agg(F.count_if("found").alias("true_positives"))
    count = few.groupBy("query_id").agg(F.count(F.lit(1)).alias("retrieved_count"))
    d = topics.select("query_id", F.size("topics").alias("expected_count"))
    d = d.join(found, "query_id", "left").join(count, "query_id", "left").na.fill(0)
    return _f1(
        d.withColumn("precision", _safe(F.col("true_positives"), F.col("retrieved_count"))).withColumn(
            "recall", _safe(F.col("true_positives"), F.col("expected_count"))
        )
    )


def _f1(d: DataFrame) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    return d.withColumn("f1_score", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def gate(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Metrics with a threshold, each passed or not; metrics that are absent are skipped."""
    return metrics.join(thresholds, "metric").withColumn("passed", F.col("score") >= F.col("threshold"))


def gate_result(checked: DataFrame) -> DataFrame:
    """Overall verdict and the names of the failed metrics (one row per metric comes in)."""
    return checked.agg(
        F.coalesce(F.min("passed"), F.lit(True)).alias("passed"),
        F.array_join(
            F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("metric")))), ","
        ).alias("failures"),
    )


def answer_scores(answers: DataFrame, golden: DataFrame, *, key: str) -> DataFrame:
    """Word-overlap score of each answer against the golden one."""
    both = answers.join(golden, key)
    return both.select(key, overlap_similarity("answer", "ground_truth").alias("score"))
