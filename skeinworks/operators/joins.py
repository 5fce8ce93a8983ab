"""Lookups with defaults, id resolution, parent metadata and keyed zips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def resolved_ids(hits: DataFrame, store: DataFrame, key: str = "id") -> DataFrame:
    """Hits with their text; ids without one stay, with a null text and `resolved` false."""
    known = store.select(key, "text")
    return hits.join(known, key, "left").withColumn("resolved", F.col("text").isNotNull())


def unresolved_count(hits: DataFrame, store: DataFrame, key: str = "id") -> DataFrame:
    return hits.join(store.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("unresolved"))


def looked_up(df: DataFrame, table: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """The table's value for the key, else the default."""
    return df.join(table.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value), default))


def relevant_flag(hits: DataFrame, judgments: DataFrame, keys: list[str]) -> DataFrame:
    """Whether each hit is among the judged pairs."""
    marked = judgments.select(*keys).distinct().withColumn("relevant", F.lit(True))
    return hits.join(marked, keys, "left").withColumn("relevant", F.coalesce("relevant", F.lit(False)))


def with_parent(chunks: DataFrame, parents: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Chosen parent columns on every chunk."""
    return chunks.join(parents.select(key, *columns), key)


def zipped(chunks: DataFrame, vectors: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks with their vectors by document and index; what has no partner is dropped."""
    return chunks.join(vectors, keys)
