"""Writers: vector exports, bulk files, text stores, reports, keyed merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def vector_records(chunks: DataFrame, *, owner: str = "claim_id", embedding: str = "embedding") -> DataFrame:
    """id `{owner}_chunk_{i}`, embedding, and the owner as the only allowed restriction."""
    return chunks.select(
        F.concat_ws("_chunk_", F.col(owner).cast("string"), F.col("chunk_index").cast("string")).alias("id"),
        F.col(embedding).alias("embedding"),
        F.array(
            F.struct(F.lit(owner).alias("namespace"), F.array(F.col(owner).cast("string")).alias("allow"))
        ).alias("restricts"),
    )


def write_vector_jsonl(chunks: DataFrame, path: str, **options) -> None:
    vector_records(chunks, **options).write.mode("overwrite").json(path)


def bulk_lines(docs: DataFrame, *, index: str, id_col: str) -> DataFrame:
    """Action line then document line per row, as (id, pos, value)."""
    action = F.to_json(
        F.struct(F.struct(F.lit(index).alias("_index"), F.col(id_col).cast("string").alias("_id")).alias("index"))
    )
    body = F.to_json(F.struct(*[F.col(c) for c in docs.columns]))
    return docs.select(F.col(id_col).alias("id"), F.posexplode(F.array(action, body)).alias("pos", "value"))


def write_bulk_ndjson(docs: DataFrame, path: str, *, index: str, id_col: str) -> None:
    """Both lines of a document come out of one row, so they stay together without a shuffle."""
    bulk_lines(docs, index=index, id_col=id_col).select("value").write.mode("overwrite").text(path)


def write_text_store(chunks: DataFrame, path: str, *, id_col: str, text: str) -> None:
    """(id, text) table to resolve vector ids with; ids must be those of the vector export."""
    chunks.select(F.col(id_col).alias("id"), F.col(text).alias("text")).write.mode("overwrite").parquet(path)


def write_text_map(chunks: DataFrame, path: str, *, id_col: str, text: str) -> None:
    chunks.select(F.col(id_col).alias("id"), F.col(text).alias("text")).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_reports(df: DataFrame, path: str, *, by: str = "source") -> None:
    df.write.mode("overwrite").partitionBy(by).json(path)


def write_store_records(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").partitionBy("strategy").parquet(path)


def latest(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The last row per key; rows of a repeated key are reduced before the shuffle."""
    other = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*other), F.struct(*order))
    return df.groupBy(key).agg(last.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in other]).select(*df.columns)


def status_merged(old: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates laid over the old rows column by column; what an update leaves null is kept."""
    both = old.alias("o").join(updates.alias("u"), F.col(f"o.{key}") == F.col(f"u.{key}"), "full")
    names = list(dict.fromkeys([*old.columns, *updates.columns]))

    def side(c):
        found = [F.col(f"{a}.{c}") for a, d in (("u", updates), ("o", old)) if c in d.columns]
        return F.coalesce(*found).alias(c)

    return both.select(*[side(c) for c in names])
