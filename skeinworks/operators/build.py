"""Whole document builds kept in versioned tables: metadata, topics, chunks, vectors, and a status per document.

A store is a folder with three tables (`sources.versions`): `chunks` (several rows a document), `vectors` (one row
a distinct text) and `status` (one row a document). Chunks are written before the status that names them, so a run
that breaks between the two is made up for by the next one, which finds the same documents still open.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..sources import versions as VS
from . import chunking as C
from .vector import encode_with

VECTORS = "content_key string, embedding array<float>, status string, attempts long"
STATUS = (
    "doc_id {id}, checksum string, character_count int, word_count int, reading_level string, topics array<string>,"
    " chunks long, embeddings long, status string, error string, retries long, run long"
)


def _known(like: DataFrame, path: str, schema: str) -> DataFrame:
    spark = like.sparkSession
    return VS.read(spark, path) if VS.versions(spark, path) else spark.createDataFrame([], schema)


def encode_new(
    df: DataFrame, text: str, table: str, encoder: Callable, *, dims: int, max_chars: int = 2000, max_attempts: int = 3, batch: tuple[str, int] | None = None
) -> DataFrame:
    """Encode what the vector table does not hold yet and join all vectors back to the rows.

    Rows of equal text (up to `max_chars`, which is what the encoder sees) are encoded once. Texts whose encoding
    failed stay in the table with zeros and are tried again by the next runs, `max_attempts` times in all. A null
    text is not encoded: its vector and status are null.
    """
    keyed = df.withColumn("content_key", F.md5(F.substring(text, 1, max_chars)))
    texts = keyed.where("content_key is not null").groupBy("content_key").agg(F.min(F.substring(text, 1, max_chars)).alias("_text"))
    known = _known(df, table, VECTORS)
    held = known.where((F.col("status") == "completed") | (F.col("attempts") >= max_attempts)).select("content_key")
    todo = texts.join(held, "content_key", "left_anti").join(known.select("content_key", "attempts"), "content_key", "left")
    done = encode_with(todo, "_text", encoder, dims=dims).select(
        "content_key", "embedding", "status", (F.coalesce("attempts", F.lit(0)) + 1).cast("long").alias("attempts")
    )
    VS.merge(done, table, "content_key", [F.col("attempts")], batch=batch)
    vectors = VS.read(df.sparkSession, table).select("content_key", "embedding", F.col("status").alias("encoding"))
    return keyed.join(vectors, "content_key", "left")


def open_documents(docs: DataFrame, known: DataFrame, *, max_retries: int) -> DataFrame:
    """Documents that are new, whose text has changed, or that failed and may be tried again, with their retries so far."""
    k = known.select("doc_id", F.col("checksum").alias("_sum"), F.col("status").alias("_status"), F.col("retries").alias("_retries"))
    d = docs.withColumn("checksum", F.sha2(F.coalesce("text", F.lit("")), 256)).join(k, "doc_id", "left")
    same = F.col("_sum").eqNullSafe(F.col("checksum"))
    again = (F.col("_status") == "failed") & (F.col("_retries") <= max_retries)
    return d.where(~same | again).select(
        "doc_id", "text", "checksum", F.when(same, F.col("_retries")).otherwise(F.lit(0)).cast("long").alias("_before")
    )


def rebuild(docs: DataFrame, store: str, encoder: Callable, *, dims: int, run: int, min_chars: int = 1, max_retries: int = 3) -> DataFrame:
    """Bring a store up to `docs` (doc_id, text): build what is new, changed or failed before, drop what is gone.

    A document fails when it has fewer than `min_chars` characters, no word, or a chunk that could not be encoded;
    its last good chunks stay and the next run tries it again, `max_retries` times beyond the first. `run` is the
    number of this run: handing one in a second time changes nothing; what it wrote besides the tables is gone when it ends. doc_id has to be unique. Returns the status table.
    """
    spark = docs.sparkSession
    if run <= VS.version(spark, f"{store}/status").batches.get(store, -1):
        return VS.read(spark, f"{store}/status")
    docs = docs.select("doc_id", "text")
    known = _known(docs, f"{store}/status", STATUS.format(id=dict(docs.dtypes)["doc_id"]))
    outcome = f"{store}/runs/{run}"  # what a run has to do and what came of it, written once; the tables follow it
    open_documents(docs, known, max_retries=max_retries).write.mode("overwrite").parquet(f"{outcome}/work")
    work = spark.read.parquet(f"{outcome}/work")
    chunks = C.linked_chunks(C.word_windows(work.where(F.length("text") >= min_chars).select("doc_id", "text"), keep_short_text=False))
    chunks.write.mode("overwrite").parquet(f"{outcome}/cut")  # read for their texts and again to get the vectors
    chunks = spark.read.parquet(f"{outcome}/cut")
    coded = encode_new(chunks, "chunk_text", f"{store}/vectors", encoder, dims=dims, batch=(store, run))
    coded.write.mode("overwrite").parquet(f"{outcome}/chunks")
    coded = spark.read.parquet(f"{outcome}/chunks")
    VS.remove(spark, f"{outcome}/cut")
    per = coded.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("encoding") == "completed").alias("embeddings")
    )
    facts = T.document_metrics(work).join(per, "doc_id", "left")
    error = (
        F.when(F.coalesce(F.length("text"), F.lit(0)) < min_chars, "too short")
        .when(F.col("chunks").isNull(), "no words")
        .when(F.col("embeddings") < F.col("chunks"), "not encoded")
    )
    status = facts.withColumn("error", error).select(
        "doc_id",
        "checksum",
        F.coalesce("character_count", F.lit(0)).alias("character_count"),
        F.coalesce("word_count", F.lit(0)).cast("int").alias("word_count"),
        "reading_level",
        F.coalesce(T.topic_labels("text"), F.array().cast("array<string>")).alias("topics"),
        F.coalesce("chunks", F.lit(0)).cast("long").alias("chunks"),
        F.coalesce("embeddings", F.lit(0)).cast("long").alias("embeddings"),
        F.when(F.col("error").isNull(), "completed").otherwise("failed").alias("status"),
        "error",
        (F.col("_before") + F.col("error").isNotNull().cast("long")).alias("retries"),
        F.lit(run).cast("long").alias("run"),
    )
    gone = known.join(docs, "doc_id", "left_anti").select("doc_id")
    status.write.mode("overwrite").parquet(f"{outcome}/status")
    gone.write.mode("overwrite").parquet(f"{outcome}/gone")
    status, gone = spark.read.parquet(f"{outcome}/status"), spark.read.parquet(f"{outcome}/gone")
    VS.remove(spark, f"{outcome}/work")
    good = status.where("status = 'completed'").select("doc_id")
    built = coded.join(good, "doc_id", "left_semi")
    VS.replace(built, good.unionByName(gone), f"{store}/chunks", "doc_id", batch=(store, run))
    VS.replace(status, gone, f"{store}/status", "doc_id", batch=(store, run))
    VS.remove(spark, outcome)  # the tables have it all
    return VS.read(spark, f"{store}/status")
