"""Structured Streaming jobs: file intake, windowed metrics, keyed states.

Every job takes a checkpoint folder below the shared folder, runs on whatever has arrived
(`availableNow`) and can be started again on more files; files seen before change nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import text as T
from ..operators import chunking as C
from ..operators.logs import failure_state
from ..sources import versions as VS
from ..sources.writers import latest


def arriving(spark: SparkSession, path: str, schema, *, kind: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A stream of the files below a path."""
    r = spark.readStream.schema(schema).format(kind)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.load(path)


def run_to_files(stream: DataFrame, out: str, checkpoint: str, *, mode: str = "append") -> None:
    """Append the stream's rows to Parquet, exactly once."""
    q = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, *, mode: str = "append") -> None:
    """Hand every micro-batch to a function that may be repeated for the same batch."""
    q = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def reviewed(stream: DataFrame, text: str = "text") -> DataFrame:
    """Each arriving review with its five checks and quality score."""
    return stream.withColumn("_q", T.quality_checks(text)).select("*", "_q.*").drop("_q")


def distinct_arrivals(stream: DataFrame, key: str, ts: str, *, delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of a key that arrive within the delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def windowed_metrics(
    stream: DataFrame, ts: str, value: str, *, by: list[str] = (), width: str = "5 minutes", delay: str = "10 minutes"
) -> DataFrame:
    """Count, mean, sum and range per tumbling window (and key)."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return (
        timed.groupBy(F.window(ts, width), *by)
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg(value).alias("average"),
            F.sum(value).alias("total"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
        .select(F.col("window.start").alias("window_start"), *by, "count", "average", "total", "min", "max")
    )


def merged_windows(
    stream: DataFrame, table: str, checkpoint: str, ts: str, value: str, *, by: list[str] = (), width: str = "5 minutes", delay: str = "10 minutes"
) -> None:
    """Windowed metrics as a table that is right after every batch.

    Windows come out whenever a row changes them and are merged by window (and key) into a versioned table. So open
    ones are there too, and rows that come late by less than `delay` change theirs; later ones are dropped.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("window_key", F.struct("window_start", *by)).withColumn("batch", F.lit(batch_id).cast("long"))
        VS.merge(rows, table, "window_key", [F.col("batch")], batch=(checkpoint, batch_id))

    run_batches(windowed_metrics(stream, ts, value, by=by, width=width, delay=delay), step, checkpoint, mode="update")


def chunk_store(stream: DataFrame, store: str, checkpoint: str, *, arrived: list[str] = ()) -> None:
    """Clean and chunk arriving documents; `store/chunks` and `store/status` are versioned tables by doc_id.

    A document that comes again replaces all its chunks. Of several rows of one document in a batch the greatest in
    the `arrived` columns (then by text) counts. A document without words has no chunks and the status `failed`.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        one = latest(batch.select("doc_id", "text", *arrived), "doc_id", [*map(F.col, arrived), F.col("text")])
        clean = one.select("doc_id", T.clean_text("text").alias("text"))
        chunks = C.linked_chunks(C.word_windows(clean.where("trim(text) <> ''")))
        VS.replace(chunks, one, f"{store}/chunks", "doc_id", batch=(checkpoint, batch_id))
        counts = VS.read(batch.sparkSession, f"{store}/chunks").groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"))
        status = one.select("doc_id", F.length("text").alias("characters"), F.substring("text", 1, 500).alias("preview"))
        status = status.join(counts, "doc_id", "left").withColumn("chunks", F.coalesce("chunks", F.lit(0)).cast("long"))
        status = status.withColumn("status", F.when(F.col("chunks") > 0, "chunked").otherwise("failed"))
        status = status.withColumn("batch", F.lit(batch_id).cast("long"))
        VS.merge(status, f"{store}/status", "doc_id", [F.col("batch")], batch=(checkpoint, batch_id))

    run_batches(stream, step, checkpoint)


def circuit_states(
    stream: DataFrame, folder: str, checkpoint: str, *, key: str, ts: str, tie: str, ok: str, opens_above: int = 5
) -> None:
    """Failure counts per circuit over a stream of attempts.

    Each micro-batch is counted with distributed running sums, so one busy circuit is not bound to one task (a keyed
    state would sort all its attempts of a batch there). `folder/states` is a versioned table by circuit: a batch
    reads and rewrites the buckets of its own circuits. Its attempts lie under its number below `folder/attempts`;
    they are written before its states, and a batch whose states are in the table is not counted again.
    """
    table = f"{folder}/states"

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = VS.version(spark, table)
        if held.batches.get(checkpoint, -1) >= batch_id:
            return
        if held.number:
            mine = batch.select(key).distinct()
            known = VS.read(spark, table).join(mine, key, "left_semi").select(key, "failures", "last_failure", "last_success")
        else:
            kinds = dict(batch.dtypes)
            known = spark.createDataFrame(
                [], f"{key} {kinds[key]}, failures long, last_failure {kinds[ts]}, last_success {kinds[ts]}"
            )
        rows = failure_state(batch, key, ts, tie, ok, opens_above=opens_above, carried=known)
        rows.write.mode("overwrite").parquet(f"{folder}/attempts/batch={batch_id}")
        done = spark.read.parquet(f"{folder}/attempts/batch={batch_id}")
        news = done.groupBy(key).agg(
            F.max_by("failure_count", F.struct(ts, tie)).alias("failures"),
            F.max(F.when(~F.col(ok), F.col(ts))).alias("last_failure"),
            F.max(F.when(F.col(ok), F.col(ts))).alias("last_success"),
        )
        o = known.select(F.col(key).alias("_k"), F.col("last_failure").alias("_f"), F.col("last_success").alias("_s"))
        states = news.join(o, F.col(key).eqNullSafe(F.col("_k")), "left").select(
            key,
            "failures",
            F.coalesce("last_failure", "_f").alias("last_failure"),
            F.coalesce("last_success", "_s").alias("last_success"),
            F.lit(batch_id).cast("long").alias("batch"),
        )
        VS.merge(states, table, key, [F.col("batch")], batch=(checkpoint, batch_id))

    run_batches(stream, step, checkpoint)


def recent_turns(stream: DataFrame, *, conversation: str, turn: str, text: str, keep: int = 10) -> DataFrame:
    """The latest turns of each conversation as keyed state, emitted whenever they change.

    State holds `keep` turns; arriving rows are read batch by batch and only the newest kept.
    """
    kind = dict(stream.dtypes)[conversation]

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(zip(*state.get)) if state.exists else []
        for b in batches:
            held = sorted({**dict(held), **dict(zip(b[turn].tolist(), b[text].tolist()))}.items())[-keep:]
        turns, texts = [int(t) for t, _ in held], [x for _, x in held]
        state.update((turns, texts))
        yield pd.DataFrame({conversation: [key[0]], "turns": [turns], "texts": [texts]})

    out = f"{conversation} {kind}, turns array<bigint>, texts array<string>"
    return stream.select(conversation, turn, text).groupBy(conversation).applyInPandasWithState(
        update, out, "turns array<bigint>, texts array<string>", "update", GroupStateTimeout.NoTimeout
    )


def numbered_batches(out: str) -> Callable[[DataFrame, int], None]:
    """A step for `run_batches` that writes each batch under its number, replacing a repeat."""

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return step
