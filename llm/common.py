"""Helpers shared by the operators: reading tables, lasting intermediate tables, words, hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.session import fresh_folder, ship

#: Words of the plain kind: anything between the six ASCII spaces.
SPACED = r"[^\x20\x09-\x0D]+"
#: Words of the lower-case kind: ASCII letters and digits, and all that is not ASCII.
LOWER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, and safe from lost executors."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text):
    """Column: A-Z in lower case, all else as it is; null as the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema, rows: int | None = None, done: Callable[[], None] | None = None
) -> DataFrame:
    """Apply `fn` to each Arrow batch, or to slices of `rows` rows of it, of which one is decoded at a time; what gives None is left out.

    `done` is called when a task has no more batches, to forget what `fn` has kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows) if rows else (0,):
                out = fn(batch.slice(at, rows) if rows else batch)
                if out is not None:
                    yield out
        if done is not None:
            done()

    return in_arrow(df, run, schema)


def give_back() -> None:
    """Memory that is free in this process goes back to the system: a worker outlives its task, and waits beside the next stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with this code sent along; a task's memory goes back when it ends."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    ship(df.sparkSession)
    ship(df.sparkSession, "llm")
    return df.mapInArrow(lean, schema)


def ascii_lowered(text: str) -> str:
    """A-Z in lower case and nothing else: the bytes of other letters are no ASCII letters."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


class WordHashes(dict):
    """64-bit hashes of words, each computed once; forgets all when it holds 200,000."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_M1, _M2, _BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every `length` consecutive items; doubles the run until it fits, so log(length) passes."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    have, done = mixed(hashes + _BASE), 1
    while done < length:
        step = min(done, length - done)
        n = len(have) - step
        have = mixed(have[:n] * np.uint64(3) + (have[step:] ^ np.uint64(done * 2 + 1)) * _BASE)
        done += step
    return have


def shingles(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of `length` words; a shorter text that has words is one run."""
    if 0 < len(hashes) < length:
        return runs(hashes, len(hashes))
    return runs(hashes, length)


def long_list(arrays: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(kind.to_pandas_dtype()), kind))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def joined_on_hot(many: DataFrame, few: DataFrame, key: str, count: str, by: str, spread: int = 32) -> DataFrame:
    """`many` left-joined with `few` (one row per `key`, `count` the rows of `many` that have it).

    A key with over a thousandth of all rows (so there are at most a thousand) is dealt over `spread`
    tasks by a hash of the column `by`, and its row of `few` copied to each. `count` is left out.
    """
    total = few.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    hot = F.broadcast(few.where(F.col(count) > max(total // 1000, 1000)).select(key, F.lit(True).alias("_hot")))
    many = many.join(hot, key, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(by, F.lit(7)), F.lit(spread))).otherwise(0).cast("int")).drop("_hot")
    salts = F.when(F.col(count) > max(total // 1000, 1000), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    return many.join(few.withColumn("_salt", F.explode(salts)).drop(count), [key, "_salt"], "left").drop("_salt")
