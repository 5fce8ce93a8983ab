"""Threshold-scaled sketches: of a text's shingle hashes all below a fixed fraction of the range are kept."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from llm.common import WordHashes, in_arrow, long_list, map_batches, shingles, table, texts_of

#: Words of a shingle; one in so many hashes is kept; so many least hashes are kept in any case.
SHINGLE, SCALE, LEAST = 5, 8, 16


def sketch_of(text: str, hashes: WordHashes, words: int = SHINGLE, scale: int = SCALE, least: int = LEAST) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles below 2**64 / scale, and the `least` smallest in any case.

    Words are what white space parts, in lower case; a shorter text is one shingle, a text without
    words has an empty sketch.
    """
    h = np.unique(shingles(hashes.of(text.lower().split()), words))
    below = int(np.searchsorted(h, np.uint64((1 << 64) // scale)))
    return h[: max(below, min(least, len(h)))]


def bound_of(sketch: np.ndarray, scale: int = SCALE, least: int = LEAST) -> int:
    """All hashes of the text below this are in its sketch."""
    if len(sketch) < least:
        return 1 << 64
    return max((1 << 64) // scale, int(sketch[-1]) + 1)


def merged(a: np.ndarray, b: np.ndarray, scale: int = SCALE, least: int = LEAST) -> np.ndarray:
    """The sketch of both texts' shingles together, from their sketches alone."""
    both = np.union1d(a, b)
    bound = min(bound_of(a, scale, least), bound_of(b, scale, least))
    inside = both[: int(np.searchsorted(both, np.uint64(bound)))] if bound < 1 << 64 else both
    below = int(np.searchsorted(inside, np.uint64((1 << 64) // scale)))
    return inside[: max(below, min(least, len(inside)))]


def containment(a: np.ndarray, b: np.ndarray, scale: int = SCALE, least: int = LEAST) -> float:
    """Estimated share of the smaller text's shingles that the other has too; 1 for two empty texts."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    bound = min(bound_of(a, scale, least), bound_of(b, scale, least))
    if bound < 1 << 64:
        a, b = (x[: int(np.searchsorted(x, np.uint64(bound)))] for x in (a, b))
    if not len(a) or not len(b):
        return 0.0
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def written(sketch: np.ndarray) -> str:
    """A sketch as text: its hashes in order, eight bytes each, in base 64."""
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def sketched(docs: DataFrame, text: str = "text", words: int = SHINGLE, scale: int = SCALE, least: int = LEAST) -> DataFrame:
    """`docs` with `sketch`, an array of hashes as signed numbers, and its `fingerprint`.

    A null text is empty and so is its sketch; equal texts have equal sketches; very long texts keep
    one hash in `scale`. Columns with the names of the results are replaced.
    """
    docs = docs.drop("sketch", "fingerprint")
    hashes = WordHashes()

    def draw(batch: pa.RecordBatch):
        made = [sketch_of(t, hashes, words, scale, least) for t in texts_of(batch, text)]
        return pa.RecordBatch.from_arrays([*batch.columns, long_list([m.view(np.int64) for m in made]), pa.array([written(m) for m in made], pa.string())], [*batch.schema.names, "sketch", "fingerprint"])

    return map_batches(docs, draw, StructType([*docs.schema.fields, StructField("sketch", ArrayType(LongType())), StructField("fingerprint", StringType())]))


def beside_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", pieces: int | None = None) -> DataFrame:
    """Documents in blocks, descending by id, so that each block also holds the document after its last.

    Returns (_block, _guest, doc_id, text), partitioned by block and sorted within. The bounds of the
    blocks are quantiles of the ids; the first document of each block, found from ids alone, is a
    guest of the block before, and that of the first block a guest of the last. What the driver holds
    is a row for each block. Null ids come last, equal ids by text.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = pieces or 4 * n
    ids = docs.select(F.col(doc_id).cast("long").alias("id"))
    cuts = sorted(set(ids.approxQuantile("id", [k / blocks for k in range(1, blocks)], 0.1 / blocks)), reverse=True)
    step = max(1, round(len(cuts) ** 0.5))
    fine = [cuts[k : k + step] for k in range(0, len(cuts), step)]

    def above(values: list[float]):
        return F.array(*[F.lit(c) for c in values]).cast("array<double>")

    # the number of cuts above an id, counted among every step-th cut first and then between two of those
    coarse = F.greatest(F.lit(1), F.size(F.filter(above([f[0] for f in fine]), lambda c: c > F.col("id"))))
    rest = F.filter(F.element_at(F.array(*[above(f) for f in fine]), coarse), lambda c: c > F.col("id")) if fine else F.array()
    block = F.when(F.col("id").isNull(), F.lit(len(cuts))).otherwise((coarse - 1) * step + F.size(rest))
    firsts = ids.select(block.alias("b"), "id").groupBy("b").agg(F.max("id").alias("id")).collect()
    by_block = sorted((r.b, r.id) for r in firsts)
    lead = [(first, by_block[k - 1][0]) for k, (_, first) in enumerate(by_block)]
    lead = F.broadcast(spark.createDataFrame(lead, "_first long, _before int"))  # a row for each block
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.join(lead, F.col("id").eqNullSafe(F.col("_first")), "left")
    places = F.array(F.struct(block.alias("b"), F.lit(0).alias("g")), F.struct(F.coalesce("_before", F.lit(-1)).alias("b"), F.lit(1).alias("g")))
    rows = rows.select("id", "text", F.explode(places).alias("x")).where("x.b >= 0")
    rows = rows.select(F.col("x.b").alias("_block"), F.col("x.g").alias("_guest"), F.col("id").alias("doc_id"), "text")
    return rows.repartition(n, "_block").sortWithinPartitions("_block", "_guest", F.col("doc_id").desc_nulls_last(), "text")


def edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE, scale: int = SCALE, least: int = LEAST) -> DataFrame:
    """The fingerprints of all documents and of their edited texts, and how alike they are.

    The edited text has its last third replaced by the beginning of the next document's text, in
    descending order of ids, after the last comes the first; a single document is its own next. Null
    texts are empty. Likeness is `containment`. No rows give no rows.
    """
    hashes = WordHashes()

    def run(batches):
        held = None  # (id, text, sketch) of a document that waits for the one after it
        block, closed = None, False
        for batch in batches:
            out = []
            for b, guest, i, t in zip(*(batch.column(c).to_pylist() for c in ("_block", "_guest", "doc_id", "text")), strict=True):
                if b != block:
                    block, held, closed = b, None, False
                if closed:
                    continue
                now = (i, t or "", sketch_of(t or "", hashes, words, scale, least))
                if held is not None:
                    out.append(_beside(held, now, hashes, words, scale, least))
                held, closed = now, bool(guest)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()], strict=True)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    rows = beside_next(docs, doc_id, text)
    return in_arrow(rows, run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _beside(held, after, hashes, words, scale, least):
    i, t, s = held
    cut = len(t) // 3
    new = t[: len(t) - cut] + after[1][:cut]
    e = sketch_of(new, hashes, words, scale, least)
    sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
    return i, len(t), sha, written(s), written(e), containment(s, e, scale, least), containment(s, after[2], scale, least)


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited(table(spark, sf_dir, "documents"))


QUERIES = {"op4_fingerprint": op4_fingerprint}
