"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are sets of word shingles. Every shingle is ordered by how many documents hold it;
as a window must be held whole, its necessary prefix is its rarest shingle alone. Documents are met
with the prefix shingles only, a meeting is bounded by the window's length and position within the
text, and what is left is compared word by word.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import LOWER_WORD, ascii_lowered, map_batches, runs, shingles, table, texts_of

#: Words of a window and of a shingle; bytes of item texts that one pass over the documents takes.
WINDOW, SHINGLE, BLOCK_BYTES = 13, 5, 32 << 20


def words_of(text: str, finder=re.compile(LOWER_WORD)) -> list[str]:
    return finder.findall(ascii_lowered(text))


class Windows:
    """The windows of a block of items, coded by the block's own words."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW, shingle: int = SHINGLE):
        self.shingle = shingle
        self.codes: dict[str, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.codes.setdefault(w, len(self.codes)) for w in words_of(text)]
            for s in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[s : s + window]), set()).add(item)
        self.items = [sorted(x) for x in found.values()]
        self.lengths = np.array([len(w) for w in found], np.int64)
        self.words = np.full((len(found), window), -1, np.int64)
        for k, w in enumerate(found):
            self.words[k, : len(w)] = w
        self.sizes = sorted({min(shingle, n) for n in self.lengths.tolist()})
        self.parts = [shingles(self.words[k, :n].astype(np.uint64), shingle) for k, n in enumerate(self.lengths)]
        self.table = np.unique(np.concatenate(self.parts)) if self.parts else np.zeros(0, np.uint64)

    def order_by_rarity(self, held_by: np.ndarray) -> None:
        """Keep of each window the shingle that the fewest documents hold, the first of equals."""
        at = [int(np.argmin(held_by[np.searchsorted(self.table, p)])) for p in self.parts]
        keys = np.array([p[k] for p, k in zip(self.parts, at, strict=True)], np.uint64)
        order = np.argsort(keys, kind="stable")
        self.key, self.window_of, self.offset = keys[order], order, np.array(at, np.int64)[order]
        self.parts = None

    def coded(self, text: str) -> np.ndarray:
        words = words_of(text)
        get = self.codes.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def grams(self, codes: np.ndarray):
        """(positions, hashes) of the runs that hold only words of the items."""
        for size in self.sizes:
            if len(codes) < size:
                continue
            known = np.convolve(codes >= 0, np.ones(size, np.int64), "valid") == size
            at = np.flatnonzero(known)
            if len(at):
                yield at, runs(codes.astype(np.uint64), size)[at]

    def spans(self, codes: np.ndarray):
        """(starts, windows) of the windows that occur."""
        starts, windows = [], []
        for at, h in self.grams(codes):
            lo, hi = np.searchsorted(self.key, h, "left"), np.searchsorted(self.key, h, "right")
            counts = hi - lo
            some = np.flatnonzero(counts)
            for part in np.array_split(some, max(1, int(counts.sum()) // 200_000)):
                n = counts[part]
                if not len(part):
                    continue
                rows = np.repeat(lo[part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                w = self.window_of[rows]
                start = np.repeat(at[part], n) - self.offset[rows]
                ok = (start >= 0) & (start + self.lengths[w] <= len(codes))
                w, start = w[ok], start[ok]
                reach = np.arange(self.words.shape[1])
                there = codes[np.minimum(start[:, None] + reach, max(len(codes) - 1, 0))]
                same = ((there == self.words[w]) | (reach >= self.lengths[w][:, None])).all(1)
                starts.append(start[same])
                windows.append(w[same])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(windows)


def _held_by(docs: DataFrame, block, column: str) -> np.ndarray:
    """How many documents hold each shingle of the block; one row per shingle and task is moved."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batch: pa.RecordBatch):
        b, total = shared.value, np.zeros(len(shared.value.table), np.int64)
        for text in texts_of(batch, column):
            for _, h in b.grams(b.coded(text)):
                h = np.unique(h)
                at = np.searchsorted(b.table, h)
                at[at == len(b.table)] = 0
                total[at[b.table[at] == h]] += 1
        some = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["at", "n"])

    counts = map_batches(docs.select(column), count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    held = np.zeros(len(block.table), np.int64)
    for row in counts.toLocalIterator():  # at most one row per shingle of the block
        held[row.at] = row.n
    return held


def _blocks(items: DataFrame, item_id: str, column: str, limit: int):
    """Items as (id, text) lists of at most `limit` bytes of text each; a larger item is a block alone."""
    block, size = [], 0
    rows = items.select(F.col(item_id).cast("string").alias("i"), F.coalesce(F.col(column), F.lit("")).alias("t"))
    for row in rows.where("i is not null").toLocalIterator():
        if block and size + len(row.t) * 4 > limit:
            yield block
            block, size = [], 0
        block.append((row.i, row.t))
        size += len(row.t) * 4
    if block:
        yield block


def hits(docs: DataFrame, items: DataFrame, column: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` with `n_words`, `hit_spans` (array of start, end word) and `hit_items` (item ids as strings, sorted).

    The items are a stated query set: blocks of at most `block_bytes` of them are sent to all
    documents, so what is broadcast is bounded whatever their number. Each block takes two passes,
    one that counts and one that matches, and no row of a document is shuffled.

    Null and empty texts have no words and no hits; an item without words or id has no window;
    repeated items and equal item texts each count; repeated documents each get their own row.
    Columns of `docs` with the names of the results are replaced.
    """
    spark: SparkSession = docs.sparkSession
    names = ["n_words", "hit_spans", "hit_items"]
    plain = docs.drop(*names)
    out = plain.withColumns({"n_words": F.lit(0).cast("long"), "hit_spans": F.array().cast("array<struct<start:long,end:long>>"), "hit_items": F.array().cast("array<string>")})
    first = True
    for items_block in _blocks(items, item_id, item_text, block_bytes) if items is not None else ():
        block = Windows(items_block, window, shingle)
        if not len(block.table):
            continue
        block.order_by_rarity(_held_by(plain, block, column))
        out = _matched(out, spark.sparkContext.broadcast(block), column)
        first = False
    if first:
        out = _matched(out, spark.sparkContext.broadcast(None), column)
    return out


def _matched(docs: DataFrame, shared, column: str) -> DataFrame:
    schema = docs.schema

    def match(batch: pa.RecordBatch):
        block = shared.value
        n_words, spans, ids = [], [], []
        old_spans, old_items = batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist()
        for k, text in enumerate(texts_of(batch, column)):
            codes = block.coded(text) if block else np.zeros(len(words_of(text)))
            n_words.append(len(codes))
            found, items = {(s["start"], s["end"]) for s in old_spans[k]}, set(old_items[k])
            if block:
                starts, windows = block.spans(codes)
                found |= _united(starts, starts + block.lengths[windows])
                for w in np.unique(windows):
                    items.update(block.items[w])
            spans.append([{"start": a, "end": b} for a, b in sorted(found)])
            ids.append(sorted(items))
        new = {"n_words": pa.array(n_words, pa.int64()), "hit_items": pa.array(ids, pa.list_(pa.string())), "hit_spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))}
        return pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names], list(batch.schema.names))

    return map_batches(docs, match, schema, 1000)


def _united(starts: np.ndarray, ends: np.ndarray) -> set[tuple[int, int]]:
    """Overlapping spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts.tolist(), ends.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return set(out)


def n_hit(spans: str = "hit_spans"):
    """Column: words inside any span, spans of several blocks counted once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    return F.aggregate(
        F.array_sort(F.col(spans)),
        start,
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(acc["to"], s["start"]))).alias("n"), F.greatest(acc["to"], s["end"]).alias("to")),
        lambda acc: acc["n"],
    )


def report(found: DataFrame) -> DataFrame:
    """The digest of `hits`: n_words, n_hit, n_items, items_sha256 and contaminated for each document."""
    hit = found.withColumn("n_hit", n_hit())
    return hit.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return report(hits(docs, table(spark, sf_dir, "benchmark")))


ORACLE = r"""
with lo as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
it as (select cast(item_id as varchar) item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark where item_id is not null),
win as (select distinct item, least(13, len(w)) n, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') g
        from (select item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) s from it where len(w) > 0)),
lens as (select distinct n from win),
dw as (select doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') g
       from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) s from lo, lens where len(w) >= n)),
m as (select dw.doc_id, dw.n, dw.s, win.item from dw join win on dw.g = win.g and dw.n = win.n),
h as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(s, s + n)) p from (select distinct doc_id, s, n from m)) group by 1),
i as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) ids from (select distinct doc_id, item from m) group by 1)
select lo.doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items, sha256(coalesce(ids, '')) items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from lo left join h using (doc_id) left join i using (doc_id)
"""

QUERIES = {"op7_decontaminate": op7_decontaminate}
ORACLES = {"op7_decontaminate": ORACLE}
