"""Substring dedup: repeated windows found level by level, each level twice as long as the last."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import SPACED, WordHashes, joined_on_hot, kept, long_list, map_batches, mixed, runs, table, texts_of

#: Words of a window; the first level is of at most so many words.
WINDOW, SEED_WORDS = 35, 18
_FIND = re.compile(SPACED)
_OTHER = np.uint64(0xD1B54A32D192ED03)


def levels(window: int, seed: int) -> list[int]:
    """Lengths from the first level to `window`, each at most twice the one before."""
    out = [window]
    while out[0] > seed:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _least(x: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The least of every `width` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[: len(x) - step], x[step:])
        done += step
    return x


def stand_ins(h: np.ndarray, window: int, base: int, length: int) -> np.ndarray:
    """For every window the hash of its run of `length` words around its anchor.

    The anchor is the run of `base` words with the least hash, the first of equals; equal windows have
    it at the same place, so equal windows have equal stand-ins at every level. The last level's
    stand-in is the window itself.
    """
    if len(h) < window:
        return np.zeros(0, np.uint64)
    if length == window:
        return runs(h, window)
    first = runs(h, base)
    width = window - base + 1
    least = _least(first, width)
    if length == base:
        return least
    offset = np.full(len(least), -1, np.int64)
    for shift in range(width):
        offset[(offset < 0) & (first[shift : shift + len(least)] == least)] = shift
    return runs(h, length)[np.arange(len(least)) + np.minimum(offset, window - length)]


def checks(h: np.ndarray, window: int) -> np.ndarray:
    """A second hash of every window, from the words' hashes mixed anew. Windows that differ agree on both once in 2^128."""
    return runs(mixed(h ^ _OTHER), window)


def _counted(values: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    """Per text the distinct stand-ins and how often each one's run occurs in the text, out of pairs
    (stand-ins of some windows, all runs of that length)."""
    kinds, counts = [], []
    for some, every in values:
        some = np.unique(some)
        order = np.sort(every)
        kinds.append(some.view(np.int64))
        counts.append(np.searchsorted(order, some, "right") - np.searchsorted(order, some, "left"))
    return [long_list(kinds), long_list(counts)]


def _counted_pairs(values: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    """Per text the distinct pairs of a window's two hashes and how often each occurs in it."""
    kinds, others, counts = [], [], []
    for h, g in values:
        order = np.lexsort((g, h))
        h, g = h[order], g[order]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])[: len(h)])
        kinds.append(h[first].view(np.int64))
        others.append(g[first].view(np.int64))
        counts.append(np.diff(np.append(first, len(h))))
    return [long_list(kinds), long_list(counts), long_list(others)]


def _again(rows: DataFrame) -> DataFrame:
    """(_key, _alive): of each text the hashes that occur more than once in all rows (_key, _copies, h, n).
    Where the rows have a second hash g, both have to be equal, and _alive holds pairs.

    Counts are added up before they are moved; a hash of very many texts meets them in a join that
    Spark splits, never in a group.
    """
    by = [c for c in ("h", "g") if c in rows.columns]
    flat = rows.select("_key", "_copies", F.arrays_zip(*by, "n").alias("x")).select("_key", "_copies", F.explode("x").alias("x"))
    flat = flat.select("_key", *[F.col(f"x.{c}").alias(c) for c in by], (F.col("x.n") * F.col("_copies")).alias("n"))
    again = flat.groupBy(*by).agg(F.sum("n").alias("all")).where("all > 1").select(*by)
    alive = F.struct(*by) if len(by) > 1 else F.col("h")
    return flat.select("_key", *by).join(again, by).groupBy("_key").agg(F.collect_set(alive).alias("_alive"))


def repeated_windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, seed_words: int = SEED_WORDS) -> DataFrame:
    """`docs`' ids with n_words, n_removed, kept_text_sha256 and `removed` (array of start, end word).

    A word goes if it lies in a window of `window` words whose words also start anywhere else, in the
    same document or another. A null or empty text has no words and loses none; so does a text shorter
    than the window. Repeated rows are documents of their own and so repeat each other. No rows give
    no rows. Other columns are left out.

    Equal texts are worked on once, as (digest, number of copies). Level by level only windows whose
    stand-in occurs more than once go on to the level of twice the length, until the window itself is
    compared, by two hashes of 64 bits; it ends early when none is left. Very long texts are worked on whole.
    A text of very many copies is dealt over several tasks when its result goes back to them.
    """
    lengths = levels(window, seed_words)
    lengths = lengths if len(lengths) > 1 else lengths * 2
    base = lengths[0]
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("_key"), F.col(text).alias("text"))
    hashes = WordHashes()

    def first(batch: pa.RecordBatch):
        n_words, sha, found = [], [], []
        for t in texts_of(batch):
            words = _FIND.findall(t)
            n_words.append(len(words))
            sha.append(_sha(words))
            h = hashes.of(words)
            found.append((stand_ins(h, window, base, base), runs(h, base)))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_key"), pa.array(n_words, pa.int64()), pa.array(sha), *_counted(found)], ["doc_id", "_key", "n_words", "_sha", "h", "n"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = kept(map_batches(docs, first, f"doc_id {id_type}, _key binary, n_words long, _sha string, h array<long>, n array<long>"), "windows-first")
    copies = texts.where(F.col("n_words") >= window).groupBy("_key").agg(F.min("doc_id").alias("_one"), F.count(F.lit(1)).alias("_copies"))
    alive = _again(texts.where(F.size("h") > 0).select("_key", F.lit(1).cast("long").alias("_copies"), "h", "n")).join(copies, "_key")
    # one row of each text that has windows left, with its text; more only where whole rows repeat, whose counts are above one anyhow
    some = docs.alias("d").join(alive.alias("a"), (F.col("d._key") == F.col("a._key")) & F.col("d.doc_id").eqNullSafe(F.col("a._one")))
    some = kept(some.select("d._key", "d.text", "a._copies", "a._alive"), "windows-left")
    for before, length in zip(lengths, lengths[1:], strict=False):

        last = length == window

        def deeper(batch: pa.RecordBatch, before=before, length=length, last=last):
            found = []
            for t, live in zip(texts_of(batch), batch.column("_alive"), strict=True):
                h = hashes.of(_FIND.findall(t))
                starts = _living(h, window, base, before, live)
                # windows equal to one that lives live too, so their starts hold all its places
                found.append((runs(h, window)[starts], checks(h, window)[starts]) if last else (stand_ins(h, window, base, length)[starts], runs(h, length)))
            columns = _counted_pairs(found) if last else _counted(found)
            return pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_copies"), *columns], ["_key", "_copies", "h", "n", "g"][: 2 + len(columns)])

        kinds = "_key binary, _copies long, h array<long>, n array<long>" + (", g array<long>" if last else "")
        rows = kept(map_batches(some, deeper, kinds), f"windows-{length}")
        some = some.drop("_alive").join(_again(rows), "_key")
        if not last:
            some = kept(some, "windows-left")
            if some.isEmpty():
                break

    def cut(batch: pa.RecordBatch):
        n, sha, spans = [], [], []
        for t, live in zip(texts_of(batch), batch.column("_alive"), strict=True):
            words = _FIND.findall(t)
            starts = _repeated(hashes.of(words), window, live)
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            spans.append([{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()])
            n.append(int(gone.sum()))
            sha.append(_sha([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
        spans = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_copies"), pa.array(n, pa.int64()), pa.array(sha, pa.string()), spans], ["_key", "_copies", "n", "sha", "spans"])

    kinds = "_key binary, _copies long, n long, sha string, spans array<struct<start:long,end:long>>"
    removed = kept(map_batches(some.select("_key", "_copies", "text", "_alive"), cut, kinds).dropDuplicates(["_key"]), "removed")
    out = joined_on_hot(texts.select("doc_id", "_key", "n_words", "_sha"), removed, "_key", "_copies", "doc_id")
    return out.select("doc_id", "n_words", F.coalesce("n", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("sha", "_sha").alias("kept_sha256"), F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("removed"))


def _sha(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest()


def _living(h: np.ndarray, window: int, base: int, level: int, live: pa.ListScalar) -> np.ndarray:
    """Starts of the windows whose stand-ins at `level` are among those that live."""
    known = np.asarray(live.values, dtype=np.int64).view(np.uint64)
    return np.flatnonzero(np.isin(stand_ins(h, window, base, level), known))


def _repeated(h: np.ndarray, window: int, live: pa.ListScalar) -> np.ndarray:
    """Starts of the windows both of whose hashes are among the pairs that live."""
    pairs = live.values
    known, other = (np.asarray(pairs.field(c), dtype=np.int64).view(np.uint64) for c in ("h", "g"))
    order = np.argsort(known)
    known, other = known[order], other[order]
    v, g = runs(h, window), checks(h, window)
    low, high = np.searchsorted(known, v, "left"), np.searchsorted(known, v, "right")
    there = high > low
    there[there] = other[low[there]] == g[there]
    for k in np.flatnonzero(high > low + 1):  # two windows that meet by chance in the first hash
        there[k] = g[k] in other[low[k] : high[k]]
    return np.flatnonzero(there)


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_windows(table(spark, sf_dir, "documents")).drop("removed")


ORACLE = r"""
with d as (select doc_id, row_number() over () r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
g as (select r, s, array_to_string(w[s : s + 34], ' ') g from (select r, w, unnest(range(1, len(w) - 33)) s from d where len(w) >= 35)),
again as (select g from g group by g having count(*) > 1),
gone as (select distinct r, unnest(range(s, s + 35)) p from g join again using (g)),
kept as (select d.r, string_agg(w[p], ' ' order by p) k from (select r, w, unnest(range(1, len(w) + 1)) p from d) d anti join gone on d.r = gone.r and d.p = gone.p group by d.r),
n as (select r, count(*) n from gone group by r)
select doc_id, len(w)::bigint n_words, coalesce(n.n, 0)::bigint n_removed, sha256(coalesce(k, '')) kept_sha256
from d left join kept using (r) left join n using (r)
"""

QUERIES = {"op9_substrings": op9_substrings}
ORACLES = {"op9_substrings": ORACLE}
