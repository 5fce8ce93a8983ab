"""Periodic runs of words: suffix trees of a text and its reversal, and the Lyndon roots of its runs."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import SPACED, map_batches, runs, table, texts_of

#: A run is at least so many words long and at least so many times its period.
LEAST, TIMES = 6, 4
#: Words of the grams by which stretches that cannot hold a run are passed over.
GRAM = 4
_FIND = re.compile(SPACED)
_BLOCK = 32


class Lce:
    """Longest common extensions of a sequence: Ukkonen's suffix tree, its Euler tour, and minima of it.

    `of(i, j)` gives for arrays of positions how many symbols agree from both on: the depth of the lowest
    common ancestor of two leaves, which is the least depth on the tour between them. Minima come from the
    borders of blocks and a sparse table over whole blocks, so an answer takes constant time and the memory
    grows with the sequence only. `order` has the suffixes by symbols, `backward` (unless `orders` is false) by
    symbols in reverse, the shorter of two that agree first in both.
    """

    def __init__(self, symbols: list[int], orders: bool = True):
        self.n = len(symbols)
        self._first = np.zeros(self.n + 1, np.int64)
        self.order: list[int] = []
        self.backward: list[int] = []
        tour = self._toured(*self._grown([*symbols, -1]), orders)
        pad = -len(tour) % _BLOCK
        self._tour = np.concatenate([tour, np.full(pad, np.iinfo(np.int64).max)])
        blocks = self._tour.reshape(-1, _BLOCK)
        self._ahead = np.minimum.accumulate(blocks, 1).ravel()
        self._behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        self._table = [blocks.min(1)]
        while 2 ** len(self._table) <= len(blocks):
            last, half = self._table[-1], 2 ** (len(self._table) - 1)
            self._table.append(np.minimum(last[:-half], last[half:]))

    @staticmethod
    def _grown(s: list[int]):
        """Ukkonen: symbol by symbol, the tree of all suffixes so far; the last symbol occurs only once."""
        start, end, link, kids = [0], [0], [0], [{}]
        node, edge, depth, pending = 0, 0, 0, 0
        total = len(s)
        for i, c in enumerate(s):
            open_link = 0
            pending += 1
            while pending:
                if not depth:
                    edge = i
                below = kids[node]
                child = below.get(s[edge])
                if child is None:
                    below[s[edge]] = len(start)
                    start.append(i), end.append(total), link.append(0), kids.append(None)
                    if open_link:
                        link[open_link] = node
                    open_link = node
                else:
                    at = start[child]
                    width = end[child] - at
                    if depth >= width:
                        edge, depth, node = edge + width, depth - width, child
                        continue
                    if s[at + depth] == c:
                        depth += 1
                        if open_link:
                            link[open_link] = node
                        break
                    parted = len(start)
                    start.append(at), end.append(at + depth), link.append(0)
                    start[child] = at + depth
                    kids.append({s[at + depth]: child, c: parted + 1})
                    start.append(i), end.append(total), link.append(0), kids.append(None)
                    below[s[edge]] = parted
                    if open_link:
                        link[open_link] = parted
                    open_link = parted
                pending -= 1
                if node:
                    node = link[node]
                elif depth:
                    depth -= 1
                    edge = i - pending + 1
        return start, end, kids

    def _toured(self, start: list[int], end: list[int], kids: list, orders: bool) -> np.ndarray:
        """Depths along the Euler tour; fills the leaves' places on it and the suffixes in both orders."""
        total, tour, first, order = self.n + 1, [], self._first, self.order
        stack = [(0, 0)]
        while stack:
            x, depth = stack.pop()
            tour.append(depth)
            if x < 0:
                continue
            below = kids[x]
            if below is None:
                first[total - depth] = len(tour) - 1
                order.append(total - depth)
                continue
            for symbol in sorted(below, reverse=True):
                child = below[symbol]
                stack.append((-1, depth))
                stack.append((child, depth + end[child] - start[child]))
        stack = [(0, 0)] if orders else []
        while stack:
            x, depth = stack.pop()
            below = kids[x]
            if below is None:
                self.backward.append(total - depth)
                continue
            for symbol in sorted(below):  # greatest first, but the end of the text before all
                if symbol >= 0:
                    stack.append((below[symbol], depth + end[below[symbol]] - start[below[symbol]]))
            if -1 in below:
                stack.append((below[-1], depth + end[below[-1]] - start[below[-1]]))
        return np.array(tour, np.int64)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self._first[i], self._first[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        low, high = a // _BLOCK, b // _BLOCK
        out = np.minimum(self._behind[a], self._ahead[b])
        between = high - low - 1
        for level, minima in enumerate(self._table):
            here = (between >= 1 << level) & (between < 2 << level)
            if here.any():
                out[here] = np.minimum(out[here], np.minimum(minima[low[here] + 1], minima[high[here] - (1 << level)]))
        same = np.flatnonzero(low == high)
        if len(same):
            x, least = a[same], self._tour[a[same]]
            for _ in range(_BLOCK - 1):
                x = np.minimum(x + 1, b[same])
                least = np.minimum(least, self._tour[x])
            out[same] = least
        return out


def _roots(order: list[int]) -> np.ndarray:
    """For every position the end of the longest Lyndon word from it: the next smaller suffix."""
    n = len(order) - 1
    rank = [0] * (n + 1)
    for r, suffix in enumerate(order):
        rank[suffix] = r
    out, stack = [0] * n, [n]
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(symbols: list[int], least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """All runs as rows (start, length, period), by start and period.

    Every run holds a Lyndon word of its period's length that is the longest from its place, in the order
    of the symbols or in the reverse one; so the longest Lyndon word of each place is extended to both
    sides for as long as words one period apart agree.
    """
    n = len(symbols)
    if n < least:
        return np.zeros((0, 3), np.int64)
    ahead, behind = Lce(symbols), Lce(symbols[::-1], orders=False)
    found = []
    for order in (ahead.order, ahead.backward):
        end = _roots(order)
        i = np.flatnonzero((end - np.arange(n)) * times <= n)
        period = end[i] - i
        left = behind.of(n - i, n - i - period)
        length = period + left + ahead.of(i, i + period)
        long = (length >= least) & (length >= times * period)
        found.append(np.stack([(i - left)[long], length[long], period[long]], 1))
    found = np.unique(np.concatenate(found), axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(ids: np.ndarray, least: int = LEAST, times: int = TIMES, gram: int = GRAM) -> list[tuple[int, int]]:
    """Stretches (start, end) outside of which no run lies, each with a word to spare at both sides.

    In a run of period q every gram but those of the first q words also starts q words before. So for every
    power of two only rows of grams that lie no further apart and are long enough can belong to a run.
    """
    n = len(ids)
    if gram >= least or n < least:
        return [(0, n)] if n >= least else []
    h = runs(ids.astype(np.uint64), gram)
    order = np.argsort(h, kind="stable")
    again = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    place, gap = order[again + 1], order[again + 1] - order[again]
    near = gap <= n // times
    place, gap = place[near], gap[near]
    by_place = np.argsort(place)
    place, gap = place[by_place], gap[by_place]
    out, scale = [], 1
    while scale < 2 * max(n // times, 1):
        turn = least // times  # the periods around it need the fewest grams
        periods = {min(max(q, scale // 2 + 1), scale) for q in (1, turn, turn + 1)}
        need = max(min(max(least, times * q) - q - gram + 1 for q in periods), 1)
        if len(place) < need and scale > turn:
            break
        near = place[gap <= scale]
        turns = np.flatnonzero(np.diff(near, prepend=-2, append=n + 2) != 1)
        lengths = np.diff(turns)
        for k in np.flatnonzero(lengths >= need).tolist():
            a = int(near[turns[k]])
            out.append((max(a - scale - 1, 0), min(a + int(lengths[k]) + gram, n)))
        scale *= 2
    joined: list[tuple[int, int]] = []
    for a, b in sorted(out):
        if joined and a <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    return joined


def word_runs(words: list[str], least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """All runs of a text's words as rows (start, length, period), by start and period."""
    known: dict[str, int] = {}
    ids = [known.setdefault(w, len(known)) for w in words]
    found = []
    for a, b in stretches(np.array(ids, np.int64), least, times):
        r = runs_of(ids[a:b], least, times)
        # what ends where the stretch is cut is a part of something that is found elsewhere or too short
        r = r[((r[:, 0] > 0) | (a == 0)) & ((r[:, 0] + r[:, 1] < b - a) | (b == len(ids)))]
        r[:, 0] += a
        found.append(r)
    found = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def collapsed(words: list[str], found: np.ndarray) -> list[str]:
    """The words without those that a run holds after its first period."""
    if not len(found):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST, times: int = TIMES, edit: Callable[[object, list[str]], list[str]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the periodic runs of every text and the text without repeats.

    A run is a stretch of words that are equal one smallest period apart, of at least `least` words and
    `times` periods, which no neighbouring word extends; `runs` holds them by start and period, starts in
    words from 0. `collapsed` has the words, one space apart, without those that any run holds after its
    first period. `edit(doc_id, words)` may change the words first.

    Null, empty and blank texts have no words and no runs. Rows are judged one by one, so repeated rows,
    repeated or null ids and ties change nothing; no rows give no rows; other columns are left out. Trees
    are built only over stretches that may hold a run; of a very long text whose words are all periodic
    they take about 600 bytes a word in the task that has the row.
    """

    def find(batch: pa.RecordBatch):
        n, flat, sizes, left = [], [], [], []
        for d, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
            words = _FIND.findall(t)
            if edit:
                words = edit(d, words)
            found = word_runs(words, least, times)
            n.append(len(words))
            flat.append(found)
            sizes.append(len(found))
            left.append(" ".join(collapsed(words, found)))
        rows = np.concatenate(flat) if flat else np.zeros((0, 3), np.int64)
        rows = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], fields=list(_RUN))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, rows), pa.array(left, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, find, f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def strongest(runs_column: str = "runs"):
    """Column: the run of greatest length over period, compared exactly; of equals the first, then the shortest period."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")

    def better(best, run):
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs_column, none, better)


def stretched(doc_id: object, words: list[str]) -> list[str]:
    """The change of the query's contract: one document in ten becomes periodic from some word on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=stretched).withColumn("_best", strongest())
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = {c: F.col(f"_best.{c}") for c in ("start", "length", "period")}
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in best],
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: crc32 bit by bit: for each byte one step that mixes it in and eight that shift.
CRC32 = """list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(range(0, length(hex(encode({0}))) // 2),
  lambda k: list_prepend(('0x' || substr(hex(encode({0})), 2 * k + 1, 2))::bigint, [-1::bigint, -1, -1, -1, -1, -1, -1, -1])))),
  lambda c, x: case when x >= 0 then xor(c, x) when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)"""

ORACLE = rf"""
with d as (select row_number() over () r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w, xor({CRC32.format("doc_id::varchar")}, 4294967295) h from documents),
e as (select *, len(w) n, h // 10 g from d),
f as (select *, g % greatest(n, 1) a, 1 + (n - g % greatest(n, 1)) // (3 + g % 8) p from e),
t as (select r, doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(0, n), lambda i: w[1 + case when i >= a then a + (i - a) % p else i end]) else w end w from f),
x as (select r, n, unnest(range(0, n)) i, unnest(w) w from t),
m as (select x.r, y.i - x.i q, x.i from x join x y on x.r = y.r and x.w = y.w and y.i > x.i and 4 * (y.i - x.i) <= x.n),
s as (select r, q, min(i) s, count(*) + q l from (select *, i - row_number() over (partition by r, q order by i) k from m) group by r, q, k),
u as (select r, s, l, min(q) q from s where l >= 6 and l >= 4 * q group by r, s, l),
gone as (select distinct r, unnest(range(s + q, s + l)) i from u),
kept as (select r, string_agg(w, ' ' order by i) k from x anti join gone using (r, i) group by r),
a as (select r, count(*) n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' order by s, q) lines from u group by r),
b as (select r, s, l, q from u qualify row_number() over (partition by r order by l / q desc, s, q) = 1)
select doc_id, coalesce(n_runs, 0)::bigint n_runs, b.s::bigint "start", b.l::bigint length, b.q::bigint period, (1000 * b.l // b.q)::bigint exponent_milli,
  sha256(coalesce(lines, '')) runs_sha256, sha256(coalesce(k, '')) collapsed_sha256
from t left join a using (r) left join b using (r) left join kept using (r)
"""

QUERIES = {"op13_periodic": op13_periodic}
ORACLES = {"op13_periodic": ORACLE}
