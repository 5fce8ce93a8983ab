"""SimHash near-duplicates: fingerprints of word shingles, linked through vantage-point trees."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import SPACED, in_arrow, joined_on_hot, kept, map_batches, table
from llm.near_dedup import components

#: Words of a shingle, differing bits of a link, and the seed of the shingles' XXH64.
SHINGLE, BITS, SEED = 3, 2, 42
#: Fingerprints of a shard, shards at most (larger inputs have larger shards), and how many fingerprints
#: the tree of the shards is grown from, per shard.
SHARD, SHARDS, SAMPLE = 20_000, 4096, 32
#: A leaf of a tree inside a shard holds at most so many fingerprints, but for those no distance parts.
LEAF = 192
_FIND = re.compile(SPACED.encode())
_ROWS = 1 << 16


def fingerprint(text: str, words: int = SHINGLE) -> int:
    """64 bits; a bit is set if over half of the shingles' hashes have it."""
    found = _FIND.findall(text.encode("utf-8", "surrogatepass").lower())
    if not found:
        return 0
    size = min(words, len(found))
    hashed = (xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(found[k:] for k in range(size)), strict=False))
    n = len(found) - size + 1
    ones = np.zeros(64, np.int64)
    for done in range(0, n, _ROWS):
        h = np.fromiter(hashed, np.dtype("<u8"), min(_ROWS, n - done))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint long): one row per row; a null text counts as the empty one, whose bits are all 0."""

    def sign(batch: pa.RecordBatch):
        prints = np.array([fingerprint(t.as_py() or "", words) for t in batch.column("text")], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fingerprint"])

    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(docs, sign, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint long")


def distance(x: np.ndarray, y) -> np.ndarray:
    return np.bitwise_count(x ^ y).astype(np.int64)


class Tree:
    """A vantage-point tree of distinct fingerprints.

    A node parts its fingerprints by their distance from one of them, the near half from the far one. All
    within `bits` of a query lie in a child only if the query's distance from the vantage point is at most
    `bits` outside the child's least and greatest; else the triangle inequality cuts the branch.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        self.points = points.copy()
        self.nodes: list[tuple] = []  # leaf: (start, end); else (vantage, radius, near, far, ranges)
        self._grow(leaf)

    def _grow(self, leaf: int):
        todo = [(0, len(self.points), None, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            here = len(self.nodes)
            if parent is not None:
                self.nodes[parent][2 + side] = here
            part = self.points[a:b]
            split = self._split(part) if b - a > leaf else None
            if split is None:
                self.nodes.append([a, b])
                continue
            vantage, radius, d = split
            order = np.argsort(d > radius, kind="stable")
            self.points[a:b] = part[order]
            middle = a + int((d <= radius).sum())
            near, far = d[d <= radius], d[d > radius]
            self.nodes.append([vantage, radius, None, None, (int(near.min()), int(near.max()), int(far.min()), int(far.max()))])
            todo.append((middle, b, here, 1))
            todo.append((a, middle, here, 0))

    @staticmethod
    def _split(part: np.ndarray):
        """The vantage point of a few that parts most evenly with the widest spread, its radius and distances."""
        best = None
        for vantage in part[:: max(1, len(part) // 4)][:4]:
            d = distance(part, vantage)
            radius = int(np.median(d))
            radius -= radius == d.max()
            inside = int((d <= radius).sum())
            if 0 < inside < len(part):
                rank = (min(inside, len(part) - inside) * 8 // len(part), float(d.std()))
                if best is None or rank > best[0]:
                    best = (rank, vantage, radius, d)
        return best and best[1:]

    def leaves(self, queries: np.ndarray, bits: int, whole: bool = False) -> Iterator[tuple[int, np.ndarray]]:
        """(node, indices of queries) for each leaf that may hold a fingerprint within `bits` of the queries.

        `whole` takes a child to hold any fingerprint on its side of the radius, not only those it was grown from.
        """
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, q = todo.pop()
            if not len(q):
                continue
            if len(self.nodes[node]) == 2:
                yield node, q
                continue
            vantage, radius, near, far, (a, b, c, e) = self.nodes[node]
            if whole:
                a, b, c, e = 0, radius, radius + 1, 64
            d = distance(queries[q], vantage)
            todo.append((far, q[(d >= c - bits) & (d <= e + bits)]))
            todo.append((near, q[(d >= a - bits) & (d <= b + bits)]))

    def pairs(self, queries: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query indices, point indices) within `bits` bits, in blocks of bounded size."""
        for node, q in self.leaves(queries, bits):
            a, b = self.nodes[node]
            step = max(1, (1 << 21) // (b - a))
            for k in range(0, len(q), step):
                x, y = np.nonzero(np.bitwise_count(queries[q[k : k + step], None] ^ self.points[None, a:b]) <= bits)
                if len(x):
                    yield q[k : k + step][x], y + a


class Sets:
    """Disjoint sets over 0..n-1; joins arrays of pairs at once."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, x: np.ndarray) -> np.ndarray:
        r = self.up[x]
        while True:
            further = self.up[r]
            if np.array_equal(further, r):
                self.up[x] = r
                return r
            r = further

    def join(self, a: np.ndarray, b: np.ndarray):
        while len(a):
            a, b = self.root(a), self.root(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))


def _shards(prints: DataFrame, n: int, bits: int) -> DataFrame:
    """(shard, visits, print): every fingerprint in the shard it lies in, and in later ones it may have a link in.

    The shards are the leaves of a tree grown from a bounded sample, at most SHARDS * SAMPLE fingerprints;
    a shard holds all fingerprints of the table on its side of every radius.
    """
    shards = min(SHARDS, max(1, -(-n // SHARD)))
    sample = prints.orderBy(F.xxhash64("fingerprint")).limit(shards * SAMPLE).toPandas()["fingerprint"].to_numpy(np.int64)
    tree = Tree(np.sort(sample).view(np.uint64), SAMPLE)
    place = {node: k for k, node in enumerate(k for k, x in enumerate(tree.nodes) if len(x) == 2)}

    def route(batch: pa.RecordBatch):
        p = np.asarray(batch.column("fingerprint")).view(np.uint64)
        home = np.zeros(len(p), np.int32)
        for node, q in tree.leaves(p, 0, whole=True):
            home[q] = place[node]
        shard, who = [home], [np.arange(len(p))]
        for node, q in tree.leaves(p, bits, whole=True):
            q = q[home[q] < place[node]]
            shard.append(np.full(len(q), place[node], np.int32))
            who.append(q)
        visits = np.arange(sum(map(len, who))) >= len(p)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(shard)), pa.array(visits), pa.array(p[np.concatenate(who)].view(np.int64))], ["shard", "visits", "print"])

    return map_batches(prints.select("fingerprint"), route, "shard int, visits boolean, print long")


def links(prints: DataFrame, n: int, bits: int = BITS) -> DataFrame:
    """(a, b): links that join the same fingerprints as all pairs of at most `bits` differing bits do.

    `prints` has distinct fingerprints, about `n`. Each shard's own ones come first and grow a tree; own and
    visiting ones then look theirs up. Of the pairs found only those are handed on that join sets.
    """

    def look(batches: Iterator[pa.RecordBatch]):
        shard, own, tree, sets = None, [], None, None

        def out(a, b):
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

        def grown():
            nonlocal tree, sets, own
            tree, own = Tree(np.concatenate(own), LEAF), []
            sets = Sets(len(tree.points))
            for k in range(0, len(tree.points), _ROWS):
                for x, y in tree.pairs(tree.points[k : k + _ROWS], bits):
                    sets.join((x + k)[x + k < y], y[x + k < y])

        def closed():
            if own or tree is not None:
                if tree is None:
                    grown()
                root = sets.root(np.arange(len(tree.points)))
                moved = np.flatnonzero(root != np.arange(len(root)))
                yield out(tree.points[moved], tree.points[root[moved]])

        for batch in batches:
            s, v = np.asarray(batch.column("shard")), batch.column("visits").to_numpy(zero_copy_only=False)
            p = np.asarray(batch.column("print")).view(np.uint64)
            cuts = np.flatnonzero((np.diff(s) != 0) | (np.diff(v.view(np.int8)) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(s)], strict=True):
                if s[a] != shard:
                    yield from closed()
                    shard, own, tree, sets = s[a], [], None, None
                if not v[a]:
                    own.append(p[a:b])
                    continue
                if tree is None:
                    if not own:  # all rows of this shard only visit
                        continue
                    grown()
                first = np.full(b - a, -1)
                for x, y in tree.pairs(p[a:b], bits):
                    new = first[x] < 0
                    first[x[new]] = y[new]
                    sets.join(first[x], y)
                met = np.flatnonzero(first >= 0)
                yield out(p[a:b][met], tree.points[first[met]])
        yield from closed()

    routed = _shards(prints, n, bits).repartition("shard").sortWithinPartitions("shard", "visits")
    return in_arrow(routed, look, "a long, b long")


def near_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id): documents joined by fingerprints of at most `bits` differing bits.

    Words are what ASCII white space parts, A-Z in lower case; shingles are counted as often as they occur;
    a text of fewer than `words` words is one shingle. Null, empty and blank texts have the fingerprint zero
    and are linked like any other. `fingerprint` is 16 hexadecimal digits; component_id the least id of all
    that are joined, directly or through others. Rows with a null id take part, and get the least id of
    their component that is not null (null if there is none); repeated ids and rows stay rows of their own.
    Very long texts are hashed in blocks. No rows give no rows; other columns are left out.

    Equal fingerprints become one row first. All pairs of at most `bits` bits are found exactly, through
    shards of a vantage-point tree and a tree inside each (`links`); the documents of a very common
    fingerprint meet their component in several tasks.
    """
    signed = kept(fingerprints(docs, text, doc_id, words), "simhash-signed")
    prints = kept(signed.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")), "simhash-prints")
    classes = components(kept(links(prints, prints.count(), bits), "simhash-links"))
    placed = prints.join(classes.withColumnRenamed("id", "fingerprint"), "fingerprint", "left").withColumn("class", F.coalesce("class", "fingerprint"))
    least = placed.groupBy("class").agg(F.min("least").alias("component_id"))
    placed = kept(placed.join(least, "class").select("fingerprint", "n", "component_id"), "simhash-placed")
    out = joined_on_hot(signed, placed, "fingerprint", "n", by="doc_id")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))


QUERIES = {"op11_simhash": op11_simhash}
