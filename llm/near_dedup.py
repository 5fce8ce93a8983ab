"""Near-duplicate documents by BagMinHash signatures, banding and verified multiset overlap."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import WordHashes, kept, map_batches, mixed, shingles, table, texts_of

#: Words of a shingle, least similarity, bands and rows of a band. Two texts of similarity 0.8 share no
#: band once in 1,100 pairs, those of 0.5 share one 14 times in a hundred.
SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 38, 8
#: So many ids, of eight bytes each, are sent to all tasks at most.
BROADCAST_IDS = 1 << 20
#: Texts of a batch that are decoded at once, and distinct shingles of texts that are signed at once.
SLICE, HELD_SHINGLES = 1000, 100_000
_ONE = np.uint64(1)


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 53 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) / 9007199254740992.0


def _times(a: int, b: int) -> np.uint64:
    return np.uint64(a * b & 0xFFFFFFFFFFFFFFFF)


def bag_signatures(bags: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """BagMinHash signatures of bags (distinct hashes, counts), one row of `size` values each.

    A weight is discretised into unit levels, grouped in dyadic blocks [0,1), [1,2), [2,4), ... For
    every hash and block a Poisson process of rate size * width sends points in order of time; a point
    falls on a register and, by halving the block down to one level, on a level, and counts if that
    level lies below the weight. A register keeps the key of its earliest point, so two bags agree on
    one with the chance sum(min) / sum(max) of their weights. A process ends when its time passes the
    latest register of its bag.
    """
    n = len(bags)
    best_time = np.full(n * size, np.inf)
    best_key = np.zeros(n * size, np.uint64)
    owner, seed, low, width, weight = [], [], [], [], []
    for k, (h, c) in enumerate(bags):
        block, first, wide = 0, 0, 1
        live = np.ones(len(h), bool)
        while live.any():
            owner.append(np.full(int(live.sum()), k))
            seed.append(mixed(h[live] + _times(block + 1, 0xD1B54A32D192ED03)))
            low.append(np.full(int(live.sum()), first, np.int64))
            width.append(np.full(int(live.sum()), wide, np.int64))
            weight.append(c[live])
            block, first, wide = block + 1, first + wide, wide if block == 0 else wide * 2
            live = c > first
    if not owner:
        return best_key.reshape(n, size)
    owner, seed, low, width, weight = (np.concatenate(x) for x in (owner, seed, low, width, weight))
    time, point = np.zeros(len(owner)), 0
    limit = np.full(n, np.inf)
    while len(owner):
        point += 1
        draw = mixed(seed + _times(point, 0x9E3779B97F4A7C15))
        time = time - np.log(_uniform(draw)) / (size * width)
        stay = time < limit[owner]
        if not stay.all():
            owner, seed, low, width, weight, time, draw = (x[stay] for x in (owner, seed, low, width, weight, time, draw))
        place = mixed(draw ^ np.uint64(0xA0761D6478BD642F))
        register = (place % np.uint64(size)).astype(np.int64)
        level = low + ((place >> np.uint64(32)) & (width.astype(np.uint64) - _ONE)).astype(np.int64)
        counts = level < weight
        at, t, key = (owner * size + register)[counts], time[counts], draw[counts]
        better = t < best_time[at]
        at, t, key = at[better], t[better], key[better]
        order = np.argsort(-t, kind="stable")  # the earliest is written last
        best_time[at[order]], best_key[at[order]] = t[order], key[order]
        if point < 8 or point % 8 == 0:
            limit = best_time.reshape(n, size).max(1)
    return best_key.reshape(n, size)


def bag_of(text: str, hashes: WordHashes, words: int = SHINGLE) -> np.ndarray:
    """Sorted shingle hashes of a text in lower case, repeats kept."""
    return np.sort(shingles(hashes.of(text.lower().split()), words))


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted bags; 1 for two empty ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    x, cx = np.unique(a, return_counts=True)
    y, cy = np.unique(b, return_counts=True)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int(np.minimum(cx, cy[at])[y[at] == x].sum())
    return both / (len(a) + len(b) - both)


def components(links: DataFrame) -> DataFrame:
    """(id, class): the least id of the connected component of every id in `links` (a, b).

    Each round every id takes the least class among its neighbours and then its class's class. A hub's
    neighbours are met in joins that Spark splits, and least classes are taken before the shuffle.
    """
    both = kept(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    classes = kept(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("class")), "classes")
    while True:
        near = both.join(classes.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("class").alias("near"))
        step = classes.join(near, classes["id"] == near["a"]).select("id", "class", F.least("class", "near").alias("to"))
        further = classes.select(F.col("id").alias("to"), F.col("class").alias("further"))
        step = kept(step.join(further, "to").select("id", F.least("to", "further").alias("class"), (F.least("to", "further") < F.col("class")).alias("moved")), "classes")
        classes = step.select("id", "class")
        if step.where("moved").isEmpty():
            return classes


def _signed(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(id, _key, _bands): a digest of the bag and a hash of each band of its signature."""
    hashes = WordHashes()

    def sign(batch: pa.RecordBatch):
        keys, flat = [], []
        texts = texts_of(batch)
        bags, held = [], 0

        def flush():
            nonlocal held
            s = bag_signatures(bags, bands * rows).reshape(len(bags), bands, rows)
            h = np.zeros((len(bags), bands), np.uint64)
            for r in range(rows):
                h = mixed(h + s[:, :, r] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r))
            flat.append(mixed(h + np.arange(bands, dtype=np.uint64)))
            bags.clear()
            held = 0

        for t in texts:
            bag = bag_of(t, hashes, words)
            h, c = np.unique(bag, return_counts=True)
            keys.append(hashlib.md5(bag.tobytes()).digest())
            bags.append((h, c))
            held += len(h)
            if held > HELD_SHINGLES:
                flush()
        if bags:
            flush()
        values = np.concatenate(flat) if flat else np.zeros((0, bands), np.uint64)
        offsets = pa.array(np.arange(len(texts) + 1) * bands, pa.int32())
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(values.ravel().view(np.int64)))], ["id", "_key", "_bands"])

    return map_batches(docs, sign, "id long, _key binary, _bands array<long>", SLICE, hashes.clear)


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """(a, b, s): the exact overlap of the pairs' bags."""
    a = bags.select(F.col("id").alias("a"), F.col("bag").alias("_x"))
    b = bags.select(F.col("id").alias("b"), F.col("bag").alias("_y"))

    def compare(batch: pa.RecordBatch):
        x, y = (batch.column(c) for c in ("_x", "_y"))
        s = [overlap(np.asarray(p.values).view(np.uint64), np.asarray(q.values).view(np.uint64)) for p, q in zip(x, y, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(s, pa.float64())], ["a", "b", "s"])

    return map_batches(pairs.select("a", "b").join(a, "a").join(b, "b"), compare, "a long, b long, s double")


def _pair(x: str, y: str):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def _apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of different classes; who is in no class is one alone."""
    for side in ("a", "b"):
        named = classes.select(F.col("id").alias(side), F.col("class").alias(f"_{side}"))
        pairs = pairs.join(named, side, "left").withColumn(f"_{side}", F.coalesce(f"_{side}", side))
    return pairs.where("_a != _b").select("a", "b")


def _others(filed: DataFrame, checked: DataFrame, classes: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of a bucket that are in different classes, not compared yet and may reach the similarity.

    A bucket's main class is its centre's; only members outside it are joined with the whole bucket.
    The bounds leave room for rounding, as pairs of just the similarity count; who calls verifies exactly.
    """
    toward = checked.select("a", "b", "s").union(checked.select("b", "a", "s")).toDF("id", "centre", "s")
    members = filed.join(toward, ["id", "centre"], "left").join(classes, "id", "left")
    members = members.select("band", "id", F.when(F.col("id") == F.col("centre"), 1.0).otherwise(F.col("s")).alias("s"), F.coalesce("class", "id").alias("class"), "centre")
    main = members.where("id = centre").select("band", F.col("class").alias("main"))
    members = kept(members.join(main, "band"), "members")
    mixed_bands = members.where("class != main").select("band").distinct()
    members = members.join(mixed_bands, "band")
    # of a text's shingles those that any text of another class in question has
    held = bags.join(members.select("id", "class").distinct(), "id")
    flat = held.select("id", "class", F.explode("bag").alias("h")).groupBy("id", "class", "h").agg(F.count(F.lit(1)).alias("c"))
    common = flat.groupBy("h").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("h")
    common = flat.join(common, "h").groupBy("id").agg(F.sum("c").alias("common"))
    sizes = held.select("id", F.size("bag").alias("n")).join(common, "id")
    least = similarity / (1 + similarity)  # overlap over the sum of both sizes
    sizes = sizes.where(F.col("common") >= similarity * F.col("n") - 1e-6)
    members = kept(members.join(sizes, "id"), "members")
    # and those that any text of the bucket's main class has, for the members outside it
    outer = members.where("class != main").select("id", "main").distinct()
    inner = members.where("class = main").select("id", "main").distinct().join(flat.drop("class"), "id").select("main", "h").distinct()
    with_main = outer.join(flat.drop("class"), "id").join(inner, ["main", "h"]).groupBy("id", "main").agg(F.sum("c").alias("with_main"))
    x = members.where("class != main").join(with_main, ["id", "main"], "left").na.fill(0, ["with_main"])
    x = x.select("band", *[F.col(c).alias(f"x_{c}") for c in ("id", "s", "class", "n", "common", "with_main")])
    near = F.coalesce(F.abs(F.col("s") - F.col("x_s")) <= 1 - similarity + 1e-9, F.lit(True))
    shared = F.when(F.col("class") == F.col("main"), F.col("x_with_main")).otherwise(F.col("x_common"))
    bound = F.least("common", shared, "n", "x_n") >= least * (F.col("n") + F.col("x_n")) - 1e-6
    met = members.join(x, "band").where((F.col("class") != F.col("x_class")) & (F.col("id") != F.col("centre")) & near & bound)
    return met.select(*_pair("id", "x_id")).distinct().join(checked, ["a", "b"], "left_anti")


def near_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id, n_copies): documents linked by weighted Jaccard of at least `similarity`.

    class_id is the least id of all that are linked, directly or through others; n_copies the number
    of documents with the same bag of shingles. Words are what white space parts, in lower case; a
    text of fewer than `words` words is one shingle, and texts without words, null too, are copies of
    each other. Rows with a null id have no name to link: their class_id is null. Rows that repeat an id
    form one document per distinct text, named alike. No rows give no rows; other columns are left out.

    Equal bags become one representative. A bucket's centre is the representative in it that meets most
    others in all its buckets. Each representative is compared with the most met of its centres, then
    with the others that are not in its class yet; so most of a family is joined by a few stars. What
    is left are members of one bucket in different classes; of these all pairs are compared that can
    reach the similarity at all: their lengths, their similarities to the centre (1 - overlap is a
    metric), and how many of a text's shingles occur in any such text of another class bound it from above.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    nameless = docs.where("id is null").select(F.col("id").alias("doc_id"), F.col("id").alias("class_id"), F.lit(1).cast("long").alias("n_copies"))
    docs = docs.where("id is not null")
    signed = kept(_signed(docs, words, bands, rows), "signed")
    groups = signed.groupBy("_key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n_copies"), F.first("_bands").alias("_bands"))
    groups = kept(groups, "bags")
    filed = groups.select("id", F.explode("_bands").alias("band"))
    full = filed.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    filed = kept(filed.join(full, "band"), "buckets")
    known = filed.groupBy("id").agg(F.sum("n").alias("met"))
    centres = filed.join(known, "id").groupBy("band").agg(F.max(F.struct("met", (-F.col("id")).alias("id"))).alias("c")).select("band", (-F.col("c.id")).alias("centre"), "c.met")
    filed = kept(filed.select("band", "id").join(centres, "band"), "centres")
    wanted = kept(known.select("id"), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)  # else texts are shuffled by id
    hashes = WordHashes()

    def bag(batch: pa.RecordBatch):
        bags = [bag_of(t, hashes, words) for t in texts_of(batch)]
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in bags])]).astype(np.int32))
        flat = np.concatenate(bags).view(np.int64) if bags else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(offsets, pa.array(flat))], ["id", "bag"])

    bags = kept(map_batches(docs.join(wanted, "id"), bag, "id long, bag array<long>", SLICE, hashes.clear).dropDuplicates(["id"]), "bags")
    arms = filed.where("id != centre").groupBy("id", "centre").agg(F.max("met").alias("met"))
    best = arms.groupBy("id").agg(F.max(F.struct("met", "centre")).alias("c")).select("id", F.col("c.centre").alias("centre"))
    checked = kept(_verified(best.select(*_pair("id", "centre")).distinct(), bags), "stars")
    classes = components(checked.where(F.col("s") >= similarity))
    left = _apart(arms.select(*_pair("id", "centre")).distinct(), classes).join(checked, ["a", "b"], "left_anti")
    checked = kept(checked.union(_verified(left, bags)), "stars")
    links = checked.where(F.col("s") >= similarity).select("a", "b")
    classes = components(links)
    found = kept(_verified(_others(filed, checked, classes, bags, similarity), bags).where(F.col("s") >= similarity).select("a", "b"), "more")
    if not found.isEmpty():
        classes = components(links.union(found))
    named = groups.select("_key", "id", "n_copies").join(classes, "id", "left").select("_key", F.coalesce("class", "id").alias("class_id"), "n_copies")
    return signed.select(F.col("id").alias("doc_id"), "_key").join(named, "_key").drop("_key").unionByName(nameless)


def first_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`docs` with one document of each class, the one with the least id; rows without an id stay."""
    gone = near_classes(docs, text, doc_id).where("doc_id != class_id").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs[doc_id].cast("long") == gone["_gone"], "left_anti")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


QUERIES = {"op1_near_dedup": op1_near_dedup}
