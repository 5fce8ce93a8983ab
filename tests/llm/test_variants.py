import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from llm.variants import gaps, misspelt, neighbours, numbered, spelling_groups, word_counts


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(counts, times=10):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return near, sorted(out)


def made(rng, n, letters="abé"):
    words = {"".join(rng.choice(list(letters), int(rng.integers(0, 8)))) for _ in range(n)}
    return {w: int(10 ** rng.uniform(0, 4)) for w in words}


def frame(spark, counts, parts=5):
    return spark.createDataFrame(list(counts.items()), "word string, n long").repartition(parts)


def test_groups_against_all_pairs(spark):
    counts = made(np.random.default_rng(1), 500)
    near, want = plain(counts)
    assert sorted(tuple(r) for r in spelling_groups(frame(spark, counts)).collect()) == want
    got = Counter((r.word, r.near) for r in neighbours(frame(spark, counts)).collect())
    assert got == Counter((w, v) for w, vs in near.items() for v in vs)  # each exactly once


def test_nodes_are_prefixes(spark):
    """Over many partitions a node number stands for one prefix and a prefix has one node."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        counts = made(np.random.default_rng(2), 300, "ab") | {"a" * k: 5 for k in range(1, 60)}
        paths, stands = numbered(frame(spark, counts), "word")
        rows = paths.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert stands
    node = {}
    for r in rows:
        for depth, x in enumerate(r.nodes):
            assert node.setdefault(stands.get(x, x), r.word[:depth]) == r.word[:depth]
    assert len(node) == len({r.word[:k] for r in rows for k in range(len(r.word) + 1)})
    assert all(r.nodes[-1] not in stands for r in rows)
    assert [r.word for r in sorted(rows, key=lambda r: r.nodes[-1])] == sorted(counts)


def test_words_of_documents(spark, odd, none):
    rows = [(k if k % 5 else None, " ".join(["Gräfin-Tausende", "ÀBCDEFG àbcdefg", "sixsix", "international"][: k % 5]), k) for k in range(400)]
    counts = Counter()
    for d, t, _ in rows:
        for w in t.replace("-", " ").split():
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += len(w) >= 7
    counts = {w: n for w, n in counts.items() if n >= 2}
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    words = word_counts(docs, edit=misspelt)
    assert {r.word: r.n for r in words.collect()} == counts and len(counts) > 5
    assert sorted(tuple(r) for r in spelling_groups(words).collect()) == plain(counts)[1]
    assert {r.word for r in word_counts(odd, least_chars=3, least_places=2).collect()} >= {"one", "two", "three"}
    assert spelling_groups(word_counts(none)).count() == 0


def test_very_long_words(spark):
    long = "ab" * 50_000
    counts = {long: 100, long + "a": 5, long[:-1]: 1, "b" + long[1:]: 2}
    assert sorted(tuple(r) for r in spelling_groups(frame(spark, counts)).collect()) == plain(counts)[1]


def test_pairs_of_nodes_stay_small(spark):
    """However many words share a beginning, a pair of nodes holds a word a letter."""
    counts = {f"common{a}{b}": 2 for a in "abcdefgh" for b in "abcdefgh"}
    _, pairs = gaps(frame(spark, counts))
    assert pairs.groupBy("prefix", "suffix").count().agg(F.max("count")).first()[0] <= 9
