from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from llm.mix import mixed, seats


def plain_targets(sizes, weights, repeats):
    left, total, out = dict(sizes), sum(sizes.values()), {}
    while True:
        level = (total - sum(out.values())) / sum(weights[s] for s in left) if left else 0
        over = [s for s in left if weights[s] * level >= repeats * sizes[s]]
        if not over:
            return out | {s: weights[s] * level for s in left}
        for s in over:
            out[s] = repeats * left.pop(s)


def plain_seats(weights, n, most):
    won = [0] * len(weights)
    for _ in range(min(n, sum(most))):
        k = max((k for k in range(len(weights)) if won[k] < most[k]), key=lambda k: (weights[k] / (2 * won[k] + 1), -k))
        won[k] += 1
    return won


def test_highest_quotients(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for g in range(12):
        w = [float(x) for x in rng.integers(1, 10 ** int(rng.integers(1, 5)), int(rng.integers(1, 30)))]
        n = int(rng.integers(0, 300))
        most = [int(x) for x in rng.integers(0, n + 2, len(w))] if g % 2 else [n] * len(w)
        n = min(n, sum(most))
        rows += [(g, k, x, sum(w), n, m) for k, (x, m) in enumerate(zip(w, most, strict=True))]
        want |= {(g, k): q for k, q in enumerate(plain_seats(w, n, most))}
    parties = spark.createDataFrame(rows, "g int, k int, w double, total double, n long, most long")
    got = {(r.g, r.k): r.quota for r in seats(parties, ["g"], "w", F.col("total"), F.col("n"), F.col("most"), [F.col("k")]).collect()}
    assert got == want


def test_targets_and_taken(spark):
    rng = np.random.default_rng(9)
    rows = [(k, " ".join(["w"] * int(rng.integers(0, 120))), rng.choice(["b", "a", "é", "tiny", None], p=[0.4, 0.2, 0.2, 0.05, 0.15])) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixed(docs).collect()
    assert sorted(got) == sorted(mixed(docs.repartition(7)).collect())
    by, sizes = defaultdict(int), defaultdict(int)
    source = {k: s for k, _, s in rows}
    for r in got:
        assert r.size == len((rows[r.doc_id][1] or "").split()) and 0 <= r.taken <= 3 * r.size
        by[source[r.doc_id]] += r.taken
        sizes[source[r.doc_id]] += r.size
    order = sorted(s for s in sizes if s is not None) + [None]
    want = plain_targets(sizes, {s: k % 3 + 1 for k, s in enumerate(order)}, 3)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 and abs(by[s] - want[s]) <= 16


def test_odd_rows(spark, odd, none):
    got = mixed(odd).collect()
    assert len(got) == 9 and all(r.taken <= 3 * r.size for r in got)
    assert mixed(none).count() == 0 and mixed(odd.where("doc_id = 2")).first().taken == 0
