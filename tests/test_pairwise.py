import random

import numpy as np
from pyspark.sql import functions as F

from skeinworks.operators import ranking as K


def fitted(diffs, ridge=1.0):
    """Newton's method on plain arrays of all pairs."""
    x = np.array(diffs)
    scale = np.sqrt((x**2).mean(axis=0))
    x = x / scale
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(x @ w))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ p - ridge * w)
    return w / scale


def made(n, groups, seed=4):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = r.uniform(0, 5), r.uniform(-1, 1)
        rows.append((groups(i), int(r.random() < 1 / (1 + np.exp(3 - a - 2 * b))) + (i % 11 == 0), a, b))
    return rows


def pairs_of(rows):
    return [(x[2] - z[2], x[3] - z[3]) for x in rows for z in rows if x[0] == z[0] and x[1] > z[1]]


def test_small_groups_give_all_pairs(spark):
    rows = made(120, lambda i: f"g{i % 9}")
    d = spark.createDataFrame([*rows, ("g0", None, 1.0, 1.0), ("g0", 2, None, 1.0), (None, 2, 1.0, 1.0)], "g string, y int, a double, b double")
    got = sorted((round(p["d0"], 9), round(p["d1"], 9), p["weight"]) for p in K.preference_differences(d, "g", "y", ["a", "b"]).collect())
    assert got == sorted((round(p, 9), round(q, 9), 1.0) for p, q in pairs_of(rows))
    w, losses = K.fit_logistic_ranker(d, "g", "y", ["a", "b"])
    assert np.allclose([w["a"], w["b"]], fitted(pairs_of(rows)), rtol=1e-3)
    assert all(x >= z for x, z in zip(losses, losses[1:])) and losses[-1] < losses[0]


def test_large_group_is_sampled_without_bias(spark):
    rows = made(1000, lambda i: "hot")
    d = spark.createDataFrame(rows, "g string, y int, a double, b double").repartition(5)
    held, K.WINNERS_A_COPY = K.WINNERS_A_COPY, 1  # several copies of the losing rows
    try:
        drawn = K.preference_differences(d, "g", "y", ["a", "b"]).agg(F.sum("weight"), F.count("*")).first()
        w, _ = K.fit_logistic_ranker(d, "g", "y", ["a", "b"])
    finally:
        K.WINNERS_A_COPY = held
    all_pairs = pairs_of(rows)
    assert abs(drawn[0] - len(all_pairs)) < 1e-6 * len(all_pairs) and drawn[1] <= 2 * 32 * len(rows) < len(all_pairs)
    want = fitted(all_pairs)
    assert np.allclose([w["a"], w["b"]], want, rtol=0.15)


def test_no_pairs(spark):
    d = spark.createDataFrame([("g", 1, 1.0)], "g string, y int, a double")
    assert K.fit_logistic_ranker(d, "g", "y", ["a"])[0] == {"a": 0.0}
