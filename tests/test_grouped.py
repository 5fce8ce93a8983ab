"""Training sets whose groups lie in one task: same rows, and no step after the sample shuffles it."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from skeinworks.operators import ranking as K, running as RU

ONE_IN = 10


def moved_by_group(df):
    """Shuffles by group that the plan needs, besides those that deal out users and positives."""
    return re.findall(r"hashpartitioning\(query_group_id#[^)]*\), ENSURE_REQUIREMENTS", plan(df))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sides(spark):
    r = random.Random(5)
    users = spark.createDataFrame([(k,) for k in [*range(30), 7, None]], "user_id long")
    prods = spark.createDataFrame([(k, f"c{k % 3}", None if k % 13 == 0 else 1.0 * (k * 37 % 50), 0.5 * k) for k in range(93)], "product_id long, category string, retail_price double, cost double")
    bought = [(str(r.randrange(30)) if r.random() < 0.9 else None, r.randrange(93)) for _ in range(300)]
    pos = spark.createDataFrame(bought, "query_group_id string, product_id long").join(prods, "product_id")
    return users, prods, pos.select("query_group_id", "product_id", "category", "retail_price", "cost", F.lit(1).alias("label"))


def cut(df):
    return re.search(r"hashpartitioning\(query_group_id#\d+, _range#", plan(df))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_parts_give_the_same_sample(sides, monkeypatch):
    users, prods, _ = sides
    parts = K.sample_parts(users, prods, one_in=ONE_IN)
    by_parts = rows(K.negative_samples(users, prods, one_in=ONE_IN, parts=parts))
    assert by_parts == rows(K.negative_samples(users, prods, one_in=ONE_IN, strata_a_block=3, users_a_part=6)) and len(by_parts) > 280
    monkeypatch.setattr(K, "HELD_BYTES", 100)
    assert K.sample_parts(users, prods) is None


def test_parts_follow_the_sample(sides, monkeypatch):
    users, prods, _ = sides
    monkeypatch.setattr(K, "PART_ROWS", 2)
    assert K.sample_parts(users, prods, one_in=ONE_IN) == 32 * 10 // 2


def both(sides, parts, **options):
    users, prods, pos = sides
    return K.training_set(pos, K.negative_samples(users, prods, one_in=ONE_IN, parts=parts), parts=parts, **options)


def test_exclusion_leaves_the_sample_where_it_is(sides):
    users, prods, pos = sides
    bought = {(r.query_group_id, r.product_id) for r in pos.collect() if r.query_group_id is not None}
    d = both(sides, 5, exclude_positives=True)
    want = [r for r in rows(both(sides, 5)) if r[5] == 1 or (r[0], r[1]) not in bought]
    assert rows(d) == want and len(want) < both(sides, 5).count()
    assert not moved_by_group(d)


def judged(d):
    return d.groupBy("query_group_id", "product_id").agg(F.max("label").alias("label"), F.max("retail_price").alias("s"))


def test_judged_rows_are_ranked_without_a_shuffle(sides):
    d = judged(both(sides, 5)).where("s is not null")
    assert not moved_by_group(d) and moved_by_group(judged(both(sides, None)))
    groups = {}
    for r in d.collect():
        groups.setdefault(r.query_group_id, []).append((-r.s, r.product_id, r.label))
    found = K.average_precision(d, "query_group_id", "label", "s", "product_id")
    assert not cut(found) and not moved_by_group(found)
    ndcg = K.ranker_ndcg(d, "query_group_id", "label", "s", "product_id", k=5)
    assert not moved_by_group(ndcg) and ndcg.count() == len([g for g in groups if g is not None])
    for r in found.collect():
        at, hits, each = 0, 0, []
        for _, _, label in sorted(groups[r.query_group_id]):
            at += 1
            hits += label
            each += [hits / at] if label else []
        assert math.isclose(r.average_precision, sum(each) / len(each) if each else 0.0)


def test_few_rows_a_key_are_not_cut_into_ranges(sides, monkeypatch):
    d = judged(both(sides, 5)).where("s is not null").withColumn("s", F.col("s") * 1.0)
    whole = K.ranked_candidates(d, {"s": 1.0}, "query_group_id", "product_id")
    assert not cut(whole)
    monkeypatch.setattr(RU, "WHOLE_ROWS", 5)
    parted = K.ranked_candidates(d, {"s": 1.0}, "query_group_id", "product_id")
    assert cut(parted) and rows(parted) == rows(whole)


def test_preference_sums_read_their_rows_once(sides):
    d = both(sides, 5)
    p = plan(K.preference_sums(d, "query_group_id", "label", ["retail_price", "cost"]))
    assert "explode" not in p  # what is left starts from the sums of each group and label
    got = {r.query_group_id: r for r in K.preference_sums(d, "query_group_id", "label", ["retail_price", "cost"]).collect()}
    held = [r for r in d.collect() if r.query_group_id is not None]
    known = [r.retail_price for r in d.collect() if r.retail_price is not None]
    mean = sum(known) / len(known)
    for g in {r.query_group_id for r in held}:
        mine = [(r.label, mean if r.retail_price is None else r.retail_price, r.cost) for r in held if r.query_group_id == g]
        pairs = [(a[1] - b[1], a[2] - b[2]) for a in mine for b in mine if a[0] > b[0]]
        if not pairs:
            assert g not in got
            continue
        want = (len(pairs), sum(x for x, _ in pairs), sum(y for _, y in pairs), sum(x * x for x, _ in pairs), sum(y * y for _, y in pairs))
        r = got[g]
        for x, y in zip((r.pairs, r.d0, r.d1, r.m0_0, r.m1_1), want):
            assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6)


def test_null_scores_have_the_place_that_ranges_give_them(spark, monkeypatch):
    d = spark.createDataFrame([(f"g{k % 3}", k, None if k % 10 == 0 else float("nan") if k % 17 == 0 else k * 7 % 40 / 2) for k in range(200)], "g string, p long, s double")
    whole = str(rows(K.ranked_candidates(d, {"s": 1.0}, "g", "p")))
    monkeypatch.setattr(RU, "WHOLE_ROWS", 5)
    assert whole == str(rows(K.ranked_candidates(d, {"s": 1.0}, "g", "p")))
