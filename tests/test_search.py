import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skeinworks.operators import evaluate as M, lexical as X, ranking as K, retrieval as R, vector as V


@pytest.fixture(scope="module")
def world(spark):
    g = np.random.default_rng(1)
    centres = g.normal(size=(6, 8))
    vecs = [(centres[i % 6] + 0.25 * g.normal(size=8)) for i in range(240)]
    vecs[7] = vecs[1].copy()  # an exact tie
    r = random.Random(1)
    words = ["red", "blue", "green", "cat", "dog", "the", "a"]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 30))), [float(x) for x in v], i % 4) for i, v in enumerate(vecs)]
    queries = [(i, " ".join(r.sample(words, 3)), [float(x) for x in g.normal(size=8)]) for i in range(9)]
    d = spark.createDataFrame(docs, "doc_id long, text string, d_vec array<float>, grp int").repartition(5)
    q = spark.createDataFrame(queries, "query_id long, query string, q_vec array<float>")
    return docs, queries, d, q


def cos(a, b):
    a, b = np.array(a, dtype=np.float32).astype(float), np.array(b, dtype=np.float32).astype(float)
    return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))


def bm25(query, text):
    terms, doc = set(query.lower().split()), text.lower().split()
    return sum(2.5 * doc.count(t) / (doc.count(t) + 1.5 * (0.25 + 0.75 * len(doc) / 100)) for t in terms if t in doc)


def best(scores, k):
    return [i for i, _ in sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]]


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["doc_id"])
    return out


def test_nearest_both_ways(world):
    docs, queries, d, q = world
    small = by_query(V.nearest(q, d, 5))
    grid = by_query(V.nearest(q, d, 5, small_side_bytes=0, block_rows=50, query_block_rows=4))
    for i, _, v in queries:
        want = best({j: cos(v, w) for j, _, w, _ in docs}, 5)
        assert small[i] == want and grid[i] == want


def test_filters_and_threshold(world):
    docs, queries, d, q = world
    got = by_query(V.nearest(q, d, 4, filters={"grp": [1, 2]}, min_score=0.2))
    for i, _, v in queries:
        scores = {j: cos(v, w) for j, _, w, g in docs if g in (1, 2)}
        assert got.get(i, []) == best({j: s for j, s in scores.items() if s >= 0.2}, 4)


def test_cells_find_most_neighbours(world):
    *_, d, q = world
    exact, near = V.nearest(q, d, 10), V.nearest_by_cells(q, d, 10, cells=6, probes=3, piece_rows=10)
    assert V.recall_against(near, exact).first()["recall"] >= 0.7
    everything = V.nearest_by_cells(q, d, 10, cells=6, probes=6, piece_rows=10)
    assert by_query(everything) == by_query(exact)


def test_similar_pairs_are_complete(world):
    docs, _, d, _ = world
    width = len(docs[0][2])
    want = {(a[0], b[0]) for a in docs for b in docs if a[0] <= b[0] and round(cos(a[2], b[2]), 10) >= 0.9}
    for rows in (9, 10_000):
        got = [(r["i"], r["j"]) for r in V.similar_pairs(d, min_similarity=0.9, piece_bytes=8 * width * rows).collect()]
        assert len(got) == len(want) and set(got) == want


def test_rows_are_copied_once_per_piece(world):
    *_, d, _ = world
    left, right = V.grid(d.select("doc_id", "d_vec"), F.lit(7))
    n = d.count()
    assert left.count() + right.count() == n * 8
    met = left.select("pa", "pb").distinct().union(right.select("pa", "pb").distinct()).distinct()
    assert met.count() == 7 * 8 // 2 and met.where("pa > pb").count() == 0


def test_banded_pairs(spark):
    """Recall as stated, for pairs of just the limit; no wrong pair, none twice, hot buckets whole."""
    r = np.random.default_rng(4)
    rows = []
    for k in range(600):
        v = r.standard_normal(24)
        v /= np.linalg.norm(v)
        w = r.standard_normal(24)
        w -= (w @ v) * v
        w /= np.linalg.norm(w)
        rows += [(2 * k, v.tolist()), (2 * k + 1, (0.9005 * v + np.sqrt(1 - 0.9005**2) * w).tolist())]
    rows += [(10_000 + k, rows[0][1]) for k in range(60)] + [(20_000, [0.0] * 24), (20_001, None)]
    d = spark.createDataFrame(rows, "doc_id long, d_vec array<double>")
    got = [(x["i"], x["j"]) for x in V.similar_pairs_banded(d, min_similarity=0.9, recall=0.97, piece_bytes=8 * 24 * 25).collect()]
    want = {(x["i"], x["j"]) for x in V.similar_pairs(d, min_similarity=0.9).collect()}
    assert len(got) == len(set(got)) and set(got) <= want
    planted = [(2 * k, 2 * k + 1) for k in range(600)]
    assert len(set(planted) & set(got)) >= 0.95 * 600
    same = [0, *range(10_000, 10_060)]
    assert {(a, b) for a in same for b in same if a <= b} <= set(got)
    assert V.bands_for(0.9, 0.97)[0] <= 64 and V.bands_for(0.99, 0.97)[1] > V.bands_for(0.8, 0.97)[1]


def test_pair_moments(world):
    docs, _, d, _ = world
    sims = [cos(a[2], b[2]) for a in docs for b in docs if a[0] < b[0]]
    r = V.pair_moments(d).first()
    assert r["pairs"] == len(sims)
    assert abs(r["mean_similarity"] - np.mean(sims)) < 1e-9 and abs(r["std_similarity"] - np.std(sims)) < 1e-9


def test_keyword_ways_agree(world):
    docs, queries, d, q = world
    joined = by_query(X.bm25_search(q, d, 6))
    blocks = by_query(R.hybrid_search(q, d, 6, alpha=0.0, keyword_cap=1e9))
    for i, text, _ in queries:
        want = best({j: bm25(text, t) for j, t, _, _ in docs}, 6)
        assert joined[i] == want
        assert len(blocks[i]) == 6


def test_keyword_search_fills_up_with_unmatched(spark):
    d = spark.createDataFrame([(i, "zeta" if i == 5 else "other") for i in range(8)], "doc_id long, text string")
    q = spark.createDataFrame([(1, "zeta zeta"), (2, "nothing")], "query_id long, query string")
    got = by_query(X.keyword_search(q, d, 3))
    assert got == {1: [5, 0, 1], 2: [0, 1, 2]}


def test_hybrid(world):
    docs, queries, d, q = world
    got = by_query(R.hybrid_search(q, d, 5, alpha=0.6))
    for i, text, v in queries:
        want = best({j: 0.6 * cos(v, w) + 0.4 * min(1, bm25(text, t) / 10) for j, t, w, _ in docs}, 5)
        assert got[i] == want


def test_alpha_sweep_equals_single_runs(world):
    *_, d, q = world
    swept = R.alpha_sweep(q, d, [0.2, 1.0], 4)
    for a in (0.2, 1.0):
        assert by_query(swept.where(F.col("alpha") == a)) == by_query(R.hybrid_search(q, d, 4, alpha=a))


def test_alphas_of_a_query_are_scored_once(world):
    *_, q = world
    import pyarrow as pa

    asked = R._bm25_queries(q.withColumn("same", F.monotonically_increasing_id()).withColumn("alpha", F.explode(F.array(F.lit(0.2), F.lit(0.9)))), "alpha")
    side = V._Queries(asked.toArrow(), ["terms"], [1.0])
    assert (side.n, side.asked, side.vec.shape[0], side.weights.shape[1]) == (18, 9, 9, 9)
    d = pa.table({"doc_id": [1, 2, 3], "d_vec": [[1.0] * 8, None, [0.5] + [0.0] * 7], "terms": [["red", "cat", "red"], None, []]})
    one = V._Queries(asked.drop("same").toArrow(), ["terms"], [1.0])
    assert side.top(d, 2, 10.0).to_pylist() == one.top(d, 2, 10.0).to_pylist()


def test_tokens_weigh_as_the_weights_made_before(spark, world):
    docs, queries, d, q = world
    weighed = X.bm25_weights(d.select("doc_id", "text", "d_vec"), "text")
    old = V.scored_top_k(R._bm25_queries(q, 0.3), weighed, 5, fields={"terms": 1.0})
    plain = lambda df: sorted(tuple(round(x, 10) if isinstance(x, float) else x for x in r) for r in df.collect())
    for options in ({}, {"small_side_bytes": 0, "block_rows": 50, "query_block_rows": 4}):
        assert plain(R.hybrid_search(q, d, 5, alpha=0.3, **options)) == plain(old)


def test_hits_are_searched_once(world, monkeypatch):
    """What reads the hits twice reads them from where they were written, not from the documents."""
    *_, d, q = world
    plans = []
    real = R.cut_lineage
    monkeypatch.setattr(R, "cut_lineage", lambda df: (plans.append(df), real(df))[1])
    for out in (R.grounded_retrieval(q, d, min_score=0.1), R.full_search(q, d, 3)):
        assert "mapInArrow" not in out._jdf.queryExecution().optimizedPlan().toString() and out.count()
    assert len(plans) == 2


def slow_diversity(cands, k):
    chosen, rest = [cands[0]], list(cands[1:])
    while rest and len(chosen) < k:
        top, far = None, -1
        for c in rest:
            near = min(1 - len(c[1] & s[1]) / max(len(c[1] | s[1]), 1) for s in chosen)
            if near > far:
                top, far = c, near
        chosen.append(top)
        rest.remove(top)
    return [c[0] for c in chosen]


def test_diversity_matches_the_loop(world):
    docs, _, d, q = world
    hits = R.hybrid_search(q, d, 10).join(d.select("doc_id", "text"), "doc_id")
    text = {j: set(t.lower().split()) for j, t, *_ in docs}
    got, order = by_query(R.rerank_by_diversity(hits)), by_query(hits)
    for i, cands in order.items():
        assert got[i] == slow_diversity([(c, text[c]) for c in cands], 5)


def test_listing(spark, world):
    *_, d, q = world
    hits = R.hybrid_search(q, d, 6)
    listing = q.select("query_id", F.lit("3, 1, x2 9").alias("ranking"))
    got, order = by_query(R.rerank_by_listing(hits, listing, 4)), by_query(hits)
    for i, o in order.items():
        assert got[i] == [o[2], o[0], o[1], o[3]]


def test_dependent_step_sees_the_step_before(spark, world):
    *_, d, q = world
    steps = F.array(
        F.struct(F.col("query"), F.lit(False).alias("dependent")),
        F.struct(F.lit("those").alias("query"), F.lit(True).alias("dependent")),
    )
    out = R.multi_step_search(q.withColumn("steps", steps), d)
    assert {r["step"] for r in out.collect()} == {0, 1}
    assert out.groupBy("query_id").count().agg(F.max("count")).first()[0] <= 10


def test_every_dependent_step_is_searched(spark, world):
    *_, d, q = world
    steps = F.array(*[F.struct(F.lit(f"those {k}").alias("query"), F.lit(k > 0).alias("dependent")) for k in range(7)])
    one = q.orderBy("query_id").limit(1).withColumn("steps", steps)
    far = R.multi_step_search(one, d.withColumn("text", F.concat(F.col("doc_id").cast("string"), F.lit(" "), F.col("text"))), best=1000)
    assert len({r["step"] for r in far.collect()}) >= 1
    flat = []
    real = R.full_search
    try:
        R.full_search = lambda queries, *a, **k: (flat.extend(r.step for r in queries.collect() if "step" in queries.columns), real(queries, *a, **k))[1]
        R.multi_step_search(one, d)
    finally:
        R.full_search = real
    assert set(flat) == set(range(7))


def test_documents_without_a_vector_match_by_words(spark):
    docs = spark.createDataFrame([(1, "zebra zebra", None), (2, "other", [1.0, 0.0])], "doc_id long, text string, d_vec array<double>")
    q = spark.createDataFrame([(9, "zebra", [1.0, 0.0])], "query_id long, query string, q_vec array<double>")
    for alpha in (0.1, 0.0):
        best = R.hybrid_search(q, docs, 1, alpha=alpha).first()
        assert (best["doc_id"], best["semantic_score"]) == (1, 0.0)
    nothing = q.withColumn("q_vec", F.lit(None).cast("array<double>"))
    assert R.hybrid_search(nothing, docs, 1, alpha=0.0).first()["doc_id"] == 1
    assert V.nearest(q, docs, 5).count() == 1


def test_ranking_metrics(spark):
    hits = spark.createDataFrame([(1, 1, 0), (1, 2, 3), (1, 3, 1), (2, 1, 0)], "query_id int, rank int, rel int")
    q = spark.createDataFrame([(1, 4), (2, 1), (3, 2)], "query_id int, n_relevant int")
    r = {x["query_id"]: x for x in M.ranking_metrics(hits, q, 2).collect()}
    assert (r[1]["precision"], r[1]["recall"], r[1]["reciprocal_rank"]) == (0.5, 0.25, 0.5)
    dcg, ideal = 3 / math.log2(3), 3 + 1 / math.log2(3)
    assert abs(r[1]["dcg"] - dcg) < 1e-12 and abs(r[1]["ndcg"] - dcg / ideal) < 1e-12
    assert r[2]["ndcg"] == 0.0 and r[3]["reciprocal_rank"] == 0.0


def test_topics(spark):
    docs = spark.createDataFrame([(1, "Red cats"), (2, "a dog"), (3, "redder dogs")], "doc_id long, text string")
    topics = spark.createDataFrame([(9, ["red", "cat"]), (8, ["bird"])], "query_id long, topics array<string>")
    for kind in ("long", "int", "string"):
        asked = topics.withColumn("query_id", F.col("query_id").cast(kind))
        for block in (64 << 20, 1):
            got = {(r["doc_id"], int(r["query_id"])) for r in M.topic_matches(docs, asked, block_bytes=block).collect()}
            assert got == {(1, 9), (3, 9)}


def test_topics_of_all_lengths_against_contains(spark):
    r = random.Random(8)
    texts = [None, "", "x", *("".join(r.choice("abÄ 😀c") for _ in range(r.randint(1, 30))) for _ in range(80))]
    topics = [[None, "A"], ["aB", "zzzz"], [], ["bÄc", "abcab"], ["😀 ä"], ["c😀"], ["b" * 6, "ab a", "cabb"], ["a"]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for extra in ([], [[""]]):
        asked = list(enumerate([*topics, *extra]))
        want = {(d, q) for d, t in enumerate(texts) for q, ts in asked for x in ts if t is not None and x is not None and x.lower() in t.lower()}
        for block in (64 << 20, 300):
            got = M.topic_matches(docs, spark.createDataFrame(asked, "query_id int, topics array<string>"), block_bytes=block).collect()
            assert len(got) == len(want) and {tuple(x) for x in got} == want
    none = spark.createDataFrame([], "query_id int, topics array<string>")
    assert M.topic_matches(docs, none).count() == 0


def test_gate(spark):
    m = spark.createDataFrame([("faithfulness", 0.9), ("context_recall", 0.5), ("x", 0.0)], "metric string, score double")
    t = spark.createDataFrame([("faithfulness", 0.8), ("context_recall", 0.65), ("gone", 1.0)], "metric string, threshold double")
    assert tuple(M.gate_result(M.gate(m, t)).first()) == (False, "context_recall")


def test_pairwise_ranker_equals_all_pairs(spark):
    r = random.Random(4)
    rows = [("hot" if i % 3 else f"g{i % 7}", r.randint(0, 2), r.uniform(0, 5), r.uniform(-1, 1)) for i in range(150)]
    d = spark.createDataFrame(rows, "g string, y int, a double, b double")
    diffs = [(x[2] - z[2], x[3] - z[3]) for x in rows for z in rows if x[0] == z[0] and x[1] > z[1]]
    m = np.array(diffs)
    want = np.linalg.solve(m.T @ m + np.eye(2), m.sum(axis=0))
    got = K.fit_pairwise_ranker(d, "g", "y", ["a", "b"])
    assert np.allclose([got["a"], got["b"]], want)
    assert K.preference_sums(d, "g", "y", ["a", "b"]).agg(F.sum("pairs")).first()[0] == len(diffs)
    with pytest.raises(ValueError, match="missing.*zz"):
        K.scored_candidates(d, {"zz": 1.0})


def test_negative_sample_size(spark):
    users = spark.range(50).withColumnRenamed("id", "user_id")
    prods = spark.range(0, 9000, 3).select(
        F.col("id").alias("product_id"), F.lit("c").alias("category"), F.lit(1.0).alias("retail_price"), F.lit(0.5).alias("cost")
    )
    n = K.negative_samples(users, prods, one_in=100)
    assert n.count() == 50 * 30 and n.distinct().count() == 50 * 30


def test_negative_samples_of_many_blocks_are_the_named_products(spark):
    from hashlib import md5

    users = spark.createDataFrame([(k,) for k in [*range(40), 7, 7, None]], "user_id long")
    ids = [5 * k + 1 for k in range(93)]
    prods = spark.createDataFrame([(i, f"c{i}", None if i % 4 else 1.0 * i, 0.5) for i in ids], "product_id long, category string, retail_price double, cost double")
    n = K.negative_samples(users, prods, one_in=10, strata_a_block=3, users_a_part=6)
    want = []
    for u in [*range(40), 7, 7, None]:
        for s in range(10):
            name = f"{s}" if u is None else f"{u}-{s}"
            at = s * 10 + int(md5(name.encode()).hexdigest()[:8], 16) % 10
            if at < len(ids):
                want.append((None if u is None else str(u), ids[at], f"c{ids[at]}", None if ids[at] % 4 else 1.0 * ids[at]))
    got = [(r.query_group_id, r.product_id, r.category, r.retail_price) for r in n.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_negative_samples_are_never_broadcast(spark):
    users = spark.range(50).withColumnRenamed("id", "user_id")
    prods = spark.range(3000).select(
        F.col("id").alias("product_id"), F.lit("c").alias("category"), F.lit(1.0).alias("retail_price"), F.lit(0.5).alias("cost")
    )
    lines = K.negative_samples(users, prods, one_in=100)._jdf.queryExecution().executedPlan().toString().split("\n")
    held = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    for at, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = [x for x, depth in zip(lines[at + 1 :], held[at + 1 :]) if depth > held[at]]
            assert not any("explode(sequence" in x for x in below)


def test_scoring_tasks_follow_the_texts(spark, monkeypatch):
    from skeinworks.operators import lexical as X

    d = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    before = by_query(X.bm25_search(d.limit(3).select(F.col("doc_id").alias("query_id"), F.col("text").alias("query")), d, 4))
    monkeypatch.setattr(X, "TASK_BYTES", 40)
    n = X._placed(d, "text").rdd.getNumPartitions()
    assert n >= 400 * 6 // 40 and X._placed(d, "text", d.limit(1)).rdd.getNumPartitions() < n
    assert by_query(X.bm25_search(d.limit(3).select(F.col("doc_id").alias("query_id"), F.col("text").alias("query")), d, 4)) == before


def test_pairs_come_out_in_bounded_batches(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.array(F.lit(1.0), (F.col("id") % 2).cast("double")).alias("d_vec"))
    pairs = V.similar_pairs(d, min_similarity=0.9, piece_bytes=1 << 14)
    assert pairs.count() == 2 * (1500 * 1501 // 2)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" not in plan and "FlatMapGroupsInArrow" in plan


def test_a_block_of_documents_leaves_k_rows_a_query():
    import pyarrow as pa

    g = np.random.default_rng(3)
    x, y = g.normal(size=(9000, 4)), g.normal(size=(1100, 4))
    x[5000] = x[8999] = x[70]  # ties across slices
    y[0] = x[70]
    d = pa.table({"doc_id": np.arange(9000), "d_vec": pa.array(list(x))})
    q = pa.table({"query_id": np.arange(1100), "alpha": np.ones(1100), "min_score": np.full(1100, -2.0), "q_vec": pa.array(list(y))})
    got = V._meet(q, d, 2, [], [], 1.0)
    assert got.num_rows == 2200
    assert [i for k, i in zip(got["query_id"].to_pylist(), got["doc_id"].to_pylist()) if k == 0] == [70, 5000]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    best = {k: (unit @ v).argmax() for k, v in enumerate(y) if k}
    first = dict(reversed(list(zip(got["query_id"].to_pylist(), got["doc_id"].to_pylist()))))
    assert all(first[k] == i for k, i in best.items())
