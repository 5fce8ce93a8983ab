import random
import statistics

import pytest
from pyspark.sql import functions as F

from skeinworks.operators import logs as L, running as R


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    # one key holds most of the rows, values repeat, one key has a single row
    keys = ["hot"] * 400 + ["b"] * 60 + ["c"] * 7 + ["one"]
    return [(i, k, float(r.choice([r.randint(0, 30), r.randint(0, 3)]))) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, k string, v double")


def groups(rows):
    out = {}
    for _, k, v in rows:
        out.setdefault(k, []).append(v)
    return {k: sorted(v) for k, v in out.items()}


def test_running_sum_and_max(frame, rows):
    d = R.running(
        frame, ["k"], [F.col("id")], {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "lo": ("min", F.col("v"))},
        range_on=F.col("id"), ranges=16, totals={"all": "s"},
    )
    got = {r["id"]: (r["s"], r["m"], r["lo"], r["all"]) for r in d.collect()}
    total = {k: sum(v) for k, v in groups(rows).items()}
    seen = {}
    for i, k, v in rows:
        s, m, lo = seen.get(k, (0.0, v, v))
        seen[k] = (s + v, max(m, v), min(lo, v))
        assert got[i] == (*seen[k], total[k])


def test_global_rank_is_dense(frame, rows):
    got = sorted((r["id"], r["rank0"]) for r in R.global_rank(frame.where("id % 3 = 0"), "id").collect())
    assert [x[1] for x in got] == list(range(len(got)))


def test_order_statistics(frame, rows):
    want = groups(rows)
    picks = {"p50": lambda n: F.floor(n / 2), "p95": lambda n: F.least(n - 1, F.floor(n * 0.95))}
    for r in R.values_at(frame, ["k"], "v", picks).collect():
        x = want[r["k"]]
        assert (r["n"], r["p50"], r["p95"]) == (len(x), x[len(x) // 2], x[min(len(x) - 1, int(len(x) * 0.95))])
    for r in R.median_of(frame, ["k"], "v").collect():
        assert r["median"] == statistics.median(want[r["k"]])
    for r in R.exclusive_quantile_of(frame, ["k"], "v").collect():
        x = want[r["k"]]
        if len(x) < 2:
            assert r["quantile"] is None
        else:
            assert abs(r["quantile"] - statistics.quantiles(x, n=20)[18]) < 1e-9


@pytest.mark.parametrize("fine", [R.FINE, 8])
def test_order_statistics_of_any_values(spark, monkeypatch, fine):
    monkeypatch.setattr(R, "FINE", fine)
    # signs, zeros, powers of two, huge and tiny numbers, whole numbers beyond 2**53, nulls, one value in all rows
    r = random.Random(1)
    odd = [0.0, 1.0, 2.0, 4.0, 0.5, 1 - 2**-53, 2 - 2**-52, 1e-300, 5e-324, 1e300, float("inf")]
    many = [x * s for x in odd for s in (1, -1)] + [r.gauss(0, 1) * 10 ** r.randint(-9, 9) for _ in range(300)]
    cases = {"many": many, "one": [7.25] * 500, "near": [1 + k * 2**-52 for k in range(200)], "none": []}
    data = [(k, x) for k, xs in cases.items() for x in xs] + [("many", None), ("none", None), (None, 3.0)]
    d = spark.createDataFrame(data, "k string, v double").repartition(7)
    picks = {f"p{a}": (lambda n, a=a: F.floor((n - 1) * F.lit(a) / 10).cast("long")) for a in range(11)}
    for keys in (["k"], []):
        for row in R.values_at(d, keys, "v", picks).collect():
            x = sorted(v for k, v in data if v is not None and (not keys or k == row["k"]))
            assert row["n"] == len(x)
            assert [row[f"p{a}"] for a in range(11)] == ([x[(len(x) - 1) * a // 10] for a in range(11)] if x else [None] * 11)
    whole = spark.range(300).select((F.lit(2**60) + F.col("id") * 3).alias("v"))
    got = R.values_at(whole, [], "v", {"at": lambda n: F.lit(200), "no": lambda n: F.lit(-1), "far": lambda n: n}).first()
    assert tuple(got) == (300, 2**60 + 600, None, None)
    assert R.values_at(whole.where("v is null"), [], "v", {"at": lambda n: F.floor(n / 2)}).first()["at"] is None


@pytest.mark.parametrize(("fine", "scans"), [(R.FINE, 2), (16, 3)])
def test_search_statistics_reads_its_input_three_times_at_most(spark, tmp_path, monkeypatch, fine, scans):
    monkeypatch.setattr(R, "FINE", fine)
    path = str(tmp_path / "log")
    spark.range(2000).selectExpr("cast(id % 97 as double) latency_ms", "id % 5 = 0 success", "id % 11 result_count").write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def counted(it):
        for b in it:
            reads.add(b.num_rows)
            yield b

    log = spark.read.parquet(path).mapInArrow(counted, "latency_ms double, success boolean, result_count long")
    d = L.search_statistics(log, by=[])
    got = d.first()
    assert (got["total"], got["successful"], got["results_total"]) == (2000, 400, sum(k % 11 for k in range(2000)))
    x = sorted(k % 97 for k in range(2000))
    assert (got["latency_p50"], got["latency_p95"]) == (x[1000], x[1900])
    assert reads.value == scans * 2000
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_no_keys(frame, rows):
    x = sorted(v for *_, v in rows)
    assert R.median_of(frame, [], "v").first()["median"] == statistics.median(x)


def test_failure_state_of_a_busy_circuit(spark):
    r = random.Random(2)
    log, t = [], 0
    for i in range(500):
        t += r.randint(0, 2)  # equal times occur: the id settles the order
        log.append((i, "hot" if r.random() < 0.8 else f"k{i % 5}", t, r.random() < 0.15))
    d = spark.createDataFrame(log, "id long, k string, t long, ok boolean").withColumn("ts", F.timestamp_seconds("t"))
    got = {x["id"]: (x["failure_count"], x["is_open"]) for x in L.failure_state(d, "k", "ts", "id", "ok").collect()}
    state = {}
    for i, k, _, ok in log:
        state[k] = 0 if ok else state.get(k, 0) + 1
        assert got[i] == (state[k], state[k] > 5)
    start = spark.createDataFrame([("hot", 10)], "k string, failures long")
    later = {x["id"]: x["failure_count"] for x in L.failure_state(d, "k", "ts", "id", "ok", carried=start).collect()}
    state = {"hot": 10}
    for i, k, _, ok in log:
        state[k] = 0 if ok else state.get(k, 0) + 1
        assert later[i] == state[k]


def test_many_ranges_and_their_bounds(spark):
    d = spark.range(5000).select("id", (F.col("id") * 7 % 5000).alias("v"))
    got = R.running(d, [], [F.col("v")], {"s": ("sum", F.lit(1))}, range_on=F.col("v"), ranges=2000)
    assert got.where("s != v + 1").count() == 0
    ranged = R.with_range(d, F.col("v"), ranges=2000)
    assert ranged.select("_range").distinct().count() > 1500
    bounds = [float(x) for x in range(0, 3000, 30)]
    for n in (0, 1, 2, 99, 100):
        cut = F.array(*[F.lit(b) for b in bounds[:n]]).cast("array<double>")
        wrong = d.where(R.bounds_below(cut, n, F.col("v").cast("double")) != F.size(F.filter(cut, lambda b: b < F.col("v"))))
        assert wrong.count() == 0
