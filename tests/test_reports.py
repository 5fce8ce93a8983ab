import math

from pyspark.sql import functions as F

from skeinworks.operators import classify as C, logs as L, regression as G, scoring as S, series as N


def test_model_selection_golden(spark):
    # two models, seven evaluations each; the expected scores are those on record
    rows = [("titan", 4382.03, 0.3565714285714286, 0.000412 / 7, True)] * 7
    rows += [("sonnet", 8060.945714285714, 0.473, 0.002938 / 7, True)] * 7
    rows += [("sonnet", 1e9, 0.0, 5.0, False)]
    d = spark.createDataFrame(rows, "model_id string, latency double, similarity double, cost double, success boolean")
    got = {r["model_id"]: r for r in S.selection_scores(d).collect()}
    assert abs(got["titan"]["overall_score"] - 0.48715570600494745) < 1e-9 and got["titan"]["role"] == "primary"
    assert abs(got["sonnet"]["overall_score"] - 0.2365) < 1e-9 and got["sonnet"]["role"] == "fallback"


def test_model_selection_unit_cost_golden(spark):
    rows = []
    for m, times, quality, cost in (
        ("v1", (120, 115, 125), (0.85, 0.87, 0.84), 0.0001),
        ("cohere", (150, 145, 155), (0.90, 0.91, 0.89), 0.0002),
        ("v2", (100, 105, 95), (0.88, 0.87, 0.89), 0.00015),
    ):
        rows += [(m, float(t), q, cost) for t, q in zip(times, quality)]
    d = spark.createDataFrame(rows, "model_id string, latency double, similarity double, cost double")
    got = S.selection_scores(d, total_cost=False, weights=(0.6, 0.25, 0.15)).orderBy("rank").collect()
    assert [(r["model_id"], round(r["overall_score"], 4)) for r in got] == [("v2", 0.6488), ("v1", 0.637), ("cohere", 0.54)]


def test_speed_up_golden(spark):
    slow, fast = (11.89, 12.92, 19.83, 14.84, 14.65), (2.75, 2.95, 2.9, 2.65, 2.74)
    rows = [("s", x) for x in slow] + [("f", x) for x in fast] + [("s", None)]
    d = spark.createDataFrame(rows, "model string, total double")
    r = S.speed_up(d, model="model", slow="s", fast="f", times=["total"]).first()
    assert abs(r["slow_mean"] - 14.826) < 1e-9 and abs(r["fast_mean"] - 2.798) < 1e-9
    assert abs(r["ratio"] - 14.826 / 2.798) < 1e-9


def test_percent_error_and_textbook_forms(spark):
    d = spark.createDataFrame([(2.0, 1.0), (4.0, 5.0)], "y_true double, y_pred double")
    assert [r[0] for r in d.select(G.percent_error(F.col("y_true"), F.col("y_pred"))).collect()] == [50.0, -25.0]
    m = G.regression_metrics(d).first()
    assert m["mae"] == 1.0 and m["mape"] == 37.5 and m["max_error"] == 1.0
    assert abs(m["gamma_deviance"] - sum(2 * (math.log(p / t) + t / p - 1) for t, p in ((2, 1), (4, 5))) / 2) < 1e-12
    assert abs(m["r2"] - (1 - 2 / 2)) < 1e-12


def test_ks(spark):
    same = spark.createDataFrame([(float(i), float(i)) for i in range(200)], "a double, b double")
    r = G.ks_two_sample(same, "a", "b").first()
    assert r["statistic"] == 0.0 and r["p_value"] == 1.0 and not r["reject"]
    apart = spark.createDataFrame([(float(i), float(i + 100)) for i in range(200)], "a double, b double")
    r = G.ks_two_sample(apart, "a", "b").first()
    assert r["statistic"] == 0.5 and r["reject"]


def test_context_budget(spark):
    rows = [(1, 1, "a" * 30), (1, 2, "b" * 30), (1, 3, "c" * 5), (2, 1, "d" * 50)]
    d = spark.createDataFrame(rows, "q int, r int, t string")
    out = L.context_budget(d, "q", "r", "t", max_tokens=10, keep_above=5).orderBy("q", "r").collect()
    assert [(r["q"], r["r"], len(r["t"]), r["truncated"]) for r in out] == [(1, 1, 30, False), (1, 2, 13, True), (2, 1, 43, True)]
    strict = L.context_budget(d, "q", "r", "t", max_tokens=10, keep_above=10).orderBy("q", "r").collect()
    assert [(r["q"], r["r"]) for r in strict] == [(1, 1), (2, 1)]


def test_alarms_need_contiguous_periods(spark):
    rows = [("2024-01-01 00:01:00", 9.0), ("2024-01-01 00:06:00", 9.0), ("2024-01-01 00:16:00", 9.0), ("2024-01-01 00:21:00", 1.0)]
    d = spark.createDataFrame(rows, "ts string, v double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = L.alarms(d, "ts", "v", statistic="avg", threshold=5.0, periods=2).orderBy("period_start").collect()
    assert [r["alarm"] for r in got] == [False, True, False, False]


def test_roc_with_ties(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.1), (1, 0.1)]
    d = spark.createDataFrame(rows, "y int, s double")
    pairs = [(a, b) for y, a in rows if y == 1 for z, b in rows if z == 0]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    areas = C.curve_areas(C.roc_points(d, "y", "s"))
    assert abs(areas.first()["auRoc"] - want) < 1e-12
    assert C.deployment_decision(areas, {"auRoc": 0.99, "other": 5}).first()["deploy"] == "false"


def test_split_is_exact_per_label(spark):
    d = spark.range(1000).select("id", F.when(F.col("id") < 700, 0).otherwise(1).alias("y"))
    got = {(r["y"], r["is_test"]): r["count"] for r in C.stratified_split(d, "y", "id").groupBy("y", "is_test").count().collect()}
    assert got == {(0, True): 140, (0, False): 560, (1, True): 60, (1, False): 240}


def test_forecast_recovers_a_known_series(spark):
    rows = [("a", i, 10 + 0.5 * i + [3, -1, 0, 0, -2, 0, 0][i % 7]) for i in range(140) if i != 50]
    rows += [("spike", i, 5.0 + (80.0 if i == 33 else 0.0) + (i % 2) * 0.1) for i in range(100)]
    d = spark.createDataFrame(rows, "item string, i int, v double").select(
        "item", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("day"), "v"
    )
    parts = N.decomposed(N.regular_series(d, "item", "day", "v"), "item")
    assert parts.where("item = 'a'").count() == 140
    found = {(r["item"], r["t"]) for r in N.anomalies(parts, "item", threshold=0.9999).collect()}
    assert ("spike", 33) in found and ("a", 50) in found
    f = N.explained_forecast(N.fitted_models(parts, "item", "day"), "item").where("item = 'a'").orderBy("step_ahead").collect()
    assert len(f) == 30 and str(f[0]["day"]) == "2024-05-20"
    assert abs(f[0]["trend"] - (10 + 0.5 * 140)) < 3 and f[0]["lower_bound"] < f[0]["forecast"] < f[0]["upper_bound"]


def test_weekly_series_keep_every_value(spark):
    rows = [("w", 7 * i, 1.0) for i in range(20)] + [("w", 30, 5.0)]
    d = spark.createDataFrame(rows, "item string, i int, v double").select(
        "item", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("day"), "v"
    )
    s = N.regular_series(d, "item", "day", "v")
    assert s.first()["step"] == 7 and s.count() == 20 and s.agg(F.sum("y")).first()[0] == 25.0
