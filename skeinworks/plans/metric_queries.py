"""Queries on regression errors, model selection, logs and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv, text as T
from ..operators import logs as L, regression as R, scoring as S
from . import views as V
from .registry import documents, query, table
from .text_queries import sql_words

_REG = """count(*) AS n, avg(abs((t - p) / t)) * 100 AS mape, avg(abs(t - p)) AS mae,
  1 - sum((t - p) * (t - p)) / (var_pop(t) * count(*)) AS r2, sum(abs(t - p)) / sum(abs(t)) * 100 AS wape,
  max(abs(t - p)) AS max_error, avg((t - p) * (t - p)) AS mse, sqrt(avg((t - p) * (t - p))) AS rmse,
  avg(pow(ln(1 + t) - ln(1 + p), 2)) AS msle, sqrt(avg(pow(ln(1 + t) - ln(1 + p), 2))) AS rmsle,
  avg(2 * (ln(p / t) - p / t + 1)) AS gamma_deviance_as_written, avg(2 * (ln(p / t) + t / p - 1)) AS gamma_deviance,
  avg(2 * (p - t * ln(p))) AS poisson_deviance_as_written, avg(2 * (t * ln(t / p) - t + p)) AS poisson_deviance,
  avg(2 * (p * p / t - p + t)) AS tweedie_deviance_as_written, avg((t - p) * (t - p)) AS tweedie_deviance,
  avg(abs(ln(1 + p) - ln(1 + t))) AS d2_absolute_error_as_written,
  1 - var_pop(t - p) / var_pop(t) AS explained_variance"""
_REG_NAMES = (
    "mape mae r2 wape max_error mse rmse msle rmsle gamma_deviance_as_written gamma_deviance "
    "poisson_deviance_as_written poisson_deviance tweedie_deviance_as_written tweedie_deviance "
    "d2_absolute_error_as_written explained_variance"
).split()


def _round_sql(names, n=6):
    return ", ".join(f"round({c}, {n}) AS {c}" for c in names)


def _round(df, names, n=6):
    return df.select(*[F.round(c, n).alias(c) if c in names else c for c in df.columns])


_TP = V.with_views("pred") + ", tp AS (SELECT *, y_true AS t, y_pred AS p FROM pred), "


@query("regression_metrics", _TP + f"m AS (SELECT {_REG} FROM tp) SELECT n, {_round_sql(_REG_NAMES)} FROM m")
def _(spark, sf):
    return _round(R.regression_metrics(V.pred(spark, sf)), _REG_NAMES)


@query(
    "regression_metrics_by_flag",
    _TP + f"m AS (SELECT l_returnflag, {_REG} FROM tp GROUP BY 1) SELECT l_returnflag, n, {_round_sql(_REG_NAMES)} FROM m",
)
def _(spark, sf):
    return _round(R.regression_metrics(V.pred(spark, sf), by=["l_returnflag"]), _REG_NAMES)


@query("regression_percent_error", _TP[:-2] + " SELECT l_orderkey, l_linenumber, round((t - p) / t * 100, 6) AS percent_error FROM tp")
def _(spark, sf):
    d = V.pred(spark, sf)
    e = R.percent_error(F.col("y_true"), F.col("y_pred"))
    return d.select("l_orderkey", "l_linenumber", F.round(e, 6).alias("percent_error"))


@query(
    "regression_d2_median",
    _TP[:-2]
    + """, m AS (SELECT quantile_cont(t, 0.5) AS med FROM tp)
    SELECT round(1 - sum(abs(t - p)) / sum(abs(t - med)), 6) AS d2_absolute_error FROM tp, m""",
)
def _(spark, sf):
    return _round(R.d2_absolute_error(V.pred(spark, sf)), ["d2_absolute_error"])


@query(
    "regression_ks_two_sample",
    _TP
    + """b AS (SELECT t AS v, 1 AS ina, 0 AS inb FROM tp UNION ALL SELECT p, 0, 1 FROM tp),
     c AS (SELECT v, sum(ina) AS ca, sum(inb) AS cb FROM b GROUP BY v),
     d AS (SELECT sum(ca) OVER (ORDER BY v) AS ua, sum(cb) OVER (ORDER BY v) AS ub, sum(ca) OVER () AS na, sum(cb) OVER () AS nb FROM c),
     s AS (SELECT max(abs(ua / na - ub / nb)) AS statistic, max(na) AS n_a, max(nb) AS n_b FROM d),
     l AS (SELECT *, sqrt(n_a::DOUBLE * n_b / (n_a + n_b)) * statistic AS lam FROM s),
     p AS (SELECT *, (SELECT sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * k * k * lam * lam)) FROM range(1, 101) r(k)) AS tail FROM l)
    SELECT round(statistic, 9) AS statistic, n_a::BIGINT AS n_a, n_b::BIGINT AS n_b,
      round(CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * tail)) END, 9) AS p_value,
      CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * tail)) END < 0.05 AS reject FROM p""",
)
def _(spark, sf):
    return _round(R.ks_two_sample(V.pred(spark, sf), "y_true", "y_pred"), ["statistic", "p_value"], 9)


# ---- model selection ------------------------------------------------------------------

_ME = V.with_views("model_eval")


@query(
    "model_benchmark_summary",
    _ME
    + """SELECT model_id, round(avg(latency), 3) AS latency_mean, round(stddev_samp(latency), 3) AS latency_std,
      round(min(latency), 3) AS latency_min, round(max(latency), 3) AS latency_max, round(avg(similarity), 3) AS similarity_mean,
      round(stddev_samp(similarity), 3) AS similarity_std, round(avg(tokens), 3) AS tokens_mean,
      round(sum(cost), 3) AS cost_sum, count(*) FILTER (success) AS successes FROM model_eval GROUP BY 1""",
)
def _(spark, sf):
    return S.benchmark_summary(V.model_eval(spark, sf))


@query("model_success_counts", _ME + "SELECT model_id, success, count(*) AS n FROM model_eval GROUP BY ALL")
def _(spark, sf):
    return S.success_counts(V.model_eval(spark, sf))


def _select_sql(cost: str, w, digits: int) -> str:
    return (
        _ME
        + f""", p AS (SELECT model_id, avg(latency) AS avg_latency, avg(similarity) AS avg_similarity, {cost}(cost) AS model_cost,
          count(*) AS n FROM model_eval WHERE success GROUP BY 1),
        s AS (SELECT *, 1 - avg_latency / max(avg_latency) OVER () AS latency_score,
          CASE WHEN max(model_cost) OVER () = 0 THEN 1.0 ELSE 1 - model_cost / max(model_cost) OVER () END AS cost_score FROM p),
        o AS (SELECT *, {w[0]}::DOUBLE * avg_similarity + {w[1]}::DOUBLE * latency_score + {w[2]}::DOUBLE * cost_score AS overall_score FROM s),
        r AS (SELECT *, row_number() OVER (ORDER BY overall_score DESC, model_id) AS rank FROM o)
        SELECT model_id, round(avg_latency, 6) AS avg_latency, round(avg_similarity, 6) AS avg_similarity,
          round(model_cost, 6) AS model_cost, n, round(latency_score, 6) AS latency_score, round(cost_score, 6) AS cost_score,
          round(overall_score, {digits}) AS overall_score, rank, CASE WHEN rank = 1 THEN 'primary' ELSE 'fallback' END AS role FROM r"""
    )


@query("model_selection", _select_sql("sum", (0.5, 0.3, 0.2), 6))
def _(spark, sf):
    d = S.selection_scores(V.model_eval(spark, sf))
    return _round(d, ["avg_latency", "avg_similarity", "model_cost", "latency_score", "cost_score", "overall_score"])


@query("model_selection_unit_cost", _select_sql("avg", (0.6, 0.25, 0.15), 4))
def _(spark, sf):
    d = S.selection_scores(V.model_eval(spark, sf), total_cost=False, weights=(0.6, 0.25, 0.15))
    d = _round(d, ["avg_latency", "avg_similarity", "model_cost", "latency_score", "cost_score"])
    return _round(d, ["overall_score"], 4)


@query(
    "model_best_per_use_case",
    _ME
    + """, p AS (SELECT use_case, model_id, avg(similarity) AS s FROM model_eval WHERE success GROUP BY ALL)
    SELECT use_case, model_id, round(s, 6) AS mean_similarity FROM p
    QUALIFY row_number() OVER (PARTITION BY use_case ORDER BY s DESC, model_id) = 1""",
)
def _(spark, sf):
    return _round(S.best_per_use_case(V.model_eval(spark, sf)), ["mean_similarity"])


@query(
    "model_speed_up",
    _ME
    + """, m AS (SELECT model_id, avg(latency) AS latency, avg(cost) AS cost FROM model_eval GROUP BY 1),
    u AS (SELECT 'latency' AS time, max(latency) FILTER (model_id = 'model-0') AS s, max(latency) FILTER (model_id = 'model-1') AS f FROM m
      UNION ALL SELECT 'cost', max(cost) FILTER (model_id = 'model-0'), max(cost) FILTER (model_id = 'model-1') FROM m)
    SELECT time, round(s, 6) AS slow_mean, round(f, 6) AS fast_mean, round((s - f) / s * 100, 6) AS saved_percent, round(s / f, 6) AS ratio FROM u""",
)
def _(spark, sf):
    d = S.speed_up(V.model_eval(spark, sf), model="model_id", slow="model-0", fast="model-1", times=["latency", "cost"])
    return _round(d, ["slow_mean", "fast_mean", "saved_percent", "ratio"])


@query(
    "model_token_cost",
    _ME
    + """SELECT model_id, round(sum(tokens / 1000::DOUBLE * CASE WHEN contains(model_id, 'model-1') THEN 0.002::DOUBLE
      ELSE 0.001::DOUBLE END), 6) AS estimated_cost FROM model_eval GROUP BY 1""",
)
def _(spark, sf):
    d = V.model_eval(spark, sf)
    return d.groupBy("model_id").agg(
        F.round(F.sum(S.token_cost("tokens", "model_id", family="model-1")), 6).alias("estimated_cost")
    )


@query("count_values", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    return S.value_counts(table(spark, sf, "events"), "event_type")


@query("count_distinct_values", "SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events")
def _(spark, sf):
    return table(spark, sf, "events").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("types")
    )


# ---- feedback -------------------------------------------------------------------------

_REV = f"""reviews AS (SELECT doc_id, source, text,
    CASE lang WHEN 'en' THEN 'POSITIVE' WHEN 'fr' THEN 'NEGATIVE' WHEN 'de' THEN 'NEUTRAL' ELSE 'OTHER' END AS sentiment,
    CASE WHEN source = 'src0' THEN 'CSV' WHEN source = 'src1' THEN 'test_file' ELSE source END AS src,
    {sql_words("text")} AS ws FROM documents)"""


def reviews(spark, sf):
    d = documents(spark, sf)
    w = T.words("text")
    return d.select(
        "doc_id",
        "text",
        F.when(F.col("lang") == "en", "POSITIVE").when(F.col("lang") == "fr", "NEGATIVE").when(F.col("lang") == "de", "NEUTRAL")
        .otherwise("OTHER").alias("sentiment"),
        F.when(F.col("source") == "src0", "CSV").when(F.col("source") == "src1", "test_file").otherwise(F.col("source")).alias("src"),
        F.transform(w, lambda x: F.struct(x.alias("text"), F.length(x).cast("string").alias("type"))).alias("entities"),
    )


@query(
    "feedback_distribution",
    f"""WITH {_REV}, l(sentiment) AS (VALUES ('POSITIVE'), ('NEGATIVE'), ('NEUTRAL'), ('MIXED')),
    c AS (SELECT l.sentiment, count(r.doc_id) AS n FROM l LEFT JOIN reviews r USING (sentiment) GROUP BY 1)
    SELECT sentiment, n, round(n / sum(n) OVER () * 100, 6) AS percent FROM c""",
)
def _(spark, sf):
    return _round(S.distribution_with_zeros(reviews(spark, sf), "sentiment", fv.SENTIMENTS), ["percent"])


@query(
    "feedback_by_source",
    f"""WITH {_REV} SELECT CASE WHEN src IN ('test_file', 'CSV') THEN src ELSE 'test_file' END AS source,
      count(*) FILTER (sentiment = 'POSITIVE') AS POSITIVE, count(*) FILTER (sentiment = 'NEGATIVE') AS NEGATIVE,
      count(*) FILTER (sentiment = 'NEUTRAL') AS NEUTRAL, count(*) FILTER (sentiment = 'MIXED') AS MIXED FROM reviews GROUP BY 1""",
)
def _(spark, sf):
    return S.label_by_source(
        reviews(spark, sf), "src", "sentiment", known=["test_file", "CSV"], default="test_file", labels=fv.SENTIMENTS
    )


@query(
    "feedback_label_agreement",
    """SELECT count(*) AS n, count(*) FILTER (upper(role) = upper(CASE WHEN turn % 2 = 0 THEN 'User' ELSE 'Assistant' END)) AS agreed,
      round(avg((upper(role) = upper(CASE WHEN turn % 2 = 0 THEN 'User' ELSE 'Assistant' END))::INT), 6) AS rate FROM conversations""",
)
def _(spark, sf):
    c = table(spark, sf, "conversations").withColumn("said", F.when(F.col("turn") % 2 == 0, "User").otherwise("Assistant"))
    return _round(S.agreement(c, "role", "said"), ["rate"])


@query(
    "feedback_top_entity_types",
    f"""WITH {_REV}, e AS (SELECT CAST(length(unnest(ws)) AS VARCHAR) AS type FROM reviews)
    SELECT type, count(*) AS n FROM e GROUP BY 1 ORDER BY n DESC, type LIMIT 10""",
)
def _(spark, sf):
    return S.top_nested(reviews(spark, sf), "entities", "type", top=10)


@query(
    "feedback_top_phrases",
    f"""WITH {_REV}, e AS (SELECT lower(unnest(ws[1:5])) AS text FROM reviews)
    SELECT text, count(*) AS n FROM e GROUP BY 1 ORDER BY n DESC, text LIMIT 15""",
)
def _(spark, sf):
    return S.top_nested(reviews(spark, sf), "entities", "text", top=15, first=5, lower=True)


@query(
    "feedback_quality",
    f"""WITH {_REV} SELECT round(avg(((length(text) >= 10)::INT + regexp_matches(text, '(?i){fv.PRODUCT_PATTERN}')::INT
       + regexp_matches(text, '(?i){fv.OPINION_PATTERN}')::INT + (NOT regexp_matches(text, '(?i){fv.PROFANITY_PATTERN}'))::INT
       + contains(text, '.')::INT) / 5::DOUBLE), 6) AS avg_quality,
      count(*) FILTER (src = 'CSV') AS csv_rows, count(*) FILTER (src = 'test_file') AS test_rows, count(*) AS total FROM reviews""",
)
def _(spark, sf):
    return reviews(spark, sf).agg(
        F.round(F.avg(T.quality_checks("text")["quality_score"]), 6).alias("avg_quality"),
        F.count_if(F.col("src") == "CSV").alias("csv_rows"),
        F.count_if(F.col("src") == "test_file").alias("test_rows"),
        F.count(F.lit(1)).alias("total"),
    )


# ---- logs -----------------------------------------------------------------------------

_SL = V.with_views("search_log")
_STAT = """count(*) AS total, count(*) FILTER (success) AS successful, round(count(*) FILTER (success) / count(*) * 100, 6) AS success_percent,
  round(avg(latency_ms), 6) AS latency_avg, min(latency_ms) AS latency_min, max(latency_ms) AS latency_max,
  round(avg(result_count), 6) AS results_avg, sum(result_count)::BIGINT AS results_total,
  list_sort(list(latency_ms))[count(*) // 2 + 1] AS latency_p50,
  list_sort(list(latency_ms))[CAST(floor(count(*) * 0.95::DOUBLE) AS BIGINT) + 1] AS latency_p95"""


@query("search_statistics", _SL + f"SELECT {_STAT} FROM search_log")
def _(spark, sf):
    return _round(L.search_statistics(V.search_log(spark, sf), by=[]), ["success_percent", "latency_avg", "results_avg"])


@query("search_statistics_by_type", _SL + f"SELECT search_type, {_STAT} FROM search_log GROUP BY 1")
def _(spark, sf):
    d = L.search_statistics(V.search_log(spark, sf), by=["search_type"])
    return _round(d, ["success_percent", "latency_avg", "results_avg"])


@query(
    "answer_log_summary",
    V.with_views("rag_log")
    + """, s AS (SELECT variant, count(*) AS n, list_sort(list(total_time)) AS x, count(*) FILTER (success) AS successful_queries,
       avg(success::INT) * 100 AS success_rate, avg(from_cache::INT) * 100 AS cache_hit_rate, avg(total_time) AS avg_total_time,
       avg(result_count) AS avg_sources FROM rag_log GROUP BY 1),
     j AS (SELECT *, greatest(1, least(n - 1, 19 * (n + 1) // 20)) AS j FROM s)
    SELECT variant, n AS total_queries, successful_queries, round(success_rate, 6) AS success_rate, round(cache_hit_rate, 6) AS cache_hit_rate,
      round(avg_total_time, 6) AS avg_total_time, round(avg_sources, 6) AS avg_sources,
      round((x[j] * (20 - (19 * (n + 1) - 20 * j)) + x[j + 1] * (19 * (n + 1) - 20 * j)) / 20, 6) AS p95_total_time FROM j""",
)
def _(spark, sf):
    d = L.answer_log_summary(V.rag_log(spark, sf), by=["variant"])
    return _round(d, ["success_rate", "cache_hit_rate", "avg_total_time", "avg_sources", "p95_total_time"])


@query(
    "feedback_satisfaction",
    V.with_views("rag_log")
    + """, f AS (SELECT CASE WHEN result_count >= 40 THEN 'good' ELSE 'bad' END AS rating FROM rag_log)
    SELECT count(*) AS total_feedback, count(*) FILTER (rating = 'good') AS good_ratings,
      round(count(*) FILTER (rating = 'good') / count(*) * 100, 6) AS satisfaction_rate FROM f""",
)
def _(spark, sf):
    f = V.rag_log(spark, sf).select(F.when(F.col("result_count") >= 40, "good").otherwise("bad").alias("rating"))
    return _round(L.satisfaction(f, "rating"), ["satisfaction_rate"])


@query(
    "popular_query_terms",
    f"""WITH w AS (SELECT unnest({sql_words("lower(text)")}) AS term FROM benchmark)
    SELECT term, count(*) AS n FROM w WHERE length(term) > 3 GROUP BY 1 ORDER BY n DESC, term LIMIT 10""",
)
def _(spark, sf):
    return S.term_counts_over(table(spark, sf, "benchmark"), "text")


@query(
    "variant_comparison",
    V.with_views("rag_log")
    + """, s AS (SELECT variant, count(*) AS count, avg(total_time) AS a, median(total_time) AS m, coalesce(stddev_samp(total_time), 0) AS s
       FROM rag_log GROUP BY 1)
    SELECT variant, count, round(a, 6) AS avg_metric, round(m, 6) AS median_metric, round(s, 6) AS std_dev,
      row_number() OVER (ORDER BY a, variant) = 1 AS winner FROM s""",
)
def _(spark, sf):
    d = L.compare_variants(V.rag_log(spark, sf), "variant", "total_time")
    return _round(d, ["avg_metric", "median_metric", "std_dev"])


@query(
    "named_metric_summary",
    _SL
    + """SELECT search_type, count(*) AS count, round(avg(latency_ms), 6) AS average, min(latency_ms) AS min, max(latency_ms) AS max
    FROM search_log WHERE search_type IN ('click', 'view', 'never_recorded') GROUP BY 1""",
)
def _(spark, sf):
    d = S.named_metrics(V.search_log(spark, sf), "search_type", "latency_ms", ["click", "view", "never_recorded"])
    return _round(d, ["average"])


_BENCH = _SL + """, q AS (SELECT search_type, user_id, avg(latency_ms) AS m FROM search_log GROUP BY ALL),
    r AS (SELECT search_type, avg(result_count) AS avg_results FROM search_log WHERE result_count > 0 GROUP BY 1),
    s AS (SELECT search_type, avg(m) AS avg_latency, min(m) AS min_latency, max(m) AS max_latency,
       list_sort(list(m))[CAST(floor(count(*) * 0.95::DOUBLE) AS BIGINT) + 1] AS p95_latency FROM q GROUP BY 1)"""


@query(
    "store_benchmark",
    _BENCH
    + """ SELECT search_type, round(avg_latency, 6) AS avg_latency, round(min_latency, 6) AS min_latency,
      round(max_latency, 6) AS max_latency, round(avg_results, 6) AS avg_results, round(p95_latency, 6) AS p95_latency
    FROM s JOIN r USING (search_type)""",
)
def _(spark, sf):
    d = L.store_benchmark(V.search_log(spark, sf), "search_type", "user_id", "latency_ms", "result_count")
    return _round(d, ["avg_latency", "min_latency", "max_latency", "avg_results", "p95_latency"])


@query(
    "store_ranking",
    _BENCH
    + """ SELECT search_type, round(avg_latency, 6) AS avg_latency, rank() OVER (ORDER BY avg_latency) AS rank,
      round((avg_latency - min(avg_latency) OVER ()) / min(avg_latency) OVER () * 100, 6) AS slower_percent FROM s""",
)
def _(spark, sf):
    d = V.search_log(spark, sf).groupBy("search_type", "user_id").agg(F.avg("latency_ms").alias("m"))
    per = d.groupBy("search_type").agg(F.avg("m").alias("avg_latency"))
    return _round(S.slower_than_fastest(per, "search_type", "avg_latency"), ["avg_latency", "slower_percent"])


_PRF = _ME + """, f AS (SELECT use_case, model_id, similarity AS precision, latency / 100 AS recall,
    CASE WHEN similarity + latency / 100 > 0 THEN 2 * similarity * (latency / 100) / (similarity + latency / 100) ELSE 0 END AS f1 FROM model_eval)"""


def _prf(spark, sf):
    p, r = F.col("similarity"), F.col("latency") / 100
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return V.model_eval(spark, sf).select("use_case", "model_id", p.alias("precision"), r.alias("recall"), f1.alias("f1"))


@query(
    "strategy_means",
    _PRF
    + """ SELECT use_case, model_id, count(*) AS n, round(avg(precision), 6) AS mean_precision, round(avg(recall), 6) AS mean_recall,
      round(avg(f1), 6) AS mean_f1 FROM f GROUP BY ALL""",
)
def _(spark, sf):
    d = S.method_means(_prf(spark, sf), ["use_case", "model_id"], ["precision", "recall", "f1"])
    return _round(d, ["mean_precision", "mean_recall", "mean_f1"])


@query(
    "strategy_best_per_category",
    _PRF
    + """, m AS (SELECT use_case, model_id, avg(f1) AS mean FROM f GROUP BY ALL),
    b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY use_case ORDER BY mean DESC, model_id) = 1)
    SELECT use_case, model_id, round(mean, 6) AS mean, count(*) OVER (PARTITION BY model_id) AS wins FROM b""",
)
def _(spark, sf):
    from pyspark.sql import Window

    b = S.best_per_category(_prf(spark, sf), "use_case", "model_id", "f1")
    return _round(b.withColumn("wins", F.count(F.lit(1)).over(Window.partitionBy("model_id"))), ["mean"])


@query(
    "strategy_improvement",
    _PRF
    + """, m AS (SELECT model_id, avg(f1) AS mean FROM f GROUP BY 1)
    SELECT model_id, round(mean, 6) AS mean, round((mean - (SELECT mean FROM m WHERE model_id = 'model-0'))
      / (SELECT mean FROM m WHERE model_id = 'model-0') * 100, 6) AS improvement_percent FROM m""",
)
def _(spark, sf):
    return _round(S.improvement(_prf(spark, sf), "model_id", "f1", base="model-0"), ["mean", "improvement_percent"])


@query(
    "performance_bands",
    _PRF
    + """, m AS (SELECT model_id, use_case, avg(precision) AS p, avg(recall) AS r, avg(f1) AS f FROM f GROUP BY ALL)
    SELECT model_id, use_case, CASE WHEN p >= 0.8 THEN 'Excellent' WHEN p >= 0.6 THEN 'Good' WHEN p >= 0.4 THEN 'Acceptable' ELSE 'Poor' END AS precision_band,
      CASE WHEN r >= 0.7 THEN 'Excellent' WHEN r >= 0.5 THEN 'Good' WHEN r >= 0.3 THEN 'Acceptable' ELSE 'Poor' END AS recall_band,
      CASE WHEN f >= 0.7 THEN 'Excellent' WHEN f >= 0.5 THEN 'Good' WHEN f >= 0.3 THEN 'Acceptable' ELSE 'Poor' END AS f1_band FROM m""",
)
def _(spark, sf):
    m = S.method_means(_prf(spark, sf), ["model_id", "use_case"], ["precision", "recall", "f1"])
    return m.select(
        "model_id",
        "use_case",
        T.performance_band(F.lit("Precision"), "mean_precision").alias("precision_band"),
        T.performance_band(F.lit("Recall"), "mean_recall").alias("recall_band"),
        T.performance_band(F.lit("F1 Score"), "mean_f1").alias("f1_band"),
    )


_PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "table_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        min({c}) AS min, max({c}) AS max FROM lineitem"""
        for c in _PROFILE_COLS
    ),
)
def _(spark, sf):
    return _round(S.profile(table(spark, sf, "lineitem"), _PROFILE_COLS), ["mean", "std"])


@query(
    "score_spread",
    """SELECT p_brand, round(avg(p_retailprice), 6) AS mean, min(p_retailprice) AS min, max(p_retailprice) AS max,
      round(var_pop(p_retailprice), 4) AS variance, var_pop(p_retailprice) < 1e-5 AS flat FROM part GROUP BY 1""",
)
def _(spark, sf):
    d = S.score_spread(table(spark, sf, "part"), ["p_brand"], "p_retailprice")
    return _round(_round(d, ["mean"]), ["variance"], 4)


@query(
    "quality_rules",
    """SELECT 'RowCount > 0' AS rule, count(*) > 0 AS passed FROM lineitem
    UNION ALL SELECT 'Complete l_orderkey', count(*) = count(l_orderkey) FROM lineitem
    UNION ALL SELECT 'l_discount in 0..0.05', min(l_discount) >= 0 AND max(l_discount) <= 0.05 FROM lineitem""",
)
def _(spark, sf):
    rules = {
        "RowCount > 0": F.count(F.lit(1)) > 0,
        "Complete l_orderkey": F.count(F.lit(1)) == F.count("l_orderkey"),
        "l_discount in 0..0.05": (F.min("l_discount") >= 0) & (F.max("l_discount") <= 0.05),
    }
    return S.run_rules(table(spark, sf, "lineitem"), rules)


@query(
    "dedup_by_prefix",
    """WITH r AS (SELECT doc_id, n_chars, md5(text) AS text_md5, row_number() OVER (PARTITION BY substr(text, 1, 100) ORDER BY doc_id) AS r FROM documents)
    SELECT doc_id, n_chars, text_md5 FROM r WHERE r = 1""",
)
def _(spark, sf):
    d = S.first_of_prefix(documents(spark, sf), [], "text", ["doc_id"])
    return d.select("doc_id", "n_chars", F.md5("text").alias("text_md5"))


@query(
    "dedup_for_encoding",
    """SELECT count(*) AS total, count(DISTINCT md5(text)) AS distinct_texts,
      round(1 - count(DISTINCT md5(text)) / count(*), 9) AS saved_share FROM documents""",
)
def _(spark, sf):
    return _round(S.distinct_share(documents(spark, sf), "text"), ["saved_share"], 9)


# ---- window-shaped --------------------------------------------------------------------


@query(
    "circuit_failure_state",
    _SL
    + """, s AS (SELECT *, sum(success::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seg FROM search_log),
    c AS (SELECT *, sum((NOT success)::INT) OVER (PARTITION BY user_id, seg ORDER BY ts, event_id) AS fc FROM s)
    SELECT user_id, event_id, success, fc::BIGINT AS failure_count, fc > 5 AS is_open FROM c""",
)
def _(spark, sf):
    log = V.search_log(spark, sf).select("user_id", "event_id", "ts", "success")
    return L.failure_state(log, "user_id", "ts", "event_id", "success").drop("ts")


_ATT = """att AS (SELECT l_orderkey AS request, l_linenumber AS attempt,
   CASE WHEN l_linenumber <= 2 THEN 'primary' ELSE 'fallback' END AS tier, l_returnflag = 'R' AS ok FROM lineitem)"""


@query(
    "routed_outcome",
    f"""WITH {_ATT}, p AS (SELECT request, min(attempt) FILTER (ok AND tier = 'primary') AS p, min(attempt) FILTER (ok AND tier = 'fallback') AS f
       FROM att WHERE attempt <= 3 GROUP BY 1)
    SELECT request, CASE WHEN p IS NOT NULL THEN 'primary' WHEN f IS NOT NULL THEN 'fallback' ELSE 'degraded' END AS model_used,
      coalesce(p, f) AS attempt FROM p""",
)
def _(spark, sf):
    a = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("request"),
        F.col("l_linenumber").alias("attempt"),
        F.when(F.col("l_linenumber") <= 2, "primary").otherwise("fallback").alias("tier"),
        (F.col("l_returnflag") == "R").alias("ok"),
    )
    return L.routed_outcome(a, "request", "attempt", "tier", "ok")


def _alarm_sql(agg: str, threshold: float, periods: int) -> str:
    return (
        _SL
        + f""", p AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '2000-01-01') AS s, {agg}(latency_ms) AS v FROM search_log GROUP BY 1),
      w AS (SELECT *, lag(v, {periods - 1}) OVER (ORDER BY s) AS pv, lag(s, {periods - 1}) OVER (ORDER BY s) AS ps FROM p)
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS period_start, round(v, 6) AS statistic,
      coalesce(v > {threshold} AND pv > {threshold} AND ps = s - INTERVAL {5 * (periods - 1)} MINUTE, FALSE) AS alarm FROM w"""
    )


def _alarm(spark, sf, statistic, threshold, periods):
    d = L.alarms(V.search_log(spark, sf), "ts", "latency_ms", statistic=statistic, threshold=threshold, periods=periods)
    return d.select(
        F.date_format("period_start", "yyyy-MM-dd HH:mm:ss").alias("period_start"), F.round("statistic", 6).alias("statistic"), "alarm"
    )


@query("alarm_latency_two_periods", _alarm_sql("avg", 40.0, 2))
def _(spark, sf):
    return _alarm(spark, sf, "avg", 40.0, 2)


@query("alarm_error_sum", _alarm_sql("sum", 100.0, 1))
def _(spark, sf):
    return _alarm(spark, sf, "sum", 100.0, 1)


@query(
    "conversation_last_turns",
    """SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 10""",
)
def _(spark, sf):
    return L.last_turns(table(spark, sf, "conversations"), "conv_id", "turn").select("conv_id", "turn", "role")


@query(
    "conversation_context",
    """WITH r AS (SELECT conv_id, turn, 'Q: ' || role || chr(10) || 'A: ' || text || chr(10) || chr(10) AS s FROM conversations
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 3)
    SELECT conv_id, md5(string_agg(s, '' ORDER BY turn)) AS context_md5 FROM r GROUP BY 1""",
)
def _(spark, sf):
    d = L.conversation_context(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")
    return d.select("conv_id", F.md5("context").alias("context_md5"))


@query(
    "context_budget",
    """WITH RECURSIVE o AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
    g(conv_id, i, used, done) AS (
      SELECT DISTINCT conv_id, 0::BIGINT, 0::BIGINT, FALSE FROM o
      UNION ALL SELECT g.conv_id, g.i + 1, used + CASE WHEN used + length(o.text) > 800 THEN 0 ELSE length(o.text) END, used + length(o.text) > 800
      FROM g JOIN o ON o.conv_id = g.conv_id AND o.i = g.i + 1 WHERE NOT g.done)
    SELECT o.conv_id, o.turn, g.done AS truncated, CASE WHEN g.done THEN substr(o.text, 1, 800 - g.used) || '...' ELSE o.text END AS text
    FROM g JOIN o ON o.conv_id = g.conv_id AND o.i = g.i WHERE NOT g.done OR 800 - g.used > 100""",
)
def _(spark, sf):
    d = L.context_budget(table(spark, sf, "conversations"), "conv_id", "turn", "text", max_tokens=200)
    return d.select("conv_id", "turn", "truncated", "text")


@query(
    "traffic_split",
    """SELECT CASE WHEN ('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 10 THEN 'B' ELSE 'A' END AS variant,
      count(*) AS n FROM events GROUP BY 1""",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy(L.traffic_split(F.col("user_id").cast("string"), 0.1).alias("variant")).agg(F.count(F.lit(1)).alias("n"))
