"""Forecasts, anomalies and explanations for many series in one table.

The model is a line, a mean per phase of the period and a first-order autoregression of what
is left. All series are fitted in the same jobs. Values are summed per series and day first, so
a window sees at most one row per day of the calendar, however many rows a series has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.fixed_values import Z95


def _daily(df: DataFrame, item: str, day: str, value: str) -> DataFrame:
    """Day totals with the series' first day and its step: the most frequent gap in days, the
    shorter one on ties."""
    daily = df.groupBy(item, day).agg(F.sum(value).alias("y"))
    whole = Window.partitionBy(item)
    d = daily.withColumn("_gap", F.datediff(F.col(day), F.lag(day).over(whole.orderBy(day))))
    often = F.count(F.lit(1)).over(Window.partitionBy(item, "_gap"))
    d = d.withColumn("_best", F.when(F.col("_gap").isNotNull(), F.struct(often.alias("c"), (-F.col("_gap")).alias("g"))))
    return d.select(
        item,
        day,
        "y",
        F.min(day).over(whole).alias("first_day"),
        F.coalesce(-F.max("_best").over(whole)["g"], F.lit(1)).alias("step"),
    )


def series_step(df: DataFrame, item: str, day: str) -> DataFrame:
    """The most frequent gap in days between a series' dates, the shorter one on ties."""
    return _daily(df.withColumn("_one", F.lit(1)), item, day, "_one").groupBy(item).agg(F.first("step").alias("step"))


def regular_series(df: DataFrame, item: str, day: str, value: str, *, fill: float = 0.0) -> DataFrame:
    """One row per step from a series' first to its last date: item, day, t (from 0), step and y.

    Dates between two steps count for the earlier one; steps without data get `fill`.
    """
    d = _daily(df, item, day, value)
    t = F.floor(F.datediff(F.col(day), F.col("first_day")) / F.col("step")).cast("int")
    steps = d.groupBy(item, t.alias("t"), "first_day", "step").agg(F.sum("y").alias("y"))
    following = F.lead("t").over(Window.partitionBy(item).orderBy("t"))
    spread = steps.withColumn("_to", F.coalesce(following - 1, F.col("t"))).select(
        item, "first_day", "step", "y", F.col("t").alias("_from"), F.explode(F.sequence("t", "_to")).alias("t")
    )
    return spread.select(
        item,
        F.date_add("first_day", F.col("t") * F.col("step")).alias(day),
        "t",
        "step",
        F.when(F.col("t") == F.col("_from"), F.col("y")).otherwise(F.lit(fill)).alias("y"),
    )


def decomposed(series: DataFrame, item: str, *, period: int = 7) -> DataFrame:
    """Trend, seasonal part, fitted value and error of every point of regular series.

    All windows are partitioned by the series, so they share one shuffle.
    """
    whole, per_phase = Window.partitionBy(item), Window.partitionBy(item, "phase")
    d = series.select(
        "*",
        F.coalesce(F.regr_slope("y", "t").over(whole), F.lit(0.0)).alias("slope"),
        F.coalesce(F.regr_intercept("y", "t").over(whole), F.avg("y").over(whole)).alias("intercept"),
        F.count(F.lit(1)).over(whole).alias("n"),
        (F.col("t") % period).alias("phase"),
    )
    d = d.withColumn("trend", F.col("intercept") + F.col("slope") * F.col("t"))
    d = d.withColumn("seasonal", F.avg(F.col("y") - F.col("trend")).over(per_phase))
    d = d.withColumn("rest", F.col("y") - F.col("trend") - F.col("seasonal"))
    d = d.withColumn("_prev", F.lag("rest").over(whole.orderBy("t")))
    both, square = F.col("rest") * F.col("_prev"), F.col("_prev") * F.col("_prev")
    phi = F.coalesce(F.try_divide(F.sum(both).over(whole), F.sum(square).over(whole)), F.lit(0.0))
    d = d.withColumn("phi", phi)
    d = d.withColumn(
        "fitted", F.col("trend") + F.col("seasonal") + F.col("phi") * F.coalesce("_prev", F.lit(0.0))
    )
    return d.withColumn("error", F.col("y") - F.col("fitted")).drop("_prev")


def fitted_models(parts: DataFrame, item: str, day: str) -> DataFrame:
    """Coefficients per series: line, phi, error deviation, last date and last residual."""
    return parts.groupBy(item).agg(
        F.first("slope").alias("slope"),
        F.first("intercept").alias("intercept"),
        F.first("phi").alias("phi"),
        F.first("step").alias("step"),
        F.max("n").alias("n"),
        F.stddev_pop("error").alias("sigma"),
        F.max(day).alias("last_day"),
        F.max_by("rest", "t").alias("last_rest"),
        F.sort_array(F.collect_set(F.struct("phase", "seasonal"))).alias("season"),
    )


def normal_probability(z: Column) -> Column:
    """2 * Phi(|z|) - 1 by a fifth-order polynomial, off by less than 1.5e-7."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (
        0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))
    )
    return 1 - poly * F.exp(-x * x)


def anomalies(parts: DataFrame, item: str, *, threshold: float = 0.95, only_flagged: bool = True) -> DataFrame:
    """Points whose error is improbable for their series."""
    d = parts.withColumn("sigma", F.stddev_pop("error").over(Window.partitionBy(item)))
    z = F.when(F.col("sigma") > 0, F.col("error") / F.col("sigma")).otherwise(0.0)
    d = d.withColumn("anomaly_probability", normal_probability(z))
    d = d.withColumn("is_anomaly", F.col("anomaly_probability") > threshold)
    return d.where("is_anomaly") if only_flagged else d


def explained_forecast(models: DataFrame, item: str, *, horizon: int = 30, period: int = 7, z: float = Z95, calendar: DataFrame | None = None) -> DataFrame:
    """The next `horizon` steps of every series with trend, seasonal and interval parts.

    `calendar` (day, holiday_effect) adds its effects when given.
    """
    ahead = models.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    t = F.col("n") - 1 + F.col("h")
    season = F.filter("season", lambda s: s["phase"] == t % period)
    spread = F.when(F.abs(F.col("phi")) >= 1, F.sqrt("h")).otherwise(
        F.sqrt((1 - F.pow("phi", 2 * F.col("h"))) / (1 - F.col("phi") * F.col("phi")))
    )
    d = ahead.select(
        item,
        F.col("h").alias("step_ahead"),
        (F.col("last_day") + F.make_interval(days=F.col("h") * F.col("step"))).cast("date").alias("day"),
        (F.col("intercept") + F.col("slope") * t).alias("trend"),
        F.coalesce(F.get(season, 0)["seasonal"], F.lit(0.0)).alias("seasonal"),
        (F.pow("phi", F.col("h")) * F.col("last_rest")).alias("carried"),
        (F.col("sigma") * spread).alias("standard_error"),
    )
    if calendar is not None:
        d = d.join(calendar, "day", "left").na.fill(0.0, ["holiday_effect"])
    else:
        d = d.withColumn("holiday_effect", F.lit(0.0))
    d = d.withColumn("forecast", F.col("trend") + F.col("seasonal") + F.col("carried") + F.col("holiday_effect"))
    return d.select(
        "*",
        (F.col("forecast") - z * F.col("standard_error")).alias("lower_bound"),
        (F.col("forecast") + z * F.col("standard_error")).alias("upper_bound"),
    )


def insight_report(parts: DataFrame, item: str, *, threshold: float = 0.95) -> DataFrame:
    """One line per series and category, worded from its trend, seasonality and anomalies."""
    flagged = anomalies(parts, item, threshold=threshold, only_flagged=False)
    per = flagged.groupBy(item).agg(
        F.first("slope").alias("slope"),
        (F.max("seasonal") - F.min("seasonal")).alias("swing"),
        F.avg("y").alias("level"),
        F.avg(F.col("is_anomaly").cast("int")).alias("rate"),
    )
    direction = F.when(F.col("slope") > 0, "upward").when(F.col("slope") < 0, "downward").otherwise("flat")
    share = F.coalesce(F.try_divide("swing", "level"), F.lit(0.0)) * 100
    rows = F.array(
        F.struct(
            F.lit("Executive Summary").alias("category"),
            F.format_string("Seasonal swing is %.1f%% of the mean level.", share).alias("insight"),
        ),
        F.struct(
            F.lit("Trend Analysis").alias("category"), F.concat(F.lit("Demand is "), direction, F.lit(".")).alias("insight")
        ),
        F.struct(
            F.lit("Anomaly Risk").alias("category"),
            F.format_string("%.1f%% of the points are anomalous.", F.col("rate") * 100).alias("insight"),
        ),
    )
    return per.select(item, F.inline(rows))
