"""Regression errors of a (true, predicted) column pair, each set in one aggregation pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .running import counted_values, running


def percent_error(t: Column, p: Column) -> Column:
    """Signed error of one row in percent of the true value."""
    return (t - p) / t * 100


def regression_metrics(
    df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", *, by: list[str] = (), tweedie_power: float = 0.0
) -> DataFrame:
    """All pointwise metrics at once, per group when `by` is given.

    The `*_as_written` columns keep the formulas users of the earlier notebooks know;
    the columns without the suffix are the textbook ones.
    """
    t, p = F.col(y_true).cast("double"), F.col(y_pred).cast("double")
    err = t - p
    q = tweedie_power
    if q in (1.0, 2.0):
        raise ValueError("these Tweedie forms are undefined at powers 1 and 2")
    t_rest = F.pow(t, F.lit(1 - q))
    tweedie_old = 2 * (F.pow(p, F.lit(2 - q)) / ((1 - q) * t_rest) - p * F.pow(t, F.lit(-q)) + (1 - q) * t_rest)
    tweedie = 2 * (
        F.pow(t, F.lit(2 - q)) / ((1 - q) * (2 - q)) - t * F.pow(p, F.lit(1 - q)) / (1 - q) + F.pow(p, F.lit(2 - q)) / (2 - q)
    )
    aggs = [
        F.count(F.lit(1)).alias("n"),
        (F.avg(F.abs(err / t)) * 100).alias("mape"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.sum(err * err) / (F.var_pop(t) * F.count(t))).alias("r2"),
        (F.sum(F.abs(err)) / F.sum(F.abs(t)) * 100).alias("wape"),
        F.max(F.abs(err)).alias("max_error"),
        F.avg(err * err).alias("mse"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.pow(F.log1p(t) - F.log1p(p), 2)).alias("msle"),
        F.sqrt(F.avg(F.pow(F.log1p(t) - F.log1p(p), 2))).alias("rmsle"),
        F.avg(2 * (F.log(p / t) - p / t + 1)).alias("gamma_deviance_as_written"),
        F.avg(2 * (F.log(p / t) + t / p - 1)).alias("gamma_deviance"),
        F.avg(2 * (p - t * F.log(p))).alias("poisson_deviance_as_written"),
        F.avg(2 * (t * F.log(t / p) - t + p)).alias("poisson_deviance"),
        F.avg(tweedie_old).alias("tweedie_deviance_as_written"),
        F.avg(tweedie).alias("tweedie_deviance"),
        F.avg(F.abs(F.log1p(p) - F.log1p(t))).alias("d2_absolute_error_as_written"),
        (1 - F.var_pop(err) / F.var_pop(t)).alias("explained_variance"),
    ]
    return df.groupBy(*by).agg(*aggs)


def d2_absolute_error(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Textbook D2: 1 - MAE / MAE of the median, with the exact distributed median."""
    from .running import median_of

    mid = median_of(df, [], y_true).select("median").scalar()
    t, p = F.col(y_true), F.col(y_pred)
    return df.withColumn("_m", mid).agg(
        (1 - F.sum(F.abs(t - p)) / F.sum(F.abs(t - F.col("_m")))).alias("d2_absolute_error")
    )


def ks_two_sample(df: DataFrame, a: str, b: str, *, alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov: statistic, asymptotic p-value and whether it is below alpha."""
    sides = F.array(
        F.struct(F.col(a).alias("v"), F.lit(1).alias("ina"), F.lit(0).alias("inb")),
        F.struct(F.col(b).alias("v"), F.lit(0).alias("ina"), F.lit(1).alias("inb")),
    )
    both = df.select(F.inline_outer(sides))
    per_value = both.where("v is not null").groupBy("v").agg(F.sum("ina").alias("ca"), F.sum("inb").alias("cb"))
    upto = running(
        per_value, [], [F.col("v")], {"ua": ("sum", F.col("ca")), "ub": ("sum", F.col("cb"))},
        range_on=F.col("v"), bounds_from=both.select("v"), totals={"n_a": "ua", "n_b": "ub"},
    )
    gaps = upto.agg(
        F.max(F.abs(F.col("ua") / F.col("n_a") - F.col("ub") / F.col("n_b"))).alias("statistic"),
        F.max("n_a").alias("n_a"),
        F.max("n_b").alias("n_b"),
    )
    en = F.sqrt(F.col("n_a") * F.col("n_b") / (F.col("n_a") + F.col("n_b")))
    lam = en * F.col("statistic")
    tail = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2 * k * k * lam * lam),
    )
    p = F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * tail)))
    out = gaps.withColumn("p_value", p)
    return out.withColumn("reject", F.col("p_value") < alpha)


__all__ = ["counted_values", "d2_absolute_error", "ks_two_sample", "percent_error", "regression_metrics"]
