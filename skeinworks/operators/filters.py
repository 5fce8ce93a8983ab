"""Row filters, record validation and triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

RISK_SCHEMA = "fraud_probability_score double, risk_factors array<string>, executive_summary string"


def only_true(df: DataFrame, flag: str) -> DataFrame:
    """Rows where the flag is true; null counts as not."""
    return df.where(F.col(flag))


def min_length(df: DataFrame, text: str, n: int = 10, *, stripped: bool = True) -> DataFrame:
    from ..functions.text import strip

    return df.where(F.length(strip(text) if stripped else F.col(text)) >= n)


def metadata_filter(df: DataFrame, wanted: dict) -> DataFrame:
    """A scalar means equality, a list membership; all must hold."""
    for col, v in wanted.items():
        df = df.where(F.col(col).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(col) == v)
    return df


def best_scored(
    df: DataFrame, score: str, *, min_score: float = 0.5, limit: int = 10, by: list[str] = (), tie: list[str] = ()
) -> DataFrame:
    """Rows scoring at least `min_score` (no score counts as 0), the best `limit` (per `by`)."""
    scored = df.withColumn(score, F.coalesce(F.col(score), F.lit(0.0))).where(F.col(score) >= min_score)
    order = [F.col(score).desc(), *[F.col(c) for c in tie]]
    if not by:
        return scored.orderBy(*order).limit(limit)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return scored.withColumn("rank", rank).where(F.col("rank") <= limit)


def look_back(df: DataFrame, ts: str, as_of: Column, hours: int) -> DataFrame:
    """Rows strictly later than `hours` before `as_of`."""
    return df.where(F.col(ts) > as_of - F.make_interval(hours=F.lit(hours)))


def past_retention(df: DataFrame, created: str, as_of: Column, days: int = 7) -> DataFrame:
    return df.where(F.col(created) < as_of - F.make_interval(days=F.lit(days)))


def recent_with_notes(df: DataFrame, ts: str, notes: str, as_of: Column, months: int = 24) -> DataFrame:
    return df.where((F.col(ts) >= as_of - F.make_interval(months=F.lit(months))) & F.col(notes).isNotNull())


def hash_sample(df: DataFrame, key: str, *, one_in: int = 1000) -> DataFrame:
    """A repeatable sample: keys whose md5 falls on a multiple of `one_in`."""
    return df.where(hash_number(F.col(key).cast("string")) % one_in == 0)


def hash_number(text: Column, digits: int = 8) -> Column:
    """A number from the leading hex digits of md5, equal in any engine."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def validated(df: DataFrame, required: list[str], numeric: list[str]) -> DataFrame:
    """Add `errors` (array) and `valid`: required fields present, numeric fields numbers."""
    checks = [
        F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(f"{c} missing")) for c in required
    ]
    checks += [
        F.when(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull(), F.lit(f"{c} not a number"))
        for c in numeric
    ]
    d = df.withColumn("errors", F.array_compact(F.array(*checks)))
    return d.withColumn("valid", F.size("errors") == 0)


def require_columns(df: DataFrame, features: list[str]) -> DataFrame:
    """Fail while planning, naming the features that are absent."""
    absent = [f for f in features if f not in df.columns]
    if absent:
        raise ValueError(f"missing required features: {absent}")
    return df


def risk_result_valid(parsed: Column) -> Column:
    """A generated summary is usable: parsed, score in 0..1, a list of factors, some text."""
    v = parsed["value"]
    ok = (
        parsed["ok"]
        & v["fraud_probability_score"].between(0.0, 1.0)
        & v["risk_factors"].isNotNull()
        & (F.length(v["executive_summary"]) > 0)
    )
    return F.coalesce(ok, F.lit(False))


def triage_precision(df: DataFrame, score: str, confirmed: str, *, threshold: float = 0.7) -> DataFrame:
    """How many rows are flagged and which share of those is confirmed."""
    return df.where(F.col(score) >= threshold).agg(
        F.count(F.lit(1)).alias("flagged"),
        F.count_if(F.col(confirmed)).alias("confirmed"),
        F.avg(F.col(confirmed).cast("double")).alias("precision"),
    )
