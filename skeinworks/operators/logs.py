"""Search and attempt logs: latency statistics, variants, failure states, alarms, memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as fv
from .running import (
    before_range,
    exclusive_quantile_of,
    median_of,
    placed_by_range,
    totals_per_range,
    values_at,
    with_carried,
)


def search_statistics(df: DataFrame, *, by: list[str], latency: str = "latency_ms", results: str = "result_count") -> DataFrame:
    """Totals, success percent, latency mean/range/p50/p95 and results, per group.

    p50 is the sorted value at n // 2 and p95 the one at int(0.95 n), both exact and
    picked without collecting a group.
    """
    picks = {"latency_p50": lambda n: F.floor(n / 2), "latency_p95": lambda n: F.least(n - 1, F.floor(n * F.lit(0.95)))}
    flat = {
        "total": (F.count(F.lit(1)), F.sum),
        "successful": (F.count_if("success"), F.sum),
        "_latency": (F.sum(F.col(latency).cast("double")), F.sum),
        "latency_min": (F.min(latency), F.min),
        "latency_max": (F.max(latency), F.max),
        "_found": (F.count(results), F.sum),
        "results_total": (F.sum(results), F.sum),
    }
    d = values_at(df, by, latency, picks, flat=flat)
    return d.select(
        *by,
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("successful", F.lit(0)).alias("successful"),
        (F.try_divide("successful", "total") * 100).alias("success_percent"),
        F.try_divide("_latency", "n").alias("latency_avg"),
        "latency_min",
        "latency_max",
        F.try_divide("results_total", "_found").alias("results_avg"),
        "results_total",
        *picks,
    )


def answer_log_summary(df: DataFrame, *, by: list[str], time: str = "total_time", sources: str = "result_count") -> DataFrame:
    """Totals, success and cache-hit percent, mean time, exclusive p95 and mean sources."""
    flat = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.count_if("success").alias("successful_queries"),
        (F.avg(F.col("success").cast("double")) * 100).alias("success_rate"),
        (F.avg(F.col("from_cache").cast("double")) * 100).alias("cache_hit_rate"),
        F.avg(time).alias("avg_total_time"),
        F.avg(sources).alias("avg_sources"),
    )
    return flat.join(exclusive_quantile_of(df, by, time, name="p95_total_time").drop("n"), by)


def satisfaction(df: DataFrame, rating: str, *, good: str = "good") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_feedback"),
        F.count_if(F.col(rating) == good).alias("good_ratings"),
        (F.count_if(F.col(rating) == good) / F.count(F.lit(1)) * 100).alias("satisfaction_rate"),
    )


def compare_variants(df: DataFrame, variant: str, metric: str) -> DataFrame:
    """Count, mean, median and sample deviation (0 for one row) per variant; lowest mean wins."""
    flat = df.groupBy(variant).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(metric).alias("avg_metric"),
        F.coalesce(F.stddev_samp(metric), F.lit(0.0)).alias("std_dev"),
    )
    both = flat.join(median_of(df, [variant], metric, "median_metric").drop("n"), variant)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("avg_metric", variant))  # one row per variant
    return both.withColumn("winner", rank == 1)


def store_benchmark(df: DataFrame, store: str, query: str, latency: str, results: str) -> DataFrame:
    """Mean latency per query first, then mean, range and index p95 over the queries of a store.

    The mean result count is over all runs that found anything.
    """
    found = F.when(F.col(results) > 0, F.col(results))
    per_query = df.groupBy(store, query).agg(
        F.avg(latency).alias("m"), F.sum(found).alias("r"), F.count(found).alias("c")
    )
    flat = per_query.groupBy(store).agg(
        F.avg("m").alias("avg_latency"),
        F.min("m").alias("min_latency"),
        F.max("m").alias("max_latency"),
        F.coalesce(F.try_divide(F.sum("r"), F.sum("c")), F.lit(0.0)).alias("avg_results"),
    )
    p95 = values_at(per_query, [store], "m", {"p95_latency": lambda n: F.least(n - 1, F.floor(n * F.lit(0.95)))})
    return flat.join(p95.drop("n"), store)


def failure_state(
    df: DataFrame, key: str, ts: str, tie: str, ok: str, *, opens_above: int = 5, carried: DataFrame | None = None
) -> DataFrame:
    """Consecutive failures after each attempt, and whether the circuit is open then.

    A busy key is cut into time ranges that run in tasks of their own. Within a range the count
    is failures so far minus failures at the last success; what a range hands to the next is its
    failures and the failures after its last success. `carried` (key, failures) is where the
    keys start from.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    part = [key, "_range"]
    placed = placed_by_range(df, [key], at)
    local = Window.partitionBy(*part).orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = placed.withColumn("_f", F.sum((~F.col(ok)).cast("int")).over(local))
    scanned = scanned.withColumn("_base", F.max(F.when(F.col(ok), F.col("_f"))).over(local))
    sums = totals_per_range(scanned, [key], [F.max("_f").alias("_t"), F.max("_base").alias("_b")])
    # failures of all earlier ranges, and how many of them lie before the last success seen there
    sums = sums.withColumn("_sofar", F.coalesce(F.sum("_t").over(before_range([key])), F.lit(0)))
    settled = F.max(F.col("_sofar") + F.col("_b")).over(before_range([key]))
    handed = sums.withColumn("_settled", settled).select(
        *[F.col(c).alias(f"_k_{c}") for c in part],
        F.when(F.col("_settled").isNull(), F.col("_sofar")).otherwise(F.col("_sofar") - F.col("_settled")).alias("_open"),
        F.col("_settled").isNull().alias("_never"),
    )
    d = with_carried(scanned, handed, part)
    if carried is not None:
        start = carried.select(F.col(key).alias("_s_key"), F.col("failures").alias("_start"))
        d = d.join(start, F.col(key) == F.col("_s_key"), "left")
        opening = F.col("_open") + F.when(F.col("_never"), F.coalesce("_start", F.lit(0))).otherwise(0)
    else:
        opening = F.col("_open")
    count = F.when(F.col("_base").isNull(), F.col("_f") + opening).otherwise(F.col("_f") - F.col("_base"))
    return d.select(
        *df.columns, count.cast("long").alias("failure_count"), (count > opens_above).alias("is_open")
    )


def routed_outcome(df: DataFrame, request: str, attempt: str, tier: str, ok: str, *, retries: int = 3) -> DataFrame:
    """Which tier answered each request: primary, else fallback, else degraded."""
    tried = df.where(F.col(attempt) <= retries)

    def first_ok(t):
        return F.min(F.when(F.col(ok) & (F.col(tier) == t), F.col(attempt)))

    per = tried.groupBy(request).agg(first_ok("primary").alias("_p"), first_ok("fallback").alias("_f"))
    used = F.when(F.col("_p").isNotNull(), "primary").when(F.col("_f").isNotNull(), "fallback").otherwise("degraded")
    return per.select(request, used.alias("model_used"), F.coalesce("_p", "_f").alias("attempt"))


def alarms(
    df: DataFrame, ts: str, value: str, *, statistic: str, threshold: float, periods: int,
    seconds: int = fv.ALARM_PERIOD_SECONDS, by: list[str] = (),
) -> DataFrame:
    """Periods at which the statistic has been over the threshold for `periods` in a row.

    The window sees one row per period, not the log.
    """
    agg = {"avg": F.avg, "sum": F.sum}[statistic]
    per = (
        df.groupBy(*by, F.window(ts, f"{seconds} seconds").alias("_w"))
        .agg(agg(value).alias("statistic"))
        .withColumn("period_start", F.col("_w.start"))
        .drop("_w")
    )
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy("period_start")
    last = w.rowsBetween(-(periods - 1), 0)
    breach = (F.col("statistic") > threshold).cast("int")
    gap = F.expr(f"INTERVAL '{seconds * (periods - 1)}' SECOND")
    flagged = per.select(
        "*",
        F.min(breach).over(last).alias("_all"),
        F.count(F.lit(1)).over(last).alias("_n"),
        F.min("period_start").over(last).alias("_first"),
    )
    whole = (F.col("_n") == periods) & (F.col("_first") == F.col("period_start") - gap)
    return flagged.withColumn("alarm", (F.col("_all") == 1) & whole).drop("_all", "_n", "_first")


def last_turns(df: DataFrame, conversation: str, turn: str, *, keep: int = 10) -> DataFrame:
    """The latest `keep` turns of each conversation; older ones are cut before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(conversation).orderBy(F.desc(turn)))
    return df.withColumn("_r", rank).where(F.col("_r") <= keep).drop("_r")


def conversation_context(df: DataFrame, conversation: str, turn: str, question: str, answer: str, *, turns: int = 3) -> DataFrame:
    """The last turns as one `Q: ... A: ...` text; at most `turns` rows meet in a group."""
    said = F.concat(F.lit("Q: "), F.col(question), F.lit("\nA: "), F.col(answer), F.lit("\n\n"))
    recent = last_turns(df, conversation, turn, keep=turns).select(conversation, F.struct(turn, said.alias("s")).alias("p"))
    return recent.groupBy(conversation).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda x: x["s"]), "").alias("context")
    )


def context_budget(
    df: DataFrame, query: str, order: str, text: str, *, max_tokens: int = 3000, chars_per_token: int = 4, keep_above: int = 100
) -> DataFrame:
    """Rows in order while they fit; the first that does not is cut when enough room is left.

    Meant for the few retrieved rows of a query; the running sum stops reading nothing
    else than those.
    """
    room = max_tokens * chars_per_token
    w = Window.partitionBy(query).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = df.withColumn("_len", F.length(text)).withColumn("_upto", F.sum("_len").over(w))
    left = F.lit(room) - (F.col("_upto") - F.col("_len"))
    first_over = (F.col("_upto") > room) & (left >= 0)
    # only the very first overflowing row may be cut: everything before it must have fitted
    over_before = F.max((F.col("_upto") > room).cast("int")).over(
        Window.partitionBy(query).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    d = d.withColumn("_cut", first_over & (F.coalesce(over_before, F.lit(0)) == 0)).withColumn("_left", left)
    kept = d.where((F.col("_upto") <= room) | (F.col("_cut") & (F.col("_left") > keep_above)))
    short = F.concat(F.col(text).substr(F.lit(1), F.col("_left")), F.lit("..."))
    return kept.withColumn(text, F.when(F.col("_cut"), short).otherwise(F.col(text))).withColumn(
        "truncated", F.col("_cut")
    ).drop("_len", "_upto", "_cut", "_left")


def traffic_split(key: Column, share: float) -> Column:
    """Variant of a key: B for int(100 * share) percent of the keys, A for the others."""
    from .filters import hash_number

    return F.when(hash_number(key) % 100 < int(share * 100), "B").otherwise("A")
