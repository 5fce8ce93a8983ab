"""Summaries, selection scores and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def survey_statistics(df: DataFrame, *, rating: str, issue: str, top: int = 3) -> DataFrame:
    """Number, mean rating, distribution and most frequent issues as (item, key, value)."""
    n = df.agg(F.count(F.lit(1)).cast("double").alias("value"))
    mean = df.agg(F.round(F.avg(rating), 9).alias("value"))
    spread = df.groupBy(F.col(rating).cast("int").cast("string").alias("key")).agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )
    issues = (
        df.where(F.col(issue).isNotNull())
        .groupBy(F.col(issue).alias("key"))
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .orderBy(F.desc("value"), "key")
        .limit(top)
    )

    def tag(d, item):
        key = F.col("key") if "key" in d.columns else F.lit("")
        return d.select(F.lit(item).alias("item"), key.alias("key"), "value")

    return (
        tag(n, "total_surveys")
        .unionByName(tag(mean, "avg_satisfaction"))
        .unionByName(tag(spread, "satisfaction"))
        .unionByName(tag(issues, "top_issue"))
    )


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("size"))


def benchmark_summary(df: DataFrame, *, model: str = "model_id") -> DataFrame:
    """Latency, similarity, tokens, cost and successes per model, rounded to 3 places."""

    def r(c, name):
        return F.round(c, 3).alias(name)

    return df.groupBy(model).agg(
        r(F.avg("latency"), "latency_mean"),
        r(F.stddev_samp("latency"), "latency_std"),
        r(F.min("latency"), "latency_min"),
        r(F.max("latency"), "latency_max"),
        r(F.avg("similarity"), "similarity_mean"),
        r(F.stddev_samp("similarity"), "similarity_std"),
        r(F.avg("tokens"), "tokens_mean"),
        r(F.sum("cost"), "cost_sum"),
        F.count_if("success").alias("successes"),
    )


def success_counts(df: DataFrame, *, model: str = "model_id") -> DataFrame:
    return df.groupBy(model, "success").agg(F.count(F.lit(1)).alias("n"))


def selection_scores(
    df: DataFrame,
    *,
    model: str = "model_id",
    latency: str = "latency",
    quality: str = "similarity",
    cost: str = "cost",
    total_cost: bool = True,
    weights: tuple[float, float, float] = (0.5, 0.3, 0.2),
) -> DataFrame:
    """Weighted quality/latency/cost score per model over successful rows, best first.

    Latency and cost count as 1 minus their share of the largest among the models; a
    largest cost of 0 counts as 1. The window runs over one row per model only.
    """
    if "success" in df.columns:
        df = df.where(F.col("success"))
    per = df.groupBy(model).agg(
        F.avg(latency).alias("avg_latency"),
        F.avg(quality).alias("avg_similarity"),
        (F.sum(cost) if total_cost else F.avg(cost)).alias("model_cost"),
        F.count(F.lit(1)).alias("n"),
    )
    every = Window.partitionBy(F.lit(0))
    wq, wl, wc = weights
    scored = per.select(
        "*",
        (1 - F.col("avg_latency") / F.max("avg_latency").over(every)).alias("latency_score"),
        F.when(F.max("model_cost").over(every) == 0, 1.0)
        .otherwise(1 - F.col("model_cost") / F.max("model_cost").over(every))
        .alias("cost_score"),
    ).withColumn(
        "overall_score",
        wq * F.col("avg_similarity") + wl * F.col("latency_score") + wc * F.col("cost_score"),
    )
    rank = F.row_number().over(every.orderBy(F.desc("overall_score"), model))
    return scored.withColumn("rank", rank).withColumn(
        "role", F.when(F.col("rank") == 1, "primary").otherwise("fallback")
    )


def best_per_use_case(df: DataFrame, *, model: str = "model_id", use_case: str = "use_case") -> DataFrame:
    """The model with the highest mean similarity per use case, lowest id on ties."""
    if "success" in df.columns:
        df = df.where(F.col("success"))
    per = df.groupBy(use_case, model).agg(F.avg("similarity").alias("mean_similarity"))
    first = F.row_number().over(Window.partitionBy(use_case).orderBy(F.desc("mean_similarity"), model))
    return per.withColumn("_r", first).where("_r = 1").drop("_r")


def speed_up(df: DataFrame, *, model: str, slow: str, fast: str, times: list[str]) -> DataFrame:
    """Mean times of two models side by side: saved percent and ratio, one row per time column."""
    done = df.where(F.col(times[0]).isNotNull() & F.col(model).isin(slow, fast))

    def mean(which, t):
        return F.avg(F.when(F.col(model) == which, F.col(t)))

    means = done.agg(
        *[F.struct(mean(slow, t).alias("s"), mean(fast, t).alias("f")).alias(f"_{t}") for t in times]
    )
    rows = F.array(*[F.struct(F.lit(t).alias("time"), F.col(f"_{t}").alias("m")) for t in times])
    s, f = F.col("m.s"), F.col("m.f")
    return means.select(F.inline(rows)).select(
        "time",
        s.alias("slow_mean"),
        f.alias("fast_mean"),
        ((s - f) / s * 100).alias("saved_percent"),
        (s / f).alias("ratio"),
    )


def value_counts(df: DataFrame, col: str, *, top: int | None = None) -> DataFrame:
    out = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.desc("n"), col).limit(top) if top else out


def distribution_with_zeros(df: DataFrame, label: str, labels: list[str]) -> DataFrame:
    """Count and percent of the total for every label of the list, zero when absent."""
    dims = df.sparkSession.createDataFrame([(x,) for x in labels], f"{label} string")
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    full = dims.join(counts, label, "left").select(label, F.coalesce("n", F.lit(0)).alias("n"))
    every = Window.partitionBy(F.lit(0))  # one row per label
    return full.withColumn("percent", F.col("n") / F.sum("n").over(every) * 100)


def label_by_source(df: DataFrame, source: str, label: str, *, known: list[str], default: str, labels: list[str]) -> DataFrame:
    """Label counts per source; sources not in the list count as the default one."""
    src = F.when(F.col(source).isin(known), F.col(source)).otherwise(default)
    return df.groupBy(src.alias("source")).pivot(label, labels).agg(F.count(F.lit(1))).na.fill(0)


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """How often two labels agree, whatever their case."""
    same = F.upper(a) == F.upper(b)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(same).alias("agreed"),
        F.avg(same.cast("double")).alias("rate"),
    )


def top_nested(df: DataFrame, items: str, field: str, *, top: int, first: int | None = None, lower: bool = False) -> DataFrame:
    """Most frequent values of a field in an array of structs (of its first elements, if given)."""
    arr = F.slice(items, 1, first) if first else F.col(items)
    value = F.col(f"_i.{field}")
    counts = (
        df.select(F.explode_outer(arr).alias("_i"))
        .where(F.col("_i").isNotNull())
        .groupBy((F.lower(value) if lower else value).alias(field))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.orderBy(F.desc("n"), field).limit(top)


def term_counts_over(df: DataFrame, text: str, *, min_length: int = 4, top: int = 10) -> DataFrame:
    """Most frequent lower-cased words of at least `min_length` characters."""
    from ..functions.text import words

    w = df.select(F.explode_outer(words(F.lower(F.col(text)))).alias("term")).where(F.length("term") >= min_length)
    counts = w.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "term").limit(top)


def method_means(df: DataFrame, by: list[str], metrics: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.avg(m).alias(f"mean_{m}") for m in metrics])


def best_per_category(df: DataFrame, category: str, strategy: str, metric: str) -> DataFrame:
    """The strategy with the best mean per category, first by name on ties."""
    per = df.groupBy(category, strategy).agg(F.avg(metric).alias("mean"))
    first = F.row_number().over(Window.partitionBy(category).orderBy(F.desc("mean"), strategy))
    return per.withColumn("_r", first).where("_r = 1").drop("_r")


def improvement(df: DataFrame, strategy: str, metric: str, *, base: str) -> DataFrame:
    """Mean per strategy and its change in percent against the base strategy."""
    per = df.groupBy(strategy).agg(F.avg(metric).alias("mean"))
    every = Window.partitionBy(F.lit(0))  # one row per strategy
    b = F.max(F.when(F.col(strategy) == base, F.col("mean"))).over(every)
    return per.withColumn("improvement_percent", (F.col("mean") - b) / b * 100)


def slower_than_fastest(df: DataFrame, store: str, latency: str) -> DataFrame:
    """Rank of each store and how many percent it is slower than the fastest."""
    every = Window.partitionBy(F.lit(0))  # one row per store
    low = F.min(latency).over(every)
    return df.select(
        "*",
        F.rank().over(every.orderBy(latency)).alias("rank"),
        ((F.col(latency) - low) / low * 100).alias("slower_percent"),
    )


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation and range per numeric column, in one pass."""
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).alias("count"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            ).alias(f"_{c}")
        )
    return df.agg(*aggs).select(F.inline(F.array(*[F.col(f"_{c}") for c in columns])))


def score_spread(df: DataFrame, by: list[str], score: str, *, flat_below: float = 1e-5) -> DataFrame:
    """Mean, range and population variance of scores, flagged when they hardly differ."""
    return (
        df.groupBy(*by)
        .agg(
            F.avg(score).alias("mean"),
            F.min(score).alias("min"),
            F.max(score).alias("max"),
            F.var_pop(score).alias("variance"),
        )
        .withColumn("flat", F.col("variance") < flat_below)
    )


def margin_uplift(df: DataFrame, query: str, *, before: str, after: str, margin: str, k: int = 3) -> DataFrame:
    """Margin of the first k rows in the old and in the new order, and the gain in percent.

    `before` and `after` are rank columns starting at 1, so no sort is needed.
    """
    sums = df.where((F.col(before) <= k) | (F.col(after) <= k)).groupBy(query).agg(
        F.sum(F.when(F.col(before) <= k, F.col(margin)).otherwise(0.0)).alias("margin_before"),
        F.sum(F.when(F.col(after) <= k, F.col(margin)).otherwise(0.0)).alias("margin_after"),
    )
    gain = F.try_divide(F.col("margin_after") - F.col("margin_before"), F.col("margin_before")) * 100
    return sums.withColumn("uplift_percent", gain)


def run_rules(df: DataFrame, rules: dict) -> DataFrame:
    """Data-quality rules as (rule, passed): each a boolean aggregate, all in one pass."""
    cells = df.agg(*[c.alias(f"r{i}") for i, c in enumerate(rules.values())])
    rows = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("passed")) for i, n in enumerate(rules)]
    )
    return cells.select(F.inline(rows))


def first_of_prefix(df: DataFrame, by: list[str], text: str, order: list[str], *, chars: int = 100) -> DataFrame:
    """Keep the first row, in the given order, of every group sharing the first `chars` characters."""
    key = F.substring(F.col(text), 1, chars)
    rank = F.row_number().over(Window.partitionBy(*by, key).orderBy(*order))
    return df.withColumn("_r", rank).where("_r = 1").drop("_r")


def distinct_for_encoding(df: DataFrame, text: str, *, key: str = "content_key") -> DataFrame:
    """One row per distinct text: what an encoder has to see. Join back on the key."""
    return df.select(F.md5(text).alias(key), F.col(text)).dropDuplicates([key])


def distinct_share(df: DataFrame, text: str) -> DataFrame:
    """Total rows, distinct texts and the share an encoder need not see."""
    per = df.groupBy(F.md5(text).alias("k")).agg(F.count(F.lit(1)).alias("c"))
    return per.agg(
        F.sum("c").alias("total"),
        F.count(F.lit(1)).alias("distinct_texts"),
        (1 - F.count(F.lit(1)) / F.sum("c")).alias("saved_share"),
    )


def token_cost(tokens, model, *, family: str = "claude-3", price: float = 0.002, other: float = 0.001):
    """Cost of a call: tokens in thousands times the price of the model family."""
    return F.col(tokens) / 1000 * F.when(F.col(model).contains(family), price).otherwise(other)


def named_metrics(df: DataFrame, metric: str, value: str, names: list[str]) -> DataFrame:
    """Count, mean and range of the declared metrics; others are ignored."""
    return (
        df.where(F.col(metric).isin(names))
        .groupBy(metric)
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg(value).alias("average"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
    )
