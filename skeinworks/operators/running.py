"""Running aggregates and exact order statistics without one-task windows.

A window over a whole table, or over one hot key, sorts everything in a single
task. Here the order column is cut into ranges of about equal row counts; each
(key, range) runs in its own task and gets the totals of the ranges before it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

_MERGE = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest, "min": F.least}
_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def range_count(df: DataFrame) -> int:
    """As many ranges as shuffle partitions."""
    return max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def bounds_below(bounds: Column, count: int, value: Column) -> Column:
    """How many of `count` sorted bounds lie below the value.

    Counted among every step-th bound first and then between two of those, so a row looks at twice
    the root of their number.
    """
    step = max(1, math.isqrt(count))
    marks = F.sequence(F.lit(step), F.lit(count), F.lit(step)) if count >= step else F.array().cast("array<int>")
    coarse = F.size(F.filter(marks, lambda i: F.element_at(bounds, i) < value))
    return coarse * step + F.size(F.filter(F.slice(bounds, coarse * step + 1, F.lit(step)), lambda b: b < value))


def with_range(
    df: DataFrame, on: Column, *, ranges: int | None = None, name: str = "_range", bounds_from: DataFrame | None = None
) -> DataFrame:
    """Add the number of the equal-count range that `on` (numeric) falls into.

    The bounds come from one pass over that single column, of `bounds_from` when given.
    """
    ranges = ranges or range_count(df)
    steps = [i / ranges for i in range(1, ranges)]
    source = bounds_from if bounds_from is not None else df
    bounds = source.agg(F.percentile_approx(on.cast("double"), steps, max(10_000, 10 * ranges))).scalar()
    inside = bounds_below(F.col("_bounds"), len(steps), on.cast("double"))
    return df.withColumn("_bounds", bounds).withColumn(name, F.coalesce(inside, F.lit(0))).drop("_bounds")


def placed_by_range(df: DataFrame, keys: list[str], on: Column, **options) -> DataFrame:
    """Rows shuffled once by (key, range); windows and sums per (key, range) need no other shuffle."""
    ranged = with_range(df, on, **options)
    return ranged.repartition(*[F.col(c) for c in (*keys, "_range")])


def totals_per_range(placed: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """One row per (key, range).

    It reads every column of `placed`, like the windows do: with fewer columns it would be
    planned on a shuffle of its own, and the input would be computed twice. So select the
    columns that are wanted before calling these operators, not after.
    """
    per = placed.groupBy(*keys, "_range").agg(*aggs, F.max(F.xxhash64(*placed.columns)).alias("_read"))
    return per.where(F.col("_read").isNotNull()).drop("_read")


def before_range(keys: list[str]):
    """The ranges of a key ahead of the present one: at most as many rows as there are ranges."""
    return Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    aggs: dict[str, tuple[str, Column]],
    *,
    range_on: Column,
    ranges: int | None = None,
    bounds_from: DataFrame | None = None,
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running sum/min/max columns per key in the given order.

    `aggs` maps an output name to (kind, column). `range_on` must be numeric and must sort like
    the first order column. `totals` adds, per key, the overall value of a running column.
    """
    part = [*keys, "_range"]
    placed = placed_by_range(df, keys, range_on, ranges=ranges, bounds_from=bounds_from)
    sums = totals_per_range(placed, keys, [_AGG[k](c).alias(f"_t_{n}") for n, (k, c) in aggs.items()])
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    carried = sums.select(
        *[F.col(c).alias(f"_k_{c}") for c in part],
        *[_AGG[k](f"_t_{n}").over(before_range(keys)).alias(f"_c_{n}") for n, (k, _) in aggs.items()],
        *[_AGG[aggs[n][0]](f"_t_{n}").over(whole).alias(out) for out, n in (totals or {}).items()],
    )
    local = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = placed.select("*", *[_AGG[k](c).over(local).alias(f"_l_{n}") for n, (k, c) in aggs.items()])
    joined = with_carried(scanned, carried, part)
    merged = [_MERGE[k](F.col(f"_l_{n}"), F.col(f"_c_{n}")).alias(n) for n, (k, _) in aggs.items()]
    return joined.select(*df.columns, *merged, *(totals or {}))


#: Rows of a key that one task sorts.
WHOLE_ROWS = 1 << 21


def running_within(df: DataFrame, keys: list[str], order: list[Column], aggs: dict[str, tuple[str, Column]], *, range_on: Column) -> DataFrame:
    """`running`, where keys are expected to have few rows each: if none has over WHOLE_ROWS, a key is not cut into ranges.

    Rows that lie together by key already are then not shuffled. The largest key is found in a pass of its own. Where
    `range_on` is null or NaN somewhere, such rows have the place among the others that `running` gives them.
    """
    odd = F.count_if(range_on.isNull() | F.isnan(range_on.cast("double")))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), odd.alias("odd")).agg(F.max("n"), F.sum("odd")).first()
    if (sizes[0] or 0) > WHOLE_ROWS:
        return running(df, keys, order, aggs, range_on=range_on)
    ranged = with_range(df, range_on) if sizes[1] else df
    sort = [F.col("_range"), *order] if sizes[1] else order
    upto = Window.partitionBy(*keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = [(F.coalesce(_AGG[k](c).over(upto), F.lit(0)) if k == "sum" else _AGG[k](c).over(upto)).alias(n) for n, (k, c) in aggs.items()]
    return ranged.select(*df.columns, *found)


def with_carried(scanned: DataFrame, carried: DataFrame, part: list[str]) -> DataFrame:
    return scanned.join(carried, _all([F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in part]), "left")


def _all(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def counted_values(
    df: DataFrame, keys: list[str], value: str, *, ranges: int | None = None, totals: dict[str, str] | None = None
) -> DataFrame:
    """Distinct values per key with their count `n` and running count `upto`."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return running(
        counts, keys, [F.col(value)], {"upto": ("sum", F.col("n"))},
        range_on=F.col(value), ranges=ranges, bounds_from=df.select(value), totals=totals,
    )


#: Bins of a doubling, and parts of a bin, in the histograms that find order statistics.
OCTAVE, FINE = 1 << 11, 1 << 20
#: Groups of at most so many rows go to every task as wanted bins.
BROADCAST_GROUPS = 20_000


def value_bin(value: str, parts: int = 1) -> Column:
    """A number that never falls as the column `value` grows: OCTAVE * parts bins between each power of two and the next.

    Values below zero mirror those above; the infinities and NaN, which is greater than all, have bins of their own.
    """
    v, bins, last = f"cast(`{value}` as double)", OCTAVE * parts, 1 << 50
    power = f"floor(log2(abs({v})))"
    within = f"least(greatest(abs({v}) / pow(2D, {power}) - 1, 0D), {1 - 2.0**-53!r}D)"
    return F.expr(
        f"case when `{value}` is null then null when {v} = 0 then 0L when isnan({v}) then {last + 1}L"
        f" when abs({v}) = double('infinity') then if({v} > 0, {last}L, -{last}L)"
        f" else if({v} > 0, 1L, -1L) * (({power} + 1100) * {bins}L + floor({within} * {bins}L) + 1) end"
    )


def _at_index(histogram: str, at: str, kind: str) -> Column:
    """Of sorted structs (bin of the type `kind`, n) the `bin` that holds the 0-based index `at`, its n, and the index within it (`rest`)."""
    here = f"s.rest is null and {at} >= 0 and {at} < s.upto + x.n"
    return F.expr(
        f"aggregate({histogram}, named_struct('upto', 0L, 'bin', cast(null as {kind}), 'n', 0L, 'rest', cast(null as bigint)),"
        f" (s, x) -> named_struct('upto', s.upto + x.n, 'bin', if({here}, x.bin, s.bin), 'n', if({here}, x.n, s.n), 'rest', if({here}, {at} - s.upto, s.rest)))"
    )


def _attached(df: DataFrame, few: DataFrame, keys: list[str], column: str, *, small: bool, how: str = "inner") -> DataFrame:
    """`df` with a column of `few`, which has one row per key, or one row."""
    if not keys:
        return df.withColumn(column, few.select(column).scalar())
    named = few.select(*[F.col(k).alias(f"_k_{k}") for k in keys], column)
    on = _all([F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(F.broadcast(named) if small else named, on, how).drop(*[f"_k_{k}" for k in keys])


def values_at(df: DataFrame, keys: list[str], value: str, picks: dict, *, flat: dict[str, tuple] | None = None) -> DataFrame:
    """Exact sorted-order picks: for each name, the value at 0-based index picks[name](n).

    `n` is the column with the number of non-null values of the key. The result has the keys,
    `n`, one column per pick, and those of `flat`: each a pair of a partial aggregate over rows and a
    function that adds such partial results up, taken in the same pass.

    No group is sorted. A first pass counts values in bins of a histogram; where bins that hold a wanted
    index have over FINE rows, a second looks only into those and counts finer ones; the last counts the
    values of the bins that are left. Counts are
    added up before they are shuffled; what meets per key are bins, of which each level has a bounded
    number whatever the number of rows, and a value that fills a whole group is a single bin.
    """
    flat = flat or {}
    v = F.col(value)
    binned = df.groupBy(*keys, value_bin(value).alias("_bin")).agg(F.count(v).alias("_n"), *[part.alias(f"_f_{n}") for n, (part, _) in flat.items()])
    bins = cut_lineage(binned)
    pair = F.when(F.col("_n") > 0, F.struct(F.col("_bin").alias("bin"), F.col("_n").alias("n")))
    held = bins.groupBy(*keys).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n"),
        F.sort_array(F.collect_list(pair)).alias("_h"),
        *[add(F.col(f"_f_{n}")).alias(n) for n, (_, add) in flat.items()],
    )
    held = held.select("*", *[index(F.col("n")).cast("long").alias(f"_0_{name}") for name, index in picks.items()])
    held = held.select(*keys, "n", *flat, *[_at_index("_h", f"`_0_{name}`", "bigint").alias(f"_1_{name}") for name in picks])
    largest = F.greatest(*[F.col(f"_1_{name}.n") for name in picks], F.lit(0))
    groups, most = held.agg(F.count(F.lit(1)), F.coalesce(F.max(largest), F.lit(0))).first()
    small = groups <= BROADCAST_GROUPS

    def level(found: DataFrame, before: int, coarse: Column, fine: Column, kind: str) -> DataFrame:
        """`found` with, for each name, the bin of the wanted bins' contents, which `fine` orders."""
        wanted = found.select(*keys, F.array_distinct(F.array(*[F.col(f"_{before}_{name}.bin") for name in picks])).alias("_wanted"))
        rows = df.where(v.isNotNull()).select(*keys, coarse.alias("_coarse"), fine.alias("_fine"))
        rows = _attached(rows, wanted, keys, "_wanted", small=small).where(F.array_contains("_wanted", F.col("_coarse")))
        counts = rows.groupBy(*keys, "_coarse", "_fine").agg(F.count(F.lit(1)).alias("_n"))
        order = F.struct("_coarse", F.col("_fine").alias("bin"), F.col("_n").alias("n"))
        per = counts.groupBy(*keys).agg(F.sort_array(F.collect_list(order)).alias("_h"))
        out = _attached(found, per, keys, "_h", small=False, how="left")

        def taken(name: str) -> Column:
            prior = f"`_{before}_{name}`"
            return _at_index(f"filter(_h, x -> x._coarse = {prior}.bin)", f"{prior}.rest", kind).alias(f"_{before + 1}_{name}")

        return out.select(*found.columns, *[taken(name) for name in picks])

    last, kind = 2, dict(df.dtypes)[value]
    if most > FINE:
        held, last = cut_lineage(level(held, 1, value_bin(value), value_bin(value, FINE), "bigint")), 3
    held = level(held, last - 1, value_bin(value, FINE if last == 3 else 1), v, kind)
    return held.select(*keys, "n", *flat, *[F.col(f"_{last}_{name}.bin").alias(name) for name in picks])


def median_of(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """The ordinary median (mean of the two middle values for an even count)."""
    mid = values_at(
        df, keys, value, {"_lo": lambda n: F.floor((n - 1) / 2), "_hi": lambda n: F.floor(n / 2)}
    )
    return mid.select(*keys, "n", ((F.col("_lo") + F.col("_hi")) / 2).alias(name))


def exclusive_quantile_of(
    df: DataFrame, keys: list[str], value: str, *, cut: int = 19, parts: int = 20, name: str = "quantile"
) -> DataFrame:
    """Exclusive-method quantile: cut `cut` of `parts` on n+1 positions, two neighbours weighted.

    Needs at least two values per key; fewer give null.
    """

    def j(n):
        return F.greatest(F.lit(1), F.least(n - 1, F.floor(F.lit(cut) * (n + 1) / parts)))

    got = values_at(df, keys, value, {"_a": lambda n: j(n) - 1, "_b": lambda n: j(n)})
    n = F.col("n")
    d = F.lit(cut) * (n + 1) - F.lit(parts) * j(n)
    mixed = (F.col("_a") * (F.lit(parts) - d) + F.col("_b") * d) / parts
    return got.select(*keys, "n", F.when(n >= 2, mixed).alias(name))


def global_rank(df: DataFrame, order: str, name: str = "rank0", *, ranges: int | None = None) -> DataFrame:
    """Dense 0-based position of each row in the order of a unique numeric column."""
    out = running(df, [], [F.col(order)], {name: ("sum", F.lit(1))}, range_on=F.col(order), ranges=ranges)
    return out.withColumn(name, F.col(name) - 1)
