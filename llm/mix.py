"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

Token quotas are handed out in equal blocks: first to sources, then to the shards of a source, each
time by the highest quotients weight / (2k + 1). A shard is the seeded order of its documents laid
end to end; the blocks it owes are taken from a seeded start onwards, round and round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import SPACED, kept, table

#: Most words of a block; so many blocks a cell (the documents of one source and shard) has on average;
#: most times that a document is repeated; weights, dealt to the sources in turn.
BLOCK, BLOCKS, REPEATS, WEIGHTS, SEED = 1024, 100, 3, (1, 2, 3), "mix"


def seats(parties: DataFrame, by: list[str], weight: str, total: Column, to_give: Column, most: Column, order: list) -> DataFrame:
    """`parties` with `quota`: `to_give` seats of each group `by`, at most `most` each, by highest quotients.

    What each party gets for certain follows from a divisor that is a little too large, so that at
    most two seats a party are left; only the quotients that can win those are made and ranked. Ties
    go to the first in `order`.
    """
    group = Window.partitionBy(*by)
    n = F.count(F.lit(1)).over(group)
    sure = F.least(F.col("_most"), F.floor(F.col(weight) * F.greatest(F.lit(0.0), F.col("_seats") - F.col("_n") / 2.0) / F.col("_total") + 0.5))
    p = parties.withColumns({"_n": n, "_total": total.cast("double"), "_seats": to_give.cast("long"), "_most": most.cast("long")})
    p = p.withColumn("_sure", F.when(F.col("_total") > 0, sure).otherwise(F.lit(0)).cast("long"))
    room = F.col("_most") > F.col("_sure")
    p = p.withColumns({"_left": F.greatest(F.lit(0), F.col("_seats") - F.sum("_sure").over(group)), "_open": F.sum(F.when(room, F.col(weight)).otherwise(0.0)).over(group)})
    share = F.when(F.col("_open") > 0, F.col(weight) / F.col("_open")).otherwise(0.0)
    reach = F.least(F.col("_most") - F.col("_sure"), F.col("_left"), F.ceil(share * (F.col("_left") + F.col("_n"))) + 2)
    tries = p.withColumn("_try", F.explode_outer(F.when(reach > 0, F.sequence(F.lit(0).cast("long"), reach - 1))))
    quotient = F.col(weight) / (2.0 * (F.col("_sure") + F.col("_try")) + 1.0)
    tries = tries.withColumn("_rank", F.row_number().over(group.orderBy(quotient.desc_nulls_last(), *order, F.col("_try"))))
    won = (F.col("_try").isNotNull() & (F.col("_rank") <= F.col("_left"))).cast("long")
    return tries.groupBy(*parties.columns).agg((F.first("_sure") + F.sum(won)).alias("quota"))


def targets(sources: DataFrame, size: str, order: list, weights: tuple = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """`sources` with `target`: shares of all sizes by weight, none above `repeats` times its size.

    With the sources in order of cap over weight, those whose cap binds come first; each of them is
    found by what would be left if all behind it had its ratio. This gives the limit of resharing
    again and again.
    """
    everything = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), ((F.row_number().over(Window.partitionBy().orderBy(*order)) - 1) % len(weights) + 1).cast("int"))
    s = sources.withColumn("_w", w).withColumn("_cap", F.col(size) * repeats).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    up = Window.partitionBy().orderBy("_ratio", *order)
    s = s.withColumns({
        "_before": F.coalesce(F.sum("_cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")),
        "_behind": F.sum("_w").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        "_all": F.sum(size).over(everything),
    })
    s = s.withColumn("_binds", F.col("_before") + F.col("_ratio") * F.col("_behind") <= F.col("_all"))
    rest = F.col("_all") - F.coalesce(F.sum(F.when(F.col("_binds"), F.col("_cap"))).over(everything), F.lit(0).cast("long"))
    level = rest / F.sum(F.when(~F.col("_binds"), F.col("_w"))).over(everything)
    s = s.withColumn("target", F.when(F.col("_binds"), F.col("_cap").cast("double")).otherwise(level * F.col("_w")))
    return s.drop("_w", "_cap", "_ratio", "_before", "_behind", "_binds")


def _number(*parts) -> Column:
    """A seeded number of 32 bits."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def mixed(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", block: int | None = None, repeats: int = REPEATS, weights: tuple = WEIGHTS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document.

    size: words of the text; a null or empty text has none and takes none. A null source is a source
    of its own, the last one. Documents are dealt by a hash of their id to as many shards as the
    root of their number, so neither a hot source nor a long table makes a large task; per source
    and shard only one row is ranked. A block is a hundredth of the mean cell if no size is given, and
    1,024 words at most; a source whose target is its cap takes all its cells can give. Repeated rows are documents of their own; which of two equal
    rows takes more is open, how much they take together is not. No rows give no rows. Other columns
    are left out.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    sized = kept(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("_source"), key.alias("_key"), F.md5(F.concat_ws("|", F.lit(seed), name).cast("binary")).alias("_order"), F.coalesce(F.regexp_count(F.col(text), F.lit(SPACED)), F.lit(0)).cast("long").alias("size")), "mix-sizes")
    n = sized.count()
    shards = max(1, round(n**0.5))
    sized = sized.withColumn("_shard", F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") % shards)
    parts = kept(sized.groupBy("_key", "_shard").agg(F.min("_source").alias("_source"), F.sum("size").alias("_size")), "mix-cells")
    if block is None:
        cells = parts.agg(F.sum("_size").alias("all"), F.count(F.lit(1)).alias("n")).first()
        block = max(1, min(BLOCK, (cells["all"] or 0) // (BLOCKS * max(cells.n, 1))))
    sources = parts.groupBy("_key").agg(F.min("_source").alias("_source"), F.sum("_size").alias("source_size"))
    order = [F.col("_source").asc_nulls_last()]
    sources = targets(sources, "source_size", order, weights, repeats)
    sources = seats(sources, [], "target", F.col("_all"), F.round(F.col("_all") / block), F.ceil(F.col("source_size") * repeats / block), order)
    binds = F.col("target") >= F.col("source_size") * repeats
    sources = sources.select("_key", "source_size", "target", F.when(binds, F.lit(1 << 40)).otherwise(F.col("quota")).alias("_blocks"))
    parts = parts.drop("_source").join(sources, "_key")
    parts = seats(parts, ["_key"], "_size", F.col("source_size"), F.col("_blocks"), F.ceil(F.col("_size") * repeats / block), [F.col("_shard")])
    owed = F.least(F.col("quota") * block, F.col("_size") * repeats)
    start = F.when(F.col("_size") > 0, _number(F.lit(seed), F.col("_key"), F.col("_shard").cast("string")) % F.col("_size"))
    parts = parts.select("_key", "_shard", "source_size", "target", "_size", owed.alias("_owed"), F.coalesce(start, F.lit(0)).cast("long").alias("_start"))
    line = Window.partitionBy("_key", "_shard").orderBy("_order", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = sized.withColumn("_end", F.sum("size").over(line)).join(parts, ["_key", "_shard"])
    whole, arc = F.floor(F.col("_owed") / F.col("_size")), F.col("_owed") % F.col("_size")

    def within(shift: Column) -> Column:
        a, b = F.col("_end") - F.col("size") + shift, F.col("_end") + shift
        return F.greatest(F.lit(0).cast("long"), F.least(b, F.col("_start") + arc) - F.greatest(a, F.col("_start")))

    taken = F.when(F.col("_size") > 0, whole * F.col("size") + within(F.lit(0)) + within(F.col("_size"))).otherwise(F.lit(0))
    return laid.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


_SEATS = """
{name}_a as (select *, count(*) over ({part}) n from {src}),
{name}_b as (select *, case when total > 0 then cast(least(most, floor(weight * greatest(0.0, seats - n / 2.0) / total + 0.5)) as bigint) else 0 end sure from {name}_a),
{name}_c as (select *, greatest(0, seats - sum(sure) over ({part})) rest, sum(case when most > sure then weight else 0 end) over ({part}) unmet from {name}_b),
{name}_d as (select *, cast(least(most - sure, rest, ceil(case when unmet > 0 then weight / unmet else 0 end * (rest + n)) + 2) as bigint) reach from {name}_c),
{name}_e as (select *, unnest(case when reach > 0 then range(0, reach) else [null] end) t from {name}_d),
{name}_f as (select *, row_number() over ({part} order by weight / (2.0 * (sure + t) + 1.0) desc nulls last, {order}, t) r from {name}_e),
{name} as (select {keep}, any_value(sure) + sum(case when t is not null and r <= rest then 1 else 0 end) quota from {name}_f group by {keep})
"""


def _seats_sql(name: str, src: str, part: str, order: str, keep: str) -> str:
    return _SEATS.format(name=name, src=src, part=part, order=order, keep=keep)


ORACLE = (
    r"""
with d as (select doc_id, source, coalesce('=' || source, '') k, md5('mix|' || coalesce(cast(doc_id as varchar), '')) o,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size from documents),
z as (select *, ('0x' || substr(o, 1, 8))::ubigint::bigint % (select greatest(1, round(sqrt(count(*)))::bigint) from d) shard from d),
p as (select k, shard, min(source) source, sum(size)::bigint part from z group by all),
s0 as (select k, min(source) source, sum(part)::bigint source_size from p group by k),
s1 as (select *, [1, 2, 3][(row_number() over (order by source nulls last) - 1) % 3 + 1] w, source_size * 3 cap, (sum(source_size) over ())::bigint total from s0),
s2 as (select *, cap / w ratio, coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0)::bigint before,
              (sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following))::bigint behind from s1),
s3 as (select *, before + ratio * behind <= total binds from s2),
s4 as (select k, source, source_size, total, case when binds then cap::double
              else ((total - coalesce(sum(case when binds then cap end) over (), 0)::bigint) / (sum(case when not binds then w end) over ())::bigint) * w end target from s3),
b as (select greatest(1, least(1024, sum(part) // (100 * greatest(count(*), 1))))::bigint b from p),
s5 as (select k, source, source_size, target, target weight, total::double total, round(total / (select b from b))::bigint seats, ceil(source_size * 3 / (select b from b))::bigint most from s4),
"""
    + _seats_sql("sq", "s5", "", "source nulls last", "k, source_size, target")
    + """,
p1 as (select p.k, shard, part, source_size, target, part::double weight, source_size::double total, (case when target >= source_size * 3 then 1099511627776 else quota end)::bigint seats, ceil(part * 3 / (select b from b))::bigint most from p join sq using (k)),
"""
    + _seats_sql("pq", "p1", "partition by k", "shard", "k, shard, part, source_size, target")
    + """,
own as (select k, shard, part, source_size, target, least(quota * (select b from b), part * 3)::bigint owed,
               case when part > 0 then ('0x' || substr(md5('mix|' || k || '|' || shard), 1, 8))::ubigint::bigint % part else 0 end first from pq),
laid as (select z.*, (sum(size) over (partition by k, shard order by o, size rows between unbounded preceding and current row))::bigint stop from z)
select doc_id, size, source_size, target,
       (case when part > 0 then (owed // part) * size + greatest(0, least(stop, first + owed % part) - greatest(stop - size, first))
             + greatest(0, least(stop + part, first + owed % part) - greatest(stop - size + part, first)) else 0 end)::bigint taken
from laid join own using (k, shard)
"""
)

QUERIES = {"op10_mix": op10_mix}
ORACLES = {"op10_mix": ORACLE}
