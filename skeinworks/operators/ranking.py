"""Learning to rank: training sets, preference statistics, a pairwise ranker, ranking features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .filters import hash_number, require_columns
from .running import global_rank, range_count, running, running_within
from .vector import rank_top


def positive_interactions(orders: DataFrame, items: DataFrame, products: DataFrame, *, done: str) -> DataFrame:
    """Bought products per user. orders: order_id, user_id, status; items: order_id, product_id."""
    bought = orders.where(F.col("status") == done).select("order_id", "user_id")
    return (
        bought.join(items.select("order_id", "product_id"), "order_id")
        .join(products, "product_id")
        .select(
            F.col("user_id").cast("string").alias("query_group_id"),
            "product_id",
            "category",
            "retail_price",
            "cost",
            F.lit(1).alias("label"),
        )
    )


#: Products whose summed size is below so many bytes go to every task; of more, so many meet a part of so many users.
HELD_BYTES, BLOCK_PRODUCTS, PART_USERS = 128 << 20, 1 << 20, 1 << 18
#: Sampled pairs of the users of one part, which later steps sort or group in a task's memory.
PART_ROWS = 1 << 19


def sample_parts(users: DataFrame, products: DataFrame, *, one_in: int = 1000) -> int | None:
    """Parts by which users are dealt out for a sample whose products fit into every task; None if they do not."""
    row = F.lit(40)
    for name, kind in products.dtypes:
        row = row + (F.coalesce(F.octet_length(name), F.lit(0)) if kind == "string" else F.lit(8))
    n, held = products.agg(F.count(F.lit(1)), F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()
    if held > HELD_BYTES:
        return None
    return max(range_count(users), -(-users.count() * -(-n // one_in) // PART_ROWS))


def negative_samples(
    users: DataFrame,
    products: DataFrame,
    *,
    one_in: int = 1000,
    parts: int | None = None,
    strata_a_block: int | None = None,
    users_a_part: int | None = None,
) -> DataFrame:
    """A repeatable sample of the (user, product) pairs, each with probability 1 / one_in.

    Products are numbered and cut into strata of `one_in`; per user and stratum the md5 of both
    names one product. The work is that of the sample, not of the product of the two tables.
    With `parts` (of `sample_parts`) the strata are sent to every task and users are dealt out by their group, so the
    sample of a group lies in one task and what groups it later needs no shuffle.
    Without, a user is shuffled once for each block of `strata_a_block` strata and a stratum, as one row, once
    for each part of about `users_a_part` users; the sample itself is neither shuffled nor broadcast.
    """
    ranked = global_rank(products, "product_id", "_rank").withColumn("_rank", F.col("_rank").cast("long"))
    found = ("product_id", "category", "retail_price", "cost")
    # a column an array, so that those which nobody reads are not held
    strata = ranked.groupBy(F.floor(F.col("_rank") / one_in).cast("int").alias("_stratum")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sort_array(F.collect_list(F.struct("_rank", c))).getField(c).alias(f"_{c}") for c in found],
    )
    counted = products.count()
    asking = users.select(F.col("user_id").cast("string").alias("query_group_id"))
    if parts is not None:
        strata_ids = F.sequence(F.lit(0), F.lit(max(0, -(-counted // one_in) - 1)))
        asking = asking.repartition(parts, "query_group_id").select("query_group_id", F.explode(strata_ids).alias("_stratum"))
        met = asking.join(F.broadcast(strata), "_stratum")
    else:
        strata_a_block = strata_a_block or max(1, BLOCK_PRODUCTS // one_in)
        blocks, spread = max(1, -(-counted // (one_in * strata_a_block))), 16 * users.sparkSession.sparkContext.defaultParallelism
        user_parts = max(1, -(-users.count() // (users_a_part or PART_USERS)), 0 if users_a_part else -(-spread // blocks))
        asking = asking.select(
            "query_group_id",
            F.pmod(F.xxhash64("query_group_id"), F.lit(user_parts)).cast("int").alias("_part"),
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"),
        )
        held = strata.select(
            "*",
            F.floor(F.col("_stratum") / strata_a_block).cast("int").alias("_block"),
            F.explode(F.sequence(F.lit(0), F.lit(user_parts - 1))).alias("_part"),
        )
        # the size of either side is misjudged, as the rows of an explode are, so the kind of join is named; and as what
        # is shuffled is far less than what comes of it, the number of tasks is
        asking, held = (d.repartition(blocks * user_parts, "_block", "_part") for d in (asking, held))
        met = asking.join(held.hint("merge"), ["_block", "_part"])
    at = hash_number(F.concat_ws("-", "query_group_id", F.col("_stratum").cast("string"))) % one_in
    picks = met.select("query_group_id", "_n", *[f"_{c}" for c in found], F.explode_outer(F.array(at.cast("int"))).alias("_at"))
    return picks.where(F.col("_at") < F.col("_n")).select(
        "query_group_id", *[F.get(f"_{c}", F.col("_at")).alias(c) for c in found], F.lit(0).alias("label")
    )


def training_set(
    positives: DataFrame, negatives: DataFrame, *, exclude_positives: bool = False, limit: int | None = None, parts: int | None = None
) -> DataFrame:
    """Both labels together. A sampled pair may also be a positive unless excluded.

    `limit` takes the first rows of each label in (group, product) order, for a repeatable extract.
    With the `parts` of the sample, positives are dealt out as its users are, so a group lies in one task.
    """
    if parts is not None:
        positives = positives.repartition(parts, "query_group_id")
    if exclude_positives:
        # a row a group, built into a hash table of its part: the negatives stay where they are and are not sorted
        had = positives.groupBy("query_group_id").agg(F.collect_set("product_id").alias("_had"))
        met = negatives.join(had.hint("shuffle_hash"), "query_group_id", "left")
        again = F.coalesce(F.array_contains("_had", F.col("product_id")), F.lit(False))
        negatives = met.where(~again).select(*negatives.columns)
    if limit is not None:
        positives, negatives = (
            d.orderBy("query_group_id", "product_id").limit(limit) for d in (positives, negatives)
        )
    return positives.unionByName(negatives)


def _products_of(features: list[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(features)) for j in range(i, len(features))]


def preference_sums(df: DataFrame, group: str, label: str, features: list[str]) -> DataFrame:
    """Per group: number of preference pairs, summed feature differences and their products.

    A pair is a better- and a worse-labelled row of one group. Its sums follow from the count,
    sum and product sums of each label, so no pair is ever built, however large a group is.
    Differences do not change when a feature is shifted, so the means are taken off to keep the sums small. The
    rows are read once: the means of all rows follow from those of each group and label, and the products
    from their covariances. A null counts as the mean.
    """
    df = df.select(group, label, *[F.col(f).cast("double").alias(f) for f in features])
    aggs = [F.count(F.lit(1)).cast("double").alias("n")]
    for i, f in enumerate(features):
        aggs += [F.count(f).cast("double").alias(f"n{i}"), F.avg(f).alias(f"a{i}"), F.var_pop(f).alias(f"v{i}")]
    for i, j in _products_of(features):
        if i != j:
            x, y = F.col(features[i]), F.col(features[j])
            aggs += [F.regr_count(y, x).cast("double").alias(f"n{i}_{j}"), F.covar_pop(x, y).alias(f"v{i}_{j}")]
            aggs += [F.regr_avgx(y, x).alias(f"x{i}_{j}"), F.regr_avgy(y, x).alias(f"y{i}_{j}")]
    per = cut_lineage(df.groupBy(group, label).agg(*aggs))
    each = range(len(features))
    means = per.agg(F.struct(*[(F.sum(F.col(f"n{i}") * F.col(f"a{i}")) / F.nullif(F.sum(f"n{i}"), F.lit(0.0))).alias(f"c{i}") for i in each])).scalar()
    per = per.withColumn("_mean", means)

    def off(column: str, i: int) -> Column:
        return F.col(column) - F.col(f"_mean.c{i}")

    per = per.select(
        group,
        label,
        "n",
        *[(F.col(f"n{i}") * off(f"a{i}", i)).alias(f"s{i}") for i in each],
        *[
            (F.col(f"n{i}") * (F.col(f"v{i}") + off(f"a{i}", i) * off(f"a{i}", i))).alias(f"q{i}_{j}")
            if i == j
            else (F.col(f"n{i}_{j}") * (F.col(f"v{i}_{j}") + off(f"x{i}_{j}", i) * off(f"y{i}_{j}", j))).alias(f"q{i}_{j}")
            for i, j in _products_of(features)
        ],
    )
    good = per.select(group, *[F.col(c).alias(f"a_{c}") for c in per.columns if c != group])
    bad = per.select(group, *[F.col(c).alias(f"b_{c}") for c in per.columns if c != group])
    # a few labels per group meet here, not its rows
    met = good.join(bad, group).where(F.col(f"a_{label}") > F.col(f"b_{label}"))

    def a(c):
        return F.col(f"a_{c}")

    def b(c):
        return F.col(f"b_{c}")

    out = [F.sum(a("n") * b("n")).alias("pairs")]
    out += [F.sum(b("n") * a(f"s{i}") - a("n") * b(f"s{i}")).alias(f"d{i}") for i in range(len(features))]
    out += [
        F.sum(
            b("n") * a(f"q{i}_{j}")
            + a("n") * b(f"q{i}_{j}")
            - a(f"s{i}") * b(f"s{j}")
            - b(f"s{i}") * a(f"s{j}")
        ).alias(f"m{i}_{j}")
        for i, j in _products_of(features)
    ]
    return met.groupBy(group).agg(*out)


def fit_pairwise_ranker(df: DataFrame, group: str, label: str, features: list[str], *, ridge: float = 1.0) -> dict[str, float]:
    """Linear weights whose score differences best fit 1 on every preference pair (least squares).

    Exact over all pairs; one row of sums, as many as feature products, reaches the driver.
    """
    per = preference_sums(require_columns(df, [group, label, *features]), group, label, features)
    t = per.agg(*[F.sum(c).alias(c) for c in per.columns if c != group]).first()
    n = len(features)
    m = np.zeros((n, n))
    for i, j in _products_of(features):
        m[i, j] = m[j, i] = t[f"m{i}_{j}"] or 0.0
    d = np.array([t[f"d{i}"] or 0.0 for i in range(n)])
    w = np.linalg.solve(m + ridge * np.eye(n), d)
    return dict(zip(features, (float(x) for x in w)))


#: Winners that meet one copy of a losing row, and salts by which the label counts of a group go to its rows.
WINNERS_A_COPY, SALTS = 100_000, 16


def preference_differences(df: DataFrame, group: str, label: str, features: list[str], *, opponents: int = 32, seed: int = 0) -> DataFrame:
    """Feature differences d0, d1, ... (better minus worse row) of preference pairs, and what each pair counts for (`weight`).

    A row meets all rows of a worse label of its group when they are at most `opponents`, so small groups give all their
    pairs; of more it meets `opponents` neighbours in a random order drawn by `seed` (and the partitions of the input), each
    counting for its share, so that weighted sums estimate those over all pairs without bias. Rows with a null
    make no pairs. Labels are few per group; its rows may be any number, as order, counts and meetings are all spread.
    """
    y = F.col(label).cast("double").alias("y")
    d = df.select(F.col(group).alias("g"), y, *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]).dropna()
    d = cut_lineage(d.withColumn("u", F.rand(seed)))
    sizes = d.groupBy("g", "y").agg(F.count(F.lit(1)).alias("n"))
    groups = sizes.groupBy("g").agg(F.collect_list(F.struct("y", "n")).alias("sizes"))
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = running(d, ["g", "y"], [F.col("u")], {"place": ("sum", F.lit(1))}, range_on=F.col("u"))
    placed = placed.withColumn("salt", F.floor(F.col("u") * SALTS).cast("int")).join(salted, ["g", "salt"]).drop("salt")

    def copies(of: str, n: str) -> Column:
        better = F.expr(f"aggregate(filter(sizes, s -> s.y > {of}), 0L, (a, s) -> a + s.n)")
        return F.greatest(F.lit(1), F.ceil(better / (F.col(n) * WINNERS_A_COPY))).cast("int")

    win = placed.withColumn("w", F.explode(F.expr("filter(sizes, s -> s.y < y)"))).withColumns({"worse": F.col("w.y"), "n": F.col("w.n")})
    win = win.withColumn("copy", F.pmod(F.xxhash64("u", "place"), copies("worse", "n")).cast("int"))
    start = F.when(F.col("n") <= opponents, F.lit(0)).otherwise(F.pmod(F.xxhash64("place", "u", "worse"), F.col("n")))
    met = F.least(F.lit(opponents), F.col("n")).cast("int")
    win = win.withColumns({"start": start, "weight": F.col("n") / met, "step": F.explode(F.sequence(F.lit(0), met - 1))})
    win = win.select("g", "worse", "copy", ((F.col("start") + F.col("step")) % F.col("n") + 1).alias("place"), "weight", *[F.col(f"f{i}").alias(f"w{i}") for i in range(len(features))])
    lose = placed.withColumn("n", F.expr("filter(sizes, s -> s.y = y)[0].n"))
    lose = lose.withColumn("copy", F.explode(F.sequence(F.lit(0), copies("y", "n") - 1)))
    lose = lose.select("g", F.col("y").alias("worse"), "copy", "place", *[f"f{i}" for i in range(len(features))])
    pairs = win.join(lose, ["g", "worse", "copy", "place"])
    return pairs.select("weight", *[(F.col(f"w{i}") - F.col(f"f{i}")).alias(f"d{i}") for i in range(len(features))])


def fit_logistic_ranker(
    df: DataFrame, group: str, label: str, features: list[str], *, ridge: float = 1.0, opponents: int = 32, seed: int = 0, rounds: int = 25
) -> tuple[dict[str, float], list[float]]:
    """Weights that make log(1 + exp(-margin)) over the preference pairs least, and the loss after each round.

    Newton's method; a round is one pass over the pairs of `preference_differences` (all pairs of small groups, a
    sample of large ones), whose partial sums of slopes and curvatures are added up before they reach
    the driver as one row. Features are scaled to unit spread first, which is what `ridge` refers to. A step that
    makes the loss greater is halved. Without any pair all weights are zero.
    """
    n = len(features)
    require_columns(df, [group, label, *features])
    pairs = preference_differences(df, group, label, features, opponents=opponents, seed=seed)
    pairs = cut_lineage(pairs)
    spread = pairs.agg(*[F.sqrt(F.avg(F.col(f"d{i}") ** 2)).alias(f"s{i}") for i in range(n)]).first()
    scale = np.array([spread[f"s{i}"] or 1.0 for i in range(n)])
    x = [F.col(f"d{i}") / float(scale[i]) for i in range(n)]

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        margin = sum((c * float(v) for c, v in zip(x, w)), F.lit(0.0))
        d = pairs.select("weight", *[c.alias(f"x{i}") for i, c in enumerate(x)], margin.alias("m"))
        miss = 1 / (1 + F.exp("m"))
        # log(1 + exp(-m)) without overflow
        loss = F.greatest(-F.col("m"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("m")))
        sums = [F.sum(F.col("weight") * loss).alias("loss")]
        sums += [F.sum(F.col("weight") * miss * F.col(f"x{i}")).alias(f"g{i}") for i in range(n)]
        sums += [
            F.sum(F.col("weight") * miss * (1 - miss) * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}") for i, j in _products_of(features)
        ]
        t = d.agg(*sums).first()
        h = np.zeros((n, n))
        for i, j in _products_of(features):
            h[i, j] = h[j, i] = t[f"h{i}_{j}"] or 0.0
        g = np.array([t[f"g{i}"] or 0.0 for i in range(n)])
        return (t["loss"] or 0.0) + ridge / 2 * float(w @ w), g - ridge * w, h + ridge * np.eye(n)

    w = np.zeros(n)
    loss, slope, curve = at(w)
    losses = [loss]
    for _ in range(rounds):
        step = np.linalg.solve(curve, slope)
        if float(slope @ step) <= 1e-10 * max(1.0, loss):
            break
        for _ in range(20):
            found = at(w + step)
            if found[0] <= loss:
                break
            step = step / 2
        else:
            break
        w = w + step
        loss, slope, curve = found
        losses.append(loss)
    return dict(zip(features, (float(v) for v in w / scale))), losses


def scored_candidates(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """All input columns and the ranking score; missing features are an error that names them."""
    require_columns(df, list(weights))
    score = F.lit(0.0)
    for f, w in weights.items():
        score = score + F.col(f) * w
    return df.withColumn("ranking_score", score)


def ranked_candidates(df: DataFrame, weights: dict[str, float], by: str, tie: str, *, k: int | None = None) -> DataFrame:
    """Candidates with their place per query, best score first; all of them or the first k.

    The full ranking splits a query with very many candidates over many tasks (`running_within`).
    """
    scored = scored_candidates(df, weights)
    if k is not None:
        return rank_top(scored, by, "ranking_score", tie, k)
    order = [F.desc("ranking_score"), F.col(tie)]
    return running_within(scored, [by], order, {"rank": ("sum", F.lit(1))}, range_on=-F.col("ranking_score"))


def ranker_ndcg(df: DataFrame, by: str, label: str, score: str, tie: str, *, k: int = 10) -> DataFrame:
    """NDCG@k per query against the best possible order of all its judged rows."""
    got = rank_top(df.select(by, label, score, tie), by, score, tie, k)
    best = rank_top(df.select(by, label, tie), by, label, tie, k)
    gain = F.sum(F.col(label) / F.log2(F.col("rank") + 1.0))
    both = got.groupBy(by).agg(gain.alias("dcg")).join(best.groupBy(by).agg(gain.alias("ideal")), by)
    return both.select(by, F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal")).otherwise(0.0).alias("ndcg"))


def average_precision(df: DataFrame, by: str, label: str, score: str, tie: str) -> DataFrame:
    """Average precision and reciprocal rank per query over all its rows, best score first."""
    d = df.select(by, F.col(score).alias("_s"), F.col(tie).alias("_t"), (F.col(label) > 0).cast("int").alias("_hit"))
    order = [F.desc("_s"), F.col("_t")]
    placed = running_within(
        d, [by], order, {"_rank": ("sum", F.lit(1)), "_hits": ("sum", F.col("_hit"))}, range_on=-F.col("_s")
    )
    hit = F.col("_hit") == 1
    return placed.groupBy(by).agg(
        F.coalesce(F.avg(F.when(hit, F.col("_hits") / F.col("_rank"))), F.lit(0.0)).alias("average_precision"),
        F.coalesce(1 / F.min(F.when(hit, F.col("_rank"))), F.lit(0.0)).alias("reciprocal_rank"),
    )


def outside_training_range(train: DataFrame, infer: DataFrame, features: list[str]) -> DataFrame:
    """Per feature: training range and share of the new rows outside it."""
    limits = train.agg(
        F.struct(*[F.struct(F.min(f).alias("lo"), F.max(f).alias("hi")).alias(f) for f in features])
    ).scalar()
    d = infer.withColumn("_l", limits)
    cells = d.agg(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.first(F.col(f"_l.{f}.lo")).cast("double").alias("train_min"),
                F.first(F.col(f"_l.{f}.hi")).cast("double").alias("train_max"),
                F.avg(((F.col(f) < F.col(f"_l.{f}.lo")) | (F.col(f) > F.col(f"_l.{f}.hi"))).cast("int")).alias(
                    "outside_rate"
                ),
            ).alias(f)
            for f in features
        ]
    )
    return cells.select(F.inline_outer(F.array(*[F.col(f) for f in features])))


def standardised(df: DataFrame, features: list[str]) -> DataFrame:
    """Features as distance from the mean in standard deviations (0 when they do not vary)."""
    stats = df.agg(
        F.struct(*[F.struct(F.avg(f).alias("m"), F.stddev_samp(f).alias("s")).alias(f) for f in features])
    ).scalar()
    d = df.withColumn("_st", stats)
    scaled = [
        F.coalesce(F.try_divide(F.col(f) - F.col(f"_st.{f}.m"), F.col(f"_st.{f}.s")), F.lit(0.0)).alias(f"{f}_scaled")
        for f in features
    ]
    return d.select(*df.columns, *scaled)


def percentile_of(df: DataFrame, value: str, out: str) -> DataFrame:
    """Share of rows with a smaller value, from 0 to 1."""
    from .running import counted_values

    steps = counted_values(df, [], value, totals={"_size": "upto"})
    share = F.try_divide(F.col("upto") - F.col("n"), F.col("_size") - 1)
    at = steps.select(value, F.coalesce(share, F.lit(0.0)).alias(out))
    return df.join(at, value, "left")


def rank_features(df: DataFrame, *, category: str, price: str, cost: str, listed: str, as_of) -> DataFrame:
    """Margin ratio, price z-score within the category, age in days and the category's number."""
    per = df.groupBy(category).agg(F.avg(price).alias("_m"), F.stddev_samp(price).alias("_s"))
    names = Window.orderBy(category)  # one row per category
    per = per.withColumn("category_index", F.row_number().over(names) - 1)
    d = df.join(per, category)
    return d.select(
        *df.columns,
        "category_index",
        F.try_divide(F.col(price) - F.col(cost), F.col(price)).alias("margin_ratio"),
        F.coalesce(F.try_divide(F.col(price) - F.col("_m"), F.col("_s")), F.lit(0.0)).alias("price_zscore"),
        F.datediff(as_of, F.col(listed)).alias("freshness_days"),
    )


def one_hot(df: DataFrame, column: str, *, drop_last: bool = True) -> DataFrame:
    """The column as an indicator vector, most frequent value first."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    stages = [
        StringIndexer(inputCol=column, outputCol=f"{column}_index", handleInvalid="keep"),
        OneHotEncoder(inputCol=f"{column}_index", outputCol=f"{column}_vector", dropLast=drop_last),
    ]
    return Pipeline(stages=stages).fit(df).transform(df)


def two_stage(queries: DataFrame, docs: DataFrame, features: DataFrame, weights: dict[str, float], *, retrieve: int = 100, keep: int = 10) -> DataFrame:
    """Vector candidates, their features, and the ranker's best `keep` with both places."""
    from .vector import nearest

    found = nearest(queries, docs, retrieve).withColumnRenamed("rank", "retrieval_rank")
    full = found.join(features, "doc_id")
    return ranked_candidates(full, weights, "query_id", "doc_id", k=keep)
