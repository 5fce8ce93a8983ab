"""Queries on ranking, classification and forecasting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import classify as K, ranking as R, scoring as S, series as N
from ..session import cut_lineage
from . import views as V
from .registry import documents, query, table


def _r(df, digits=6, *names):
    return df.select(*[F.round(c, digits).alias(c) if c in names else c for c in df.columns])


def positives(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("status")
    )
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
    return R.positive_interactions(o, li, V.products(spark, sf), done="F")


def negatives(spark, sf, parts=None):
    """The sample; its parts are found unless they are given."""
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    products = V.products(spark, sf)
    return R.negative_samples(users, products, parts=parts or R.sample_parts(users, products))


def grouped(spark, sf, **options):
    """The training set with a group's rows in one task, if the products fit into one."""
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    parts = R.sample_parts(users, V.products(spark, sf))
    return R.training_set(positives(spark, sf), negatives(spark, sf, parts), parts=parts, **options)


V.SQL["ltr_neg"] = """
  SELECT u.g AS query_group_id, p.product_id, p.category, p.retail_price, p.cost, 0 AS label
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS g, unnest(range(0, CAST(ceil((SELECT count(*) FROM part) / 1000) AS BIGINT))) AS s FROM customer) u
  JOIN (SELECT *, row_number() OVER (ORDER BY product_id) - 1 AS r FROM products) p
    ON p.r = u.s * 1000 + ('0x' || substr(md5(u.g || '-' || CAST(u.s AS VARCHAR)), 1, 8))::BIGINT % 1000"""
_LTR = V.with_views("ltr_pos", "products", "ltr_neg")
_COLS = "query_group_id, product_id, category, round(retail_price, 6) AS retail_price, round(cost, 6) AS cost, label"
_ALL = f"{_LTR}, ltr AS (SELECT query_group_id, product_id, category, retail_price, cost, label FROM ltr_pos UNION ALL SELECT * FROM ltr_neg)"


@query("ltr_positives", f"{_LTR} SELECT {_COLS} FROM ltr_pos")
def _(spark, sf):
    return _r(positives(spark, sf), 6, "retail_price", "cost")


@query("ltr_negatives", f"{_LTR} SELECT {_COLS} FROM ltr_neg")
def _(spark, sf):
    return _r(negatives(spark, sf), 6, "retail_price", "cost")


@query("ltr_training_set", f"{_ALL} SELECT {_COLS} FROM ltr")
def _(spark, sf):
    return _r(R.training_set(positives(spark, sf), negatives(spark, sf)), 6, "retail_price", "cost")


@query(
    "ltr_training_set_strict",
    f"""{_LTR} SELECT {_COLS} FROM ltr_pos UNION ALL SELECT {_COLS} FROM ltr_neg n
    WHERE NOT EXISTS (SELECT 1 FROM ltr_pos p WHERE p.query_group_id = n.query_group_id AND p.product_id = n.product_id)""",
)
def _(spark, sf):
    d = grouped(spark, sf, exclude_positives=True)
    return _r(d, 6, "retail_price", "cost")


@query(
    "ltr_limited_extract",
    f"""{_LTR}, a AS (SELECT * FROM ltr_pos ORDER BY query_group_id, product_id LIMIT 5000), b AS (SELECT * FROM ltr_neg ORDER BY query_group_id, product_id LIMIT 5000)
    SELECT query_group_id, product_id, label FROM a UNION ALL SELECT query_group_id, product_id, label FROM b""",
)
def _(spark, sf):
    d = R.training_set(positives(spark, sf), negatives(spark, sf), limit=5000)
    return d.select("query_group_id", "product_id", "label")


@query("ltr_group_sizes", f"{_ALL} SELECT query_group_id, count(*) AS size FROM ltr GROUP BY 1")
def _(spark, sf):
    return S.group_sizes(grouped(spark, sf), "query_group_id")


_PAIRS = f"""{_ALL}, pr AS (SELECT a.query_group_id, a.retail_price - b.retail_price AS d0, a.cost - b.cost AS d1 FROM ltr a JOIN ltr b
   ON a.query_group_id = b.query_group_id AND a.label > b.label)"""


@query(
    "ltr_preference_pairs",
    f"""{_PAIRS} SELECT query_group_id, count(*)::DOUBLE AS pairs, round(sum(d0), 3) + 0.0 AS d0, round(sum(d1), 3) + 0.0 AS d1, round(sum(d0 * d0), 6) AS m0_0,
      round(sum(d0 * d1), 6) + 0.0 AS m0_1, round(sum(d1 * d1), 6) AS m1_1 FROM pr GROUP BY 1""",
)
def _(spark, sf):
    d = grouped(spark, sf)
    p = R.preference_sums(d, "query_group_id", "label", ["retail_price", "cost"])
    return _r(_r(p, 3, "d0", "d1"), 6, "m0_0", "m0_1", "m1_1")


_WEIGHTS = f"""{_PAIRS}, s AS (SELECT sum(d0) AS d0, sum(d1) AS d1, sum(d0 * d0) + 1 AS a, sum(d0 * d1) AS b, sum(d1 * d1) + 1 AS c FROM pr),
   w AS (SELECT (d0 * c - d1 * b) / (a * c - b * b) AS w0, (a * d1 - b * d0) / (a * c - b * b) AS w1 FROM s)"""


def _ranker(spark, sf):
    d = grouped(spark, sf)
    return d, R.fit_pairwise_ranker(d, "query_group_id", "label", ["retail_price", "cost"])


@query(
    "ltr_pairwise_weights",
    f"{_WEIGHTS} SELECT 'retail_price' AS feature, round(w0, 8) AS weight FROM w UNION ALL SELECT 'cost', round(w1, 8) FROM w",
)
def _(spark, sf):
    _, w = _ranker(spark, sf)
    return spark.createDataFrame([(k, round(v, 8)) for k, v in w.items()], "feature string, weight double")


@query("ltr_logistic_weights")
def _(spark, sf):
    """Weights of the logistic pairwise objective, and its loss at zero weights and at these."""
    d = grouped(spark, sf)
    w, losses = R.fit_logistic_ranker(d, "query_group_id", "label", ["retail_price", "cost"])
    rows = [(k, v, losses[0], losses[-1]) for k, v in w.items()]
    return spark.createDataFrame(rows, "feature string, weight double, first_loss double, last_loss double")


@query(
    "ltr_ranked_candidates",
    f"""{_WEIGHTS}, sc AS (SELECT DISTINCT query_group_id, product_id, retail_price, cost, round(w0 * retail_price + w1 * cost, 7) AS s FROM ltr, w),
     r AS (SELECT query_group_id, product_id, s, row_number() OVER (PARTITION BY query_group_id ORDER BY s DESC, product_id) AS rank FROM sc)
    SELECT query_group_id, product_id, s AS ranking_score, rank FROM r""",
)
def _(spark, sf):
    d, w = _ranker(spark, sf)
    items = d.select("query_group_id", "product_id", "retail_price", "cost").distinct()
    score = R.scored_candidates(items, w).withColumn("s", F.round("ranking_score", 7))
    out = R.ranked_candidates(score.drop("ranking_score"), {"s": 1.0}, "query_group_id", "product_id")
    return out.select("query_group_id", "product_id", F.col("s").alias("ranking_score"), "rank")


_NDCG = f"""{_ALL}, j AS (SELECT query_group_id, product_id, max(label) AS label, max(retail_price) AS s FROM ltr GROUP BY ALL)"""


def _judged(spark, sf):
    d = grouped(spark, sf)
    return d.groupBy("query_group_id", "product_id").agg(F.max("label").alias("label"), F.max("retail_price").alias("s"))


@query(
    "ltr_ndcg",
    f"""{_NDCG}, r AS (SELECT *, row_number() OVER (PARTITION BY query_group_id ORDER BY s DESC, product_id) AS a,
       row_number() OVER (PARTITION BY query_group_id ORDER BY label DESC, product_id) AS b FROM j),
     g AS (SELECT query_group_id, sum(label / log2(a + 1)) FILTER (a <= 10) AS dcg, sum(label / log2(b + 1)) FILTER (b <= 10) AS ideal FROM r GROUP BY 1)
    SELECT query_group_id, round(CASE WHEN ideal > 0 THEN dcg / ideal ELSE 0 END, 6) AS ndcg FROM g""",
)
def _(spark, sf):
    return _r(R.ranker_ndcg(_judged(spark, sf), "query_group_id", "label", "s", "product_id"), 6, "ndcg")


@query(
    "ltr_average_precision",
    f"""{_NDCG}, r AS (SELECT *, row_number() OVER w AS rk, sum(label) OVER w AS hits FROM j WINDOW w AS (PARTITION BY query_group_id ORDER BY s DESC, product_id))
    SELECT query_group_id, round(coalesce(avg(hits / rk) FILTER (label > 0), 0), 6) AS average_precision,
      round(coalesce(1 / min(rk) FILTER (label > 0), 0), 6) AS reciprocal_rank FROM r GROUP BY 1""",
)
def _(spark, sf):
    d = R.average_precision(_judged(spark, sf), "query_group_id", "label", "s", "product_id")
    return _r(d, 6, "average_precision", "reciprocal_rank")


_TWO = (
    V.with_views("doc_vec", "text_queries", "products")
    + """, p AS (SELECT q.query_id, d.doc_id, round(list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 10) AS s FROM text_queries q, doc_vec d),
   t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rr FROM p),
   c AS (SELECT t.*, 0.01::DOUBLE * f.retail_price - 0.015::DOUBLE * f.cost AS rs, f.retail_price - f.cost AS m FROM t JOIN products f ON f.product_id = t.doc_id WHERE rr <= 100),
   r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rs DESC, doc_id) AS rank FROM c)"""
)
_TWO_W = {"retail_price": 0.01, "cost": -0.015}


def _two(spark, sf, keep):
    d = V.doc_vec(spark, sf).withColumnRenamed("embedding", "d_vec")
    q = V.text_queries(spark, sf).withColumnRenamed("embedding", "q_vec")
    f = V.products(spark, sf).withColumnRenamed("product_id", "doc_id")
    return R.two_stage(q, d, f, _TWO_W, keep=keep)


@query("two_stage_ranking", _TWO + "SELECT query_id, doc_id, rr AS retrieval_rank, round(rs, 6) AS ranking_score, rank FROM r WHERE rank <= 10")
def _(spark, sf):
    return _r(_two(spark, sf, 10), 6, "ranking_score").select("query_id", "doc_id", "retrieval_rank", "ranking_score", "rank")


@query(
    "two_stage_margin_uplift",
    _TWO
    + """, u AS (SELECT query_id, coalesce(sum(m) FILTER (rr <= 3), 0) AS b, coalesce(sum(m) FILTER (rank <= 3), 0) AS a FROM r WHERE rr <= 3 OR rank <= 3 GROUP BY 1)
    SELECT query_id, round(b, 4) AS margin_before, round(a, 4) AS margin_after, round(CASE WHEN b <> 0 THEN (a - b) / b * 100 END, 4) AS uplift_percent FROM u""",
)
def _(spark, sf):
    d = _two(spark, sf, 100).withColumn("margin", F.col("retail_price") - F.col("cost"))
    u = S.margin_uplift(d, "query_id", before="retrieval_rank", after="rank", margin="margin")
    return _r(u, 4, "margin_before", "margin_after", "uplift_percent")


@query(
    "ltr_outside_range",
    f"""{_LTR}, l AS (SELECT min(retail_price) AS a, max(retail_price) AS b, min(cost) AS c, max(cost) AS d FROM ltr_neg)
    SELECT 'retail_price' AS feature, round(a, 6) AS train_min, round(b, 6) AS train_max, round(avg((retail_price < a OR retail_price > b)::INT), 6) AS outside_rate FROM products, l GROUP BY ALL
    UNION ALL SELECT 'cost', round(c, 6), round(d, 6), round(avg((cost < c OR cost > d)::INT), 6) FROM products, l GROUP BY ALL""",
)
def _(spark, sf):
    d = R.outside_training_range(negatives(spark, sf), V.products(spark, sf), ["retail_price", "cost"])
    return _r(d, 6, "train_min", "train_max", "outside_rate")


@query(
    "ltr_scaled_features",
    V.with_views("products")
    + """SELECT product_id, round((retail_price - (SELECT avg(retail_price) FROM products)) / (SELECT stddev_samp(retail_price) FROM products), 6) AS retail_price_scaled,
      round(percent_rank() OVER (ORDER BY retail_price), 6) AS price_percentile FROM products""",
)
def _(spark, sf):
    d = R.percentile_of(R.standardised(V.products(spark, sf), ["retail_price"]), "retail_price", "price_percentile")
    return _r(d, 6, "retail_price_scaled", "price_percentile").select("product_id", "retail_price_scaled", "price_percentile")


@query(
    "ltr_rank_features",
    """WITH p AS (SELECT l_orderkey, l_linenumber, p_type, p_retailprice, 0.5::DOUBLE * p_retailprice + p_size AS cost, l_shipdate FROM lineitem JOIN part ON p_partkey = l_partkey),
     c AS (SELECT p_type, avg(p_retailprice) AS m, stddev_samp(p_retailprice) AS s, row_number() OVER (ORDER BY p_type) - 1 AS category_index FROM p GROUP BY 1)
    SELECT l_orderkey, l_linenumber, category_index, round((p_retailprice - cost) / p_retailprice, 6) AS margin_ratio, round((p_retailprice - m) / s, 6) AS price_zscore,
      date_diff('day', CAST(l_shipdate AS DATE), DATE '2002-01-01') AS freshness_days FROM p JOIN c USING (p_type)""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    p = table(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice", (0.5 * F.col("p_retailprice") + F.col("p_size")).alias("cost"))
    d = li.join(p, li.l_partkey == p.p_partkey)
    f = R.rank_features(d, category="p_type", price="p_retailprice", cost="cost", listed="l_shipdate", as_of=F.lit("2002-01-01").cast("date"))
    return _r(f, 6, "margin_ratio", "price_zscore").select(
        "l_orderkey", "l_linenumber", "category_index", "margin_ratio", "price_zscore", "freshness_days"
    )


@query(
    "ltr_one_hot_category",
    """SELECT p_type, count(*) AS products, 1.0::DOUBLE AS ones FROM part GROUP BY 1""",
)
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    d = R.one_hot(table(spark, sf, "part").select("p_type"), "p_type", drop_last=False)
    ones = F.aggregate(vector_to_array("p_type_vector"), F.lit(0.0), lambda s, x: s + x)
    return d.groupBy("p_type").agg(F.count(F.lit(1)).alias("products"), F.avg(ones).alias("ones"))


# ---- classification -------------------------------------------------------------------

V.SQL["credit"] = """
  SELECT l.doc_id, l.quality, l.toxic, d.lang, length(d.text) AS chars, length(d.text) - length(replace(d.text, ' ', '')) AS blanks,
    round(1 / (1 + exp((length(d.text) - 1500) / CAST(800 AS DOUBLE))), 6) AS score
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id"""


def credit(spark, sf):
    d = documents(spark, sf).select("doc_id", "text", "lang")
    n = F.length("text")
    return table(spark, sf, "labels").join(d, "doc_id").select(
        "doc_id",
        "quality",
        "toxic",
        "lang",
        n.alias("chars"),
        (n - F.length(F.replace("text", F.lit(" "), F.lit("")))).alias("blanks"),
        F.round(1 / (1 + F.exp((n - 1500) / F.lit(800.0))), 6).alias("score"),
        T.avg_word_length("text").alias("word_length"),
        T.word_count("text").alias("words"),
        T.token_estimate("text").alias("tokens"),
        T.has_number("text").cast("int").alias("numbers"),
    )


_CR = V.with_views("credit")


@query(
    "classifier_stratified_split",
    _CR
    + """, h AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY ('0x' || substr(md5('42|' || CAST(doc_id AS VARCHAR)), 1, 13))::BIGINT) AS r,
       count(*) OVER (PARTITION BY quality) AS n FROM credit)
    SELECT doc_id, quality, r <= floor(n * 0.2::DOUBLE) AS is_test FROM h""",
)
def _(spark, sf):
    return K.stratified_split(credit(spark, sf), "quality", "doc_id").select("doc_id", "quality", "is_test")


_PRED = ", p AS (SELECT *, (score >= 0.5)::INT AS predicted FROM credit)"


def _predicted(spark, sf):
    return credit(spark, sf).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query(
    "classifier_scores",
    _CR
    + _PRED
    + """, c AS (SELECT lang, count(*) AS n, count(*) FILTER (quality = 1 AND predicted = 1) AS tp, count(*) FILTER (quality = 0 AND predicted = 1) AS fp,
       count(*) FILTER (quality = 1 AND predicted = 0) AS fn, count(*) FILTER (quality = predicted) AS r FROM p GROUP BY 1)
    SELECT lang, n, round(r / n, 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
      round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM c""",
)
def _(spark, sf):
    return _r(K.binary_scores(_predicted(spark, sf), "quality", "predicted", by=["lang"]), 6, "accuracy", "precision", "recall", "f1")


@query(
    "classifier_confusion",
    _CR + _PRED + " SELECT quality AS actual, count(*) FILTER (predicted = 0) AS predicted_0, count(*) FILTER (predicted = 1) AS predicted_1 FROM p GROUP BY 1",
)
def _(spark, sf):
    return K.confusion(_predicted(spark, sf), "quality", "predicted")


_ROC = (
    _CR
    + """, g AS (SELECT score, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg FROM credit GROUP BY 1),
   r AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g)"""
)


@query("classifier_roc", _ROC + " SELECT score AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, round(tp / p, 6) AS recall, round(fp / n, 6) AS fpr FROM r")
def _(spark, sf):
    d = K.roc_points(credit(spark, sf), "quality", "score")
    return _r(d, 6, "recall", "fpr").select("threshold", "tp", "fp", "recall", "fpr")


@query(
    "classifier_gate",
    _ROC
    + """, a AS (SELECT sum(neg * (tp - pos / 2)) / (max(p) * max(n)) AS roc, sum(pos * tp / (tp + fp)) / max(p) AS prc FROM r)
    SELECT round(roc, 6) AS "auRoc", round(prc, 6) AS "auPrc", CASE WHEN roc >= 0.5 AND prc >= 0.3 THEN 'true' ELSE 'false' END AS deploy FROM a""",
)
def _(spark, sf):
    a = K.curve_areas(K.roc_points(credit(spark, sf), "quality", "score"))
    return _r(K.deployment_decision(a, {"auRoc": 0.5, "auPrc": 0.3}), 6, "auRoc", "auPrc")


_NUM = ["chars", "blanks", "word_length", "words", "tokens", "numbers"]


@query("classifier_boosted_trees")
def _(spark, sf):
    d = K.assembled(K.stratified_split(credit(spark, sf), "quality", "doc_id"), _NUM, ["lang"])
    model = K.boosted_trees(d.where(~F.col("is_test")), "quality")
    scored = K.with_probability(model, d.where("is_test"))
    return K.binary_scores(scored.withColumn("predicted", F.col("prediction").cast("int")), "quality", "predicted")


@query("classifier_tuning")
def _(spark, sf):
    d = cut_lineage(K.assembled(credit(spark, sf), _NUM, ["lang"]).select("quality", "features"))  # read by every trial
    _, trials = K.tuned_classifier(d, "quality", trials=6, parallel=3)
    return trials


# ---- series ---------------------------------------------------------------------------

V.SQL["demand"] = """
  SELECT p_brand AS item_id, CAST(l_shipdate AS DATE) AS day, l_quantity AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey"""


def demand(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_brand").alias("item_id"), F.col("l_shipdate").cast("date").alias("day"), F.col("l_quantity").alias("quantity")
    )


_SER = (
    V.with_views("demand")
    + """, dd AS (SELECT item_id, day, sum(quantity) AS y FROM demand GROUP BY ALL),
   gp AS (SELECT item_id, date_diff('day', lag(day) OVER (PARTITION BY item_id ORDER BY day), day) AS step FROM dd),
   st AS (SELECT item_id, step FROM (SELECT item_id, step, count(*) AS c FROM gp WHERE step IS NOT NULL GROUP BY ALL)
       QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY c DESC, step) = 1),
   sp AS (SELECT item_id, min(day) AS a, max(day) AS b, any_value(step) AS step FROM dd JOIN st USING (item_id) GROUP BY 1),
   bk AS (SELECT dd.item_id, date_diff('day', a, day) // step AS t, sum(y) AS y FROM dd JOIN sp USING (item_id) GROUP BY ALL),
   gr AS (SELECT item_id, step, unnest(range(0, date_diff('day', a, b) // step + 1)) AS t, a FROM sp),
   rg AS (SELECT gr.item_id, gr.step, gr.t, gr.a + CAST(gr.t * gr.step AS INT) AS day, coalesce(bk.y, 0) AS y FROM gr LEFT JOIN bk ON bk.item_id = gr.item_id AND bk.t = gr.t),
   ln AS (SELECT item_id, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept, count(*) AS n FROM rg GROUP BY 1),
   tr AS (SELECT rg.*, slope, intercept, n, intercept + slope * t AS trend, t % 7 AS phase FROM rg JOIN ln USING (item_id)),
   ph AS (SELECT item_id, phase, avg(y - trend) AS seasonal FROM tr GROUP BY ALL),
   rs AS (SELECT tr.*, seasonal, y - trend - seasonal AS rest FROM tr JOIN ph USING (item_id, phase)),
   pv AS (SELECT *, lag(rest) OVER (PARTITION BY item_id ORDER BY t) AS prev FROM rs),
   au AS (SELECT item_id, sum(rest * prev) / sum(prev * prev) AS phi FROM pv GROUP BY 1),
   ft AS (SELECT pv.*, phi, trend + seasonal + phi * coalesce(prev, 0) AS fitted, y - (trend + seasonal + phi * coalesce(prev, 0)) AS error FROM pv JOIN au USING (item_id)),
   sg AS (SELECT item_id, stddev_pop(error) AS sigma FROM ft GROUP BY 1)"""
)


def parts(spark, sf):
    return N.decomposed(N.regular_series(demand(spark, sf), "item_id", "day", "quantity"), "item_id")


@query("series_step", _SER + " SELECT item_id, step::INT AS step FROM st")
def _(spark, sf):
    return N.series_step(demand(spark, sf), "item_id", "day")


@query(
    "series_decomposition",
    _SER
    + """ SELECT item_id, CAST(day AS VARCHAR) AS day, t, round(y, 4) AS y, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal, round(fitted, 4) AS fitted FROM ft""",
)
def _(spark, sf):
    d = parts(spark, sf).withColumn("day", F.col("day").cast("string"))
    return _r(d, 4, "y", "trend", "seasonal", "fitted").select("item_id", "day", "t", "y", "trend", "seasonal", "fitted")


_PROB = """1 - (q * (0.254829592::DOUBLE + q * (-0.284496736::DOUBLE + q * (1.421413741::DOUBLE + q * (-1.453152027::DOUBLE + q * 1.061405429::DOUBLE)))) * exp(-x * x))"""
_ANOM = _SER + f""", zz AS (SELECT ft.*, abs(error / sigma) / sqrt(2) AS x FROM ft JOIN sg USING (item_id)),
   zq AS (SELECT *, 1 / (1 + 0.3275911::DOUBLE * x) AS q FROM zz), an AS (SELECT *, {_PROB} AS p FROM zq)"""


@query("series_anomalies", _ANOM + " SELECT item_id, CAST(day AS VARCHAR) AS day, round(y, 4) AS y, round(p, 6) AS anomaly_probability FROM an WHERE p > 0.95")
def _(spark, sf):
    d = N.anomalies(parts(spark, sf), "item_id").withColumn("day", F.col("day").cast("string"))
    return _r(_r(d, 4, "y"), 6, "anomaly_probability").select("item_id", "day", "y", "anomaly_probability")


@query(
    "series_forecast",
    _SER
    + """, md AS (SELECT item_id, any_value(slope) AS slope, any_value(intercept) AS intercept, any_value(phi) AS phi, any_value(step) AS step, max(n) AS n, max(day) AS ld, max_by(rest, t) AS lr
        FROM ft GROUP BY 1), fh AS (SELECT md.*, sigma, unnest(range(1, 31)) AS h FROM md JOIN sg USING (item_id)),
      fc AS (SELECT fh.item_id, h, ld + CAST(h * step AS INT) AS day, intercept + slope * (n - 1 + h) AS trend, seasonal, phi ** h * lr AS c, sigma * sqrt((1 - phi ** (2 * h)) / (1 - phi * phi)) AS se
        FROM fh JOIN ph ON ph.item_id = fh.item_id AND ph.phase = (n - 1 + h) % 7)
    SELECT item_id, h AS step_ahead, CAST(day AS VARCHAR) AS day, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal, round(trend + seasonal + c, 4) AS forecast,
      round(trend + seasonal + c - 1.959963984540054::DOUBLE * se, 4) AS lower_bound, round(trend + seasonal + c + 1.959963984540054::DOUBLE * se, 4) AS upper_bound FROM fc""",
)
def _(spark, sf):
    f = N.explained_forecast(N.fitted_models(parts(spark, sf), "item_id", "day"), "item_id")
    f = f.withColumn("day", F.col("day").cast("string"))
    names = ("trend", "seasonal", "forecast", "lower_bound", "upper_bound")
    return _r(f, 4, *names).select("item_id", "step_ahead", "day", *names)


@query(
    "series_insights",
    _ANOM
    + """, g AS (SELECT item_id, any_value(slope) AS slope, max(seasonal) - min(seasonal) AS swing, avg(y) AS level, avg((p > 0.95)::INT) AS rate FROM an GROUP BY 1)
    SELECT item_id, 'Executive Summary' AS category, printf('Seasonal swing is %.1f%% of the mean level.', swing / level * 100) AS insight FROM g
    UNION ALL SELECT item_id, 'Trend Analysis', 'Demand is ' || CASE WHEN slope > 0 THEN 'upward' WHEN slope < 0 THEN 'downward' ELSE 'flat' END || '.' FROM g
    UNION ALL SELECT item_id, 'Anomaly Risk', printf('%.1f%% of the points are anomalous.', rate * 100) FROM g""",
)
def _(spark, sf):
    return N.insight_report(parts(spark, sf), "item_id")
