"""Queries on vector, keyword and hybrid search, reranking and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv, queries as Q, text as T
from ..operators import cells as CC, chunking as C, evaluate as M, index as XI, lexical as X, retrieval as R, vector as VV
from ..session import fresh_folder
from . import views as V
from .registry import documents, query, table
from .text_queries import SQL_CLEAN, sql_hits, sql_strip, sql_words

COS = "round(list_cosine_similarity({a}.embedding::DOUBLE[], {b}.embedding::DOUBLE[]), 10)"


def _embedded(spark, sf):
    e = table(spark, sf, "embeddings")
    q = e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q_vec"), "label")
    d = e.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("d_vec"), "label")
    return q, d


def _sim6(df):
    return df.withColumn("similarity", F.round("similarity", 6))


def _knn_sql(k: int, where: str = "TRUE", min_score: float = -2.0, extra: str = "") -> str:
    return f"""WITH p AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, b.label, {COS.format(a="a", b="b")} AS s FROM embeddings a, embeddings b WHERE {where}),
      r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM p WHERE s >= {min_score})
    SELECT query_id, doc_id, round(s, 6) AS similarity, rank{extra} FROM r WHERE rank <= {k}"""


@query("vector_nearest", _knn_sql(10))
def _(spark, sf):
    q, d = _embedded(spark, sf)
    return _sim6(VV.nearest(q, d, 10))


@query("vector_nearest_blocks", _knn_sql(10))
def _(spark, sf):
    """The way taken when the queries are too many to travel: blocks against blocks."""
    q, d = _embedded(spark, sf)
    return _sim6(VV.nearest(q, d, 10, small_side_bytes=0, block_rows=256, query_block_rows=256))


@query("vector_threshold", _knn_sql(10, min_score=0.3))
def _(spark, sf):
    q, d = _embedded(spark, sf)
    return _sim6(VV.nearest(q, d, 10, min_score=0.3))


@query("vector_filtered", _knn_sql(5, where="b.label IN (1, 2, 3)"))
def _(spark, sf):
    q, d = _embedded(spark, sf)
    return _sim6(VV.nearest(q, d, 5, filters={"label": [1, 2, 3]}))


@query("vector_multi_index", _knn_sql(10, where="b.label IN (0, 4, 7)", extra=", CAST(label AS VARCHAR) AS index_name"))
def _(spark, sf):
    q, d = _embedded(spark, sf)
    out = VV.nearest_in_indices(q, d, "label", [0, 4, 7], 10)
    return _sim6(out).withColumn("index_name", F.col("index_name").cast("string"))


@query("vector_nearest_cells")
def _(spark, sf):
    q, d = _embedded(spark, sf)
    return _sim6(CC.nearest_indexed(q, d, 10))


@query("vector_cells_recall", "SELECT count(*) * 10 AS expected, TRUE AS recall_reached, 0::BIGINT AS unlike FROM embeddings")
def _(spark, sf):
    """The index found 0.9 or more of the exact neighbours, and its similarities are theirs."""
    q, d = _embedded(spark, sf)
    exact = VV.nearest(q, d, 10).select("query_id", "doc_id", F.col("similarity").alias("e"))
    found = CC.nearest_indexed(q, d, 10).select("query_id", "doc_id", F.col("similarity").alias("f"))
    return exact.join(found, ["query_id", "doc_id"], "left").agg(
        F.count("e").alias("expected"),
        (F.count("f") >= 0.9 * F.count("e")).alias("recall_reached"),
        F.count_if(F.abs(F.col("e") - F.col("f")) > 1e-6).alias("unlike"),
    )


@query(
    "vector_similarity_matrix",
    f"""WITH p AS (SELECT a.vec_id AS i, b.vec_id AS j, {COS.format(a="a", b="b")} AS s FROM embeddings a JOIN embeddings b ON a.vec_id <= b.vec_id)
    SELECT i, j, round(s, 6) AS similarity FROM p WHERE s >= 0.3""",
)
def _(spark, sf):
    _, d = _embedded(spark, sf)
    return _sim6(VV.similar_pairs(d, min_similarity=0.3))


@query(
    "vector_similarity_banded",
    f"""WITH p AS (SELECT {COS.format(a="a", b="b")} AS s FROM embeddings a JOIN embeddings b ON a.vec_id <= b.vec_id)
    SELECT count(*) AS pairs, TRUE AS recall_reached, 0::BIGINT AS wrong FROM p WHERE s >= 0.8""",
)
def _(spark, sf):
    """The banded join found 0.95 or more of what the exact one does, and nothing else."""
    _, d = _embedded(spark, sf)
    exact = VV.similar_pairs(d, min_similarity=0.8).select("i", "j", F.lit(1).alias("e"))
    found = VV.similar_pairs_banded(d, min_similarity=0.8).select("i", "j", F.lit(1).alias("f"))
    both = exact.join(found, ["i", "j"], "full")
    return both.agg(
        F.count("e").alias("pairs"),
        (F.count_if(F.expr("e = 1 and f = 1")) >= 0.95 * F.count("e")).alias("recall_reached"),
        F.count_if(F.expr("e is null")).alias("wrong"),
    )


@query(
    "vector_norms",
    """SELECT vec_id, round(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 6) AS norm,
      round(1.0, 6)::DOUBLE AS unit_norm FROM embeddings""",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select(
        "vec_id", F.round(VV.norm("embedding"), 6).alias("norm"), F.round(VV.norm(VV.unit("embedding")), 6).alias("unit_norm")
    )


@query(
    "vector_cosine_neighbours",
    """SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("following"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(VV.cosine("embedding", "following"), 6).alias("similarity"))


_QUAL = """WITH e AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, embedding::DOUBLE[] AS v, count(*) OVER () AS n FROM embeddings),
   f AS (SELECT r, v, n, (r + n // 3 + ('0x' || substr(md5(CAST(r AS VARCHAR)), 1, 8))::BIGINT % greatest(n // 3, 1)) % n AS far FROM e),
   s AS (SELECT avg(list_cosine_similarity(a.v, b.v)) AS x, count(*) AS c FROM f a JOIN e b ON b.r = a.r + 1),
   d AS (SELECT avg(list_cosine_similarity(a.v, b.v)) AS x, count(*) AS c FROM f a JOIN e b ON b.r = a.far),
   p AS (SELECT avg(list_cosine_similarity(a.v, b.v)) AS m, stddev_pop(list_cosine_similarity(a.v, b.v)) AS sd FROM e a JOIN e b ON a.r < b.r)"""


@query(
    "embedding_quality",
    _QUAL
    + """ SELECT round(s.x, 6) AS avg_similar, round(d.x, 6) AS avg_dissimilar, s.c AS num_similar_pairs, d.c AS num_dissimilar_pairs,
      round(s.x - d.x, 6) AS contrast, round(s.x - p.m, 6) AS clustering_quality, round(p.sd, 6) AS relevance_score FROM s, d, p""",
)
def _(spark, sf):
    _, d = _embedded(spark, sf)
    out = VV.embedding_quality(d)
    whole = ("num_similar_pairs", "num_dissimilar_pairs")
    return out.select(*[c if c in whole else F.round(c, 6).alias(c) for c in out.columns])


@query(
    "embedding_verdicts",
    _QUAL
    + """ SELECT 'contrast' AS metric, CASE WHEN s.x - d.x > 0.15 THEN 'Good' ELSE 'Needs Improvement' END AS verdict FROM s, d
     UNION ALL SELECT 'clustering_quality', CASE WHEN s.x - p.m > 0.05 THEN 'Good' ELSE 'Needs Improvement' END FROM s, p
     UNION ALL SELECT 'relevance_score', CASE WHEN p.sd > 0.10 THEN 'Good' ELSE 'Needs Improvement' END FROM p
     UNION ALL SELECT 'avg_similar', CASE WHEN s.x > 0.50 THEN 'Good' ELSE 'Moderate' END FROM s
     UNION ALL SELECT 'avg_dissimilar', CASE WHEN d.x < 0.40 THEN 'Good' ELSE 'Moderate' END FROM d""",
)
def _(spark, sf):
    _, d = _embedded(spark, sf)
    m = VV.embedding_quality(d).unpivot([], list(fv.EMBEDDING_LIMITS), "metric", "value")
    return m.select("metric", T.embedding_verdict("metric", "value").alias("verdict"))


@query("embedding_hashed_text")
def _(spark, sf):
    """Stand-in encoder over all documents: vector length and non-zero share per document."""
    enc, _ = VV.hashing_encoder(documents(spark, sf).select("doc_id", "text"), "text")
    return enc.select("doc_id", F.round(VV.norm("embedding"), 5).alias("norm"), F.size("embedding").alias("dims"))


_DV = V.with_views("doc_vec", "doc_all", "text_queries")


def _dv(spark, sf):
    d = V.doc_vec(spark, sf).withColumnRenamed("embedding", "d_vec")
    q = V.text_queries(spark, sf).withColumnRenamed("embedding", "q_vec")
    return q, d


def _all(spark, sf):
    """Queries and all documents: one without a vector can still match by its words."""
    d = V.doc_all(spark, sf).withColumnRenamed("embedding", "d_vec")
    return V.text_queries(spark, sf).withColumnRenamed("embedding", "q_vec"), d


@query(
    "vector_historical_matches",
    _DV
    + f""", p AS (SELECT q.query_id, d.doc_id, d.text, {COS.format(a="q", b="d")} AS s FROM text_queries q, doc_vec d),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM p WHERE s >= 0.35)
    SELECT q.query_id, coalesce(r.rank, 1) AS rank, r.doc_id, md5(coalesce(r.text, '{fv.NO_MATCH_NOTICE}')) AS text_md5
    FROM text_queries q LEFT JOIN r ON r.query_id = q.query_id AND r.rank <= 3""",
)
def _(spark, sf):
    q, d = _dv(spark, sf)
    out = VV.historical_matches(q, d, 3, min_score=0.35)
    return out.select("query_id", "rank", "doc_id", F.md5("text").alias("text_md5"))


# ---- keyword search -------------------------------------------------------------------


def sql_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{fv.WORD}+')"


def _kw_sql(k: int) -> str:
    return f"""WITH w AS (SELECT doc_id, {sql_words("t")} AS ws, t FROM (SELECT doc_id, {SQL_CLEAN} AS t FROM documents)),
     c AS (SELECT doc_id, unnest(CASE WHEN len(ws) <= 390 THEN [0] ELSE range(0, len(ws), 351) END) AS s, ws, t FROM w),
     k AS (SELECT CAST(doc_id AS VARCHAR) || '_chunk_' || CAST(s // 351 AS VARCHAR) AS doc_id,
        {sql_tokens("CASE WHEN len(ws) <= 390 THEN t ELSE array_to_string(ws[s + 1 : s + 390], ' ') END")} AS tk FROM c),
     dt AS (SELECT doc_id, unnest(tk) AS term, len(tk) AS n FROM k), tf AS (SELECT doc_id, term, n, count(*) AS tf FROM dt GROUP BY ALL),
     qt AS (SELECT DISTINCT item_id AS query_id, unnest({sql_tokens("text")}) AS term FROM benchmark),
     s AS (SELECT query_id, doc_id, sum(tf / n * 1000) AS score FROM qt JOIN tf USING (term) GROUP BY ALL),
     a AS (SELECT b.item_id AS query_id, k.doc_id, round(coalesce(s.score, 0), 9) AS score FROM benchmark b CROSS JOIN k
           LEFT JOIN s ON s.query_id = b.item_id AND s.doc_id = k.doc_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM a)
    SELECT query_id, doc_id, round(score, 6) AS score, rank FROM r WHERE rank <= {k}"""


@query("keyword_search", _kw_sql(5))
def _(spark, sf):
    """Clean and chunk all documents, then the best chunks for every benchmark text."""
    clean = documents(spark, sf).select("doc_id", T.clean_text("text").alias("text"))
    chunks = C.word_windows(clean).select(
        F.concat_ws("_chunk_", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string")).alias("doc_id"),
        F.col("chunk_text").alias("text"),
    )
    q = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    # the documents are read for their size, as the chunks would be cleaned and cut twice
    found = X.keyword_search(q, chunks, 5, sized_by=table(spark, sf, "documents"))
    return found.withColumn("score", F.round("score", 6))


def _bm25_cte(
    docs: str, queries: str, text: str = "text", q: str = "query", idf: str = "1.0", avg: str = "100", out: str = "kw"
) -> str:
    return f"""{out}_w AS (SELECT doc_id, {sql_words(f"lower({text})")} AS ws FROM {docs}),
     {out}_t AS (SELECT doc_id, unnest(ws) AS term, len(ws) AS n FROM {out}_w),
     {out}_f AS (SELECT doc_id, term, n, count(*) AS tf FROM {out}_t GROUP BY ALL),
     {out}_q AS (SELECT DISTINCT query_id, unnest({sql_words(f"lower({q})")}) AS term FROM {queries}),
     {out}_s AS (SELECT (SELECT count(*) FROM {out}_w) AS nd, (SELECT avg(len(ws)) FROM {out}_w) AS al),
     {out}_d AS (SELECT term, count(*) AS df FROM {out}_f GROUP BY 1),
     {out} AS (SELECT query_id, doc_id, sum(({idf}) * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / {avg}))) AS kw
        FROM {out}_q JOIN {out}_f USING (term) JOIN {out}_d USING (term), {out}_s GROUP BY ALL)"""


def _bm25_sql(idf: str, avg: str) -> str:
    return f"""WITH qs AS (SELECT item_id AS query_id, text AS query FROM benchmark), {_bm25_cte("documents", "qs", idf=idf, avg=avg)},
     r AS (SELECT query_id, doc_id, round(kw, 9) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(kw, 9) DESC, doc_id) AS rank FROM kw)
    SELECT query_id, doc_id, round(score, 6) AS score, rank FROM r WHERE rank <= 5"""


def _bm(spark, sf, **o):
    q = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return X.bm25_search(q, documents(spark, sf), 5, **o).withColumn("score", F.round("score", 6))


@query("bm25_search", _bm25_sql("1.0::DOUBLE", "100"))
def _(spark, sf):
    return _bm(spark, sf)


@query("bm25_search_indexed", _bm25_sql("1.0::DOUBLE", "100"))
def _(spark, sf):
    """The same over an index table that is written once."""
    q = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), X.query_terms(T.words(F.lower("text"))).alias("q_terms"))
    path = fresh_folder(spark, "index")
    XI.write_index(X.bm25_weights(XI.in_blocks(table(spark, sf, "documents")), "text").drop("text"), path)
    return XI.search_index(spark, path, q, 5).withColumn("score", F.round("score", 6))


@query("bm25_search_corpus", _bm25_sql("ln(1 + (nd - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))", "al"))
def _(spark, sf):
    return _bm(spark, sf, corpus_statistics=True)


# ---- hybrid ---------------------------------------------------------------------------


def _hybrid_cte(alpha: str, docs: str = "doc_all", queries: str = "text_queries") -> str:
    """h(query_id, doc_id, sem, kwn, score) and hr with ranks, over all pairs."""
    return f"""{_bm25_cte(docs, queries)},
     h AS (SELECT q.query_id, d.doc_id, coalesce(round(list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 14), 0) AS sem,
         least(1.0::DOUBLE, coalesce(kw, 0) / 10) AS kwn FROM {queries} q CROSS JOIN {docs} d LEFT JOIN kw ON kw.query_id = q.query_id AND kw.doc_id = d.doc_id),
     hs AS (SELECT *, round({alpha} * sem + (1 - {alpha}) * kwn, 10) AS score FROM h),
     hr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM hs)"""


_HCOLS = "query_id, doc_id, round(score, 6) AS score, round(sem, 6) AS semantic_score, round(kwn, 6) AS keyword_score, rank"


def _scores6(df):
    cols = ("score", "semantic_score", "keyword_score")
    return df.select(*[F.round(c, 6).alias(c) if c in cols else c for c in df.columns])


@query("hybrid_search", f"{_DV}, {_hybrid_cte('0.5::DOUBLE')} SELECT {_HCOLS} FROM hr WHERE rank <= 5")
def _(spark, sf):
    q, d = _all(spark, sf)
    return _scores6(R.hybrid_search(q, d, 5))


def _fielded_sql(alpha: float, k: int, qs: str = "text_queries", extra: str = "") -> str:
    t = _bm25_cte("dt", qs, text="title", out="kwt")
    return (
        _DV
        + extra
        + f""", dt AS (SELECT *, string_split(text, chr(10))[1] AS title FROM doc_all), {t}, {_bm25_cte("dt", qs)},
      h AS (SELECT q.query_id, d.doc_id, coalesce(list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 0) AS sem,
         least(1.0::DOUBLE, greatest(2 * coalesce(kwt.kw, 0), coalesce(kw.kw, 0)) / 10) AS kwn FROM {qs} q CROSS JOIN dt d
         LEFT JOIN kw ON kw.query_id = q.query_id AND kw.doc_id = d.doc_id LEFT JOIN kwt ON kwt.query_id = q.query_id AND kwt.doc_id = d.doc_id),
      hs AS (SELECT *, round({alpha}::DOUBLE * sem + (1 - {alpha}::DOUBLE) * kwn, 10) AS score FROM h),
      hr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM hs)"""
    )


def _titled(spark, sf):
    q, d = _all(spark, sf)
    return q, d.withColumn("title", F.split("text", "\n").getItem(0))


@query("fielded_search", _fielded_sql(0.7, 10) + f" SELECT {_HCOLS} FROM hr WHERE rank <= 10")
def _(spark, sf):
    q, d = _titled(spark, sf)
    return _scores6(R.fielded_search(q, d, 10))


def _expansion_sql() -> str:
    parts = " || ".join(
        f"(CASE WHEN contains(lower(query), '{k}') THEN ' ' || '{' '.join(v)}' ELSE '' END)" for k, v in fv.TRIGGER_EXPANSIONS.items()
    )
    return f", xq AS (SELECT query_id, query || {parts} AS query, embedding FROM text_queries)"


@query("fielded_search_expanded", _fielded_sql(0.7, 10, "xq", _expansion_sql()) + f" SELECT {_HCOLS} FROM hr WHERE rank <= 10")
def _(spark, sf):
    q, d = _titled(spark, sf)
    return _scores6(R.fielded_search(q, d, 10, expand=True))


@query("fielded_keyword_search", _fielded_sql(0.0, 10) + f" SELECT {_HCOLS} FROM hr WHERE rank <= 10")
def _(spark, sf):
    q, d = _titled(spark, sf)
    return _scores6(R.fielded_search(q, d, 10, alpha=0.0))


_SCORE_ONLY = " SELECT query_id, doc_id, round(score, 6) AS score, "


@query(
    "search_semantic_filtered",
    _DV
    + f""", h AS (SELECT q.query_id, d.doc_id, coalesce({COS.format(a="q", b="d")}, 0) AS score FROM text_queries q, doc_all d WHERE d.lang IN ('en', 'fr')),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM h)
    SELECT query_id, doc_id, round(score, 6) AS score, rank FROM r WHERE rank <= 5""",
)
def _(spark, sf):
    q, d = _titled(spark, sf)
    out = R.search(q, d, 5, kind="semantic", filters={"lang": ["en", "fr"]})
    return _scores6(out).select("query_id", "doc_id", "score", "rank")


@query(
    "search_hybrid_diverse",
    _fielded_sql(0.7, 10)
    + """, t AS (SELECT hr.*, d.source FROM hr JOIN doc_all d USING (doc_id) WHERE rank <= 10),
     u AS (SELECT *, row_number() OVER (PARTITION BY query_id, source ORDER BY rank) > 1 AS again FROM t),
     v AS (SELECT query_id, doc_id, score, source, row_number() OVER (PARTITION BY query_id ORDER BY again, rank) AS rank FROM u)
    SELECT query_id, doc_id, round(score, 6) AS score, source, rank FROM v WHERE rank <= 5""",
)
def _(spark, sf):
    q, d = _titled(spark, sf)
    out = R.search(q, d, 5, kind="hybrid", rerank="diversity", group="source")
    return _scores6(out).select("query_id", "doc_id", "score", "source", "rank")


@query(
    "search_keyword_boosted",
    _fielded_sql(0.0, 10)
    + """, t AS (SELECT hr.*, d.label FROM hr JOIN doc_all d USING (doc_id) WHERE rank <= 10),
     v AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score + 0.01::DOUBLE * coalesce(label, 0) DESC, rank) AS r2 FROM t)
    SELECT query_id, doc_id, round(score, 6) AS score, label, r2 AS rank FROM v WHERE r2 <= 5""",
)
def _(spark, sf):
    q, d = _titled(spark, sf)
    out = R.search(q, d, 5, kind="keyword", rerank="recency", boost="label")
    return _scores6(out).select("query_id", "doc_id", "score", "label", "rank")


# ---- query understanding --------------------------------------------------------------

V.SQL["questions"] = """
  SELECT conv_id * 1000 + turn AS query_id, CASE (conv_id + turn) % 9
     WHEN 0 THEN 'Who was ' || text || '?'
     WHEN 1 THEN '¿Cuántos ' || role || ' hay en el libro?'
     WHEN 2 THEN text || ' and then compare ' || role
     WHEN 3 THEN '¿Dónde es ' || role || '? How many ' || role || '?'
     WHEN 4 THEN 'Bautiso registro año yglesia de Sn ' || role || ' 1600s'
     WHEN 5 THEN text
     WHEN 6 THEN 'tech ai data for ' || role
     WHEN 7 THEN 'When was the ' || role || ' total during the period?'
     ELSE 'libro parroquia ' || role END AS query
  FROM conversations"""


def questions(spark, sf):
    c = table(spark, sf, "conversations")
    t, r, m = F.col("text"), F.col("role"), (F.col("conv_id") + F.col("turn")) % 9
    forms = [
        F.concat(F.lit("Who was "), t, F.lit("?")),
        F.concat(F.lit("¿Cuántos "), r, F.lit(" hay en el libro?")),
        F.concat(t, F.lit(" and then compare "), r),
        F.concat(F.lit("¿Dónde es "), r, F.lit("? How many "), r, F.lit("?")),
        F.concat(F.lit("Bautiso registro año yglesia de Sn "), r, F.lit(" 1600s")),
        t,
        F.concat(F.lit("tech ai data for "), r),
        F.concat(F.lit("When was the "), r, F.lit(" total during the period?")),
        F.concat(F.lit("libro parroquia "), r),
    ]
    text = forms[-1]
    for i, f in reversed(list(enumerate(forms[:-1]))):
        text = F.when(m == i, f).otherwise(text)
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), text.alias("query"))


_QS = V.with_views("questions")


def _trigger_sql() -> str:
    parts = ", ".join(
        "CASE WHEN contains(lower(query), '{}') THEN [{}] ELSE [] END".format(k, ", ".join(f"'{s}'" for s in v))
        for k, v in fv.TRIGGER_EXPANSIONS.items()
    )
    return f"array_to_string(list_sort(list_distinct(flatten([[query], {parts}]))), '|')"


@query("query_trigger_expansion", _QS + f"SELECT query_id, {_trigger_sql()} AS terms FROM questions")
def _(spark, sf):
    q = questions(spark, sf)
    return q.select("query_id", F.array_join(X.triggered_expansion(F.col("query")), "|").alias("terms"))


def _synonym_sql() -> str:
    cases = " ".join(f"WHEN '{k}' THEN ['{v[0]}', '{v[1]}']" for k, v in fv.DOMAIN_SYNONYMS.items())
    w = sql_words("lower(query)")
    return f"array_to_string(list_concat({w}, flatten(list_transform({w}, lambda t: CASE t {cases} ELSE [] END))), ' ')"


@query("query_synonym_expansion", _QS + f"SELECT query_id, {_synonym_sql()} AS expanded FROM questions")
def _(spark, sf):
    return questions(spark, sf).select("query_id", X.synonym_expansion(F.col("query")).alias("expanded"))


def _intent_sql() -> str:
    items = ", ".join(
        f"{{'hits': {sql_hits('lower(query)', k)}, 'pos': {-i}, 'intent': '{n}', 'of_n': {len(k)}}}"
        for i, (n, k) in enumerate(fv.INTENT_KEYWORDS.items())
    )
    return f"""b AS (SELECT query_id, query, list_sort([{items}], 'DESC')[1] AS x FROM questions),
      i AS (SELECT query_id, query, CASE WHEN x.hits > 0 THEN x.intent ELSE 'factual' END AS intent,
        round(CASE WHEN x.hits > 0 THEN least(1.0::DOUBLE, x.hits / x.of_n) ELSE 0.5::DOUBLE END, 6) AS confidence FROM b)"""


@query("query_intent", _QS + f", {_intent_sql()} SELECT query_id, intent, confidence FROM i")
def _(spark, sf):
    q = questions(spark, sf).select("query_id", T.intent("query").alias("i"))
    return q.select("query_id", "i.intent", F.round("i.confidence", 6).alias("confidence"))


def _complex_sql() -> str:
    signs = " OR ".join(f"regexp_matches(lower(query), '{p}')" for p in fv.COMPLEXITY_PATTERNS if p != "?.*?")
    return f"(length(query) - length(replace(query, '?', '')) > 1 OR {signs} OR len({sql_words('query')}) > 20)"


def _split_sql() -> str:
    qs = f"list_transform(list_filter(string_split(query, '?'), lambda p: {sql_strip('p')} <> ''), lambda p: {sql_strip('p')} || '?')"
    cases = " ".join(
        f"WHEN contains(lower(query), '{c}') THEN list_transform(string_split(query, '{c}'), lambda p: {sql_strip('p')})"
        for c in fv.SPLIT_CONJUNCTIONS
    )
    return f"CASE WHEN len({qs}) > 1 THEN {qs} {cases} ELSE [query] END"


@query("query_complexity", _QS + f"SELECT query_id, {_complex_sql()} AS is_complex FROM questions")
def _(spark, sf):
    return questions(spark, sf).select("query_id", Q.is_complex(F.col("query")).alias("is_complex"))


@query(
    "query_decomposition",
    _QS
    + f""", p AS (SELECT query_id, CASE WHEN {_complex_sql()} THEN {_split_sql()} ELSE [query] END AS parts FROM questions)
    SELECT query_id, unnest(range(0, len(parts))) AS step, unnest(parts) AS sub_query, FALSE AS dependent FROM p""",
)
def _(spark, sf):
    d = questions(spark, sf).select("query_id", F.posexplode_outer(Q.decompose(F.col("query"))).alias("step", "s"))
    return d.select("query_id", "step", F.col("s.query").alias("sub_query"), "s.dependent")


@query(
    "query_listed_subqueries",
    f"""WITH g AS (SELECT conv_id, turn, CASE WHEN turn = 0 THEN text ELSE '1. Find ' || role || chr(10) || 'note' || chr(10) || '2) Use it with '
          || role || chr(10) || '- based on these' || chr(10) || '3. ' END AS g, text FROM conversations),
      l AS (SELECT conv_id, turn, text, list_filter(list_transform(string_split(g, chr(10)), lambda x: {sql_strip("x")}), lambda x: regexp_matches(x, '^(\\p{{Nd}}|-)')) AS xs FROM g),
      m AS (SELECT conv_id, turn, text, list_filter(list_transform(xs, lambda x: regexp_replace(regexp_replace(x, '^\\d+[.)]\\s*', ''), '^[-•]\\s*', '')), lambda x: x <> '') AS xs FROM l),
      n AS (SELECT conv_id, turn, CASE WHEN len(xs) > 0 THEN xs ELSE [text] END AS xs FROM m),
      o AS (SELECT conv_id, turn, unnest(range(0, len(xs))) AS step, unnest(xs) AS sub_query FROM n)
    SELECT conv_id, turn, step, sub_query, step > 0 AND (contains(lower(sub_query), 'based on') OR contains(lower(sub_query), 'usando')
      OR contains(lower(sub_query), 'with') OR contains(lower(sub_query), 'from above')) AS dependent FROM o""",
)
def _(spark, sf):
    c = table(spark, sf, "conversations")
    g = F.when(F.col("turn") == 0, F.col("text")).otherwise(
        F.concat(
            F.lit("1. Find "), F.col("role"), F.lit("\nnote\n2) Use it with "), F.col("role"), F.lit("\n- based on these\n3. ")
        )
    )
    s = c.select("conv_id", "turn", F.posexplode_outer(Q.listed_subqueries(g, F.col("text"))).alias("step", "s"))
    return s.select("conv_id", "turn", "step", F.col("s.query").alias("sub_query"), "s.dependent")


def _norm_sql(x: str = "query") -> str:
    for old, new in fv.NORMALISATIONS.items():
        x = f"regexp_replace({x}, '(?i)\\b{old}\\b', '{new}', 'g')"
    return x


@query("query_normalised", _QS + f"SELECT query_id, {_norm_sql()} AS normalised FROM questions")
def _(spark, sf):
    return questions(spark, sf).select("query_id", Q.normalise(F.col("query")).alias("normalised"))


def _statement_sql() -> str:
    cases = []
    for p, form in fv.QUESTION_FORMS:
        r = form.replace("{1}", "\\1").replace("{2}", "\\2")
        cases.append(f"WHEN regexp_matches(query, '(?i){p}') THEN regexp_replace(query, '(?i){p}', '{r}', 'g')")
    return f"CASE {' '.join(cases)} ELSE query END"


@query("query_statement", _QS + f"SELECT query_id, {_statement_sql()} AS statement FROM questions")
def _(spark, sf):
    return questions(spark, sf).select("query_id", Q.to_statement(F.col("query")).alias("statement"))


def _context_sql(terms: list[str]) -> str:
    has = " OR ".join(f"contains(lower(query), '{t.lower()}')" for t in terms)
    return f"CASE WHEN NOT ({has}) AND len({sql_words('query')}) < 10 THEN query || '{fv.CONTEXT_SUFFIX}' ELSE query END"


@query("query_with_context", _QS + f"SELECT query_id, {_context_sql(fv.CONTEXT_TERMS)} AS contextual FROM questions")
def _(spark, sf):
    return questions(spark, sf).select("query_id", Q.with_context(F.col("query")).alias("contextual"))


@query(
    "query_variations",
    _QS
    + f""", v AS (SELECT query_id, query, {_norm_sql()} AS n, CASE WHEN contains(query, '?') THEN {_statement_sql()} END AS s,
         nullif({_synonym_sql()}, query) AS e, nullif({_context_sql(fv.CONTEXT_TERMS)}, query) AS c FROM questions),
      x AS (SELECT query_id, unnest([1, 2, 3, 4, 5]) AS pos, unnest([query, n, s, e, c]) AS v FROM v),
      y AS (SELECT query_id, {sql_strip("v")} AS v, min(pos) AS pos FROM x WHERE v IS NOT NULL AND {sql_strip("v")} <> '' GROUP BY ALL),
      z AS (SELECT query_id, v AS variation, row_number() OVER (PARTITION BY query_id ORDER BY pos) AS n FROM y)
    SELECT query_id, n, variation FROM z WHERE n <= 4""",
)
def _(spark, sf):
    q = questions(spark, sf).select("query_id", F.posexplode_outer(Q.variations(F.col("query"))).alias("p", "variation"))
    return q.select("query_id", (F.col("p") + 1).alias("n"), "variation")


@query(
    "query_transformed",
    _QS
    + f""", {_intent_sql()} SELECT query_id, intent, CASE WHEN intent = 'aggregation' THEN {_context_sql(fv.COUNTING_TERMS)}
      ELSE {_norm_sql()} END AS transformed FROM i""",
)
def _(spark, sf):
    q = questions(spark, sf).withColumn("intent", T.intent("query")["intent"])
    return q.select("query_id", "intent", Q.transformed(F.col("query"), F.col("intent")).alias("transformed"))


# ---- reranking ------------------------------------------------------------------------


@query("rerank_max_min_diversity")
def _(spark, sf):
    q, d = _all(spark, sf)
    hits = R.hybrid_search(q, d, 10).join(d.select("doc_id", "text"), "doc_id")
    return R.rerank_by_diversity(hits).select("query_id", "doc_id", "rank", F.round("score", 6).alias("score"))


@query(
    "rerank_metadata_first",
    f"""{_DV}, {_hybrid_cte("0.5::DOUBLE")}, t AS (SELECT hr.*, d.lang FROM hr JOIN doc_all d USING (doc_id) WHERE rank <= 10),
     u AS (SELECT query_id, doc_id, lang, row_number() OVER (PARTITION BY query_id ORDER BY (lang = 'fr') DESC, rank) AS rank FROM t)
    SELECT * FROM u WHERE rank <= 5""",
)
def _(spark, sf):
    q, d = _all(spark, sf)
    hits = R.hybrid_search(q, d, 10).join(d.select("doc_id", "lang"), "doc_id")
    return R.rerank_by_metadata(hits, "lang", "fr").select("query_id", "doc_id", "lang", "rank")


@query(
    "rerank_outside_listing",
    f"""{_DV}, {_hybrid_cte("0.5::DOUBLE")}, t AS (SELECT * FROM hr WHERE rank <= 10),
     p(n, pos) AS (VALUES (3, 0), (1, 1), (9, 3), (99, 4)),
     u AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY coalesce(pos, 1000), rank) AS rank FROM t LEFT JOIN p ON p.n = t.rank)
    SELECT * FROM u WHERE rank <= 5""",
)
def _(spark, sf):
    q, d = _all(spark, sf)
    listing = q.select("query_id", F.lit("3, 1, x2, 9, 99, 3").alias("ranking"))
    return R.rerank_by_listing(R.hybrid_search(q, d, 10), listing).select("query_id", "doc_id", "rank")


@query("search_full")
def _(spark, sf):
    q, d = _all(spark, sf)
    return R.full_search(q, d).select("query_id", "doc_id", "rank", F.round("score", 6).alias("score"))


_GROUNDED = f"""{_DV}, {_hybrid_cte("0.7::DOUBLE")}, t AS (SELECT * FROM hr WHERE rank <= 10),
   g AS (SELECT * FROM t WHERE score >= 0.3 AND rank <= 5), x AS (SELECT g.*, d.text, length(d.text) AS n,
     sum(length(d.text)) OVER (PARTITION BY query_id ORDER BY rank) AS upto FROM g JOIN doc_all d USING (doc_id)),
   y AS (SELECT *, min(CASE WHEN upto > 4000 THEN rank END) OVER (PARTITION BY query_id) AS stop FROM x),
   z AS (SELECT *, upto > 4000 AS truncated, CASE WHEN upto > 4000 THEN substr(text, 1, (4000 - (upto - n))::INT) || '...' ELSE text END AS body FROM y
      WHERE stop IS NULL OR rank < stop OR (rank = stop AND 4000 - (upto - n) > 100))"""


@query(
    "search_grounded",
    _GROUNDED
    + """ SELECT query_id, doc_id, rank, truncated, md5(body) AS text_md5,
     (SELECT count(*) FROM t WHERE t.query_id = z.query_id) AS total_found, (SELECT count(*) FROM g WHERE g.query_id = z.query_id) AS filtered_count,
     count(*) OVER (PARTITION BY query_id) AS returned_count FROM z""",
)
def _(spark, sf):
    q, d = _all(spark, sf)
    out = R.grounded_retrieval(q, d, min_score=0.3, max_tokens=1000)
    return out.select(
        "query_id", "doc_id", "rank", "truncated", F.md5("text").alias("text_md5"), "total_found", "filtered_count", "returned_count"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(
    "prompt_texts",
    _GROUNDED
    + f""", s AS (SELECT z.query_id, string_agg(chr(10) || '[Source ' || rank || ' - r/' || d.source || ']' || chr(10) || body || chr(10), '' ORDER BY rank) AS b
       FROM z JOIN doc_all d USING (doc_id) GROUP BY 1)
    SELECT s.query_id, md5({_quoted(fv.PROMPT_HEAD)} || b || {_quoted(fv.PROMPT_RULES)} || chr(10) || chr(10) || 'Question: ' || q.query
      || chr(10) || chr(10) || 'Answer:') AS prompt_md5 FROM s JOIN text_queries q USING (query_id)""",
)
def _(spark, sf):
    q, d = _all(spark, sf)
    ctx = R.grounded_retrieval(q, d, min_score=0.3, max_tokens=1000).join(d.select("doc_id", "source"), "doc_id")
    return R.prompt_texts(ctx, q).select("query_id", F.md5("prompt").alias("prompt_md5"))


@query(
    "claim_details_text",
    V.with_views("claims")
    + """SELECT claim_id, 'Claim ID: ' || claim_id || ', Customer ID: ' || notes || ', Amount: $' || CAST(CAST(round(c_acctbal) AS BIGINT) AS VARCHAR)
      || ', Text: ' || raw_text AS details FROM claims""",
)
def _(spark, sf):
    c = V.claims(spark, sf)
    amount = F.round("c_acctbal").cast("long").cast("string")
    return c.select("claim_id", R.claim_text(F.col("claim_id"), F.col("notes"), amount, F.col("raw_text")).alias("details"))


@query(
    "search_formatted",
    f"""{_DV}, {_hybrid_cte("0.5::DOUBLE")} SELECT query_id, rank, round(score, 6) AS score, md5(substr(d.text, 1, 500)) AS text_md5, d.lang AS level,
    coalesce(CASE WHEN d.lang <> 'fr' THEN d.source END, '') AS title FROM hr JOIN doc_all d USING (doc_id) WHERE rank <= 5""",
)
def _(spark, sf):
    q, d = _all(spark, sf)
    hits = R.hybrid_search(q, d, 5).join(d.select("doc_id", "text", F.col("lang").alias("level"), F.when(F.col("lang") != "fr", F.col("source")).alias("title")), "doc_id")
    rows = F.from_json("hits_json", "array<struct<rank:int, relevance_score:double, text:string, metadata:struct<level:string, title:string>>>")
    h = R.formatted_hits(hits).select("query_id", F.explode(rows).alias("h"))
    return h.select("query_id", "h.rank", F.round("h.relevance_score", 6).alias("score"), F.md5("h.text").alias("text_md5"), "h.metadata.level", "h.metadata.title")


@query(
    "search_alpha_sweep",
    f"""{_DV}, {_hybrid_cte("0.5::DOUBLE")}, a(alpha) AS (VALUES (0.0::DOUBLE), (0.3::DOUBLE), (0.5::DOUBLE), (0.7::DOUBLE), (1.0::DOUBLE)),
      x AS (SELECT query_id, doc_id, alpha, round(alpha * sem + (1 - alpha) * kwn, 10) AS s FROM h CROSS JOIN a),
      y AS (SELECT *, row_number() OVER (PARTITION BY query_id, alpha ORDER BY s DESC, doc_id) AS rank FROM x)
    SELECT query_id, alpha, doc_id, round(s, 6) AS score, rank FROM y WHERE rank <= 3""",
)
def _(spark, sf):
    q, d = _all(spark, sf)
    return _scores6(R.alpha_sweep(q, d, [0.0, 0.3, 0.5, 0.7, 1.0])).select("query_id", "alpha", "doc_id", "score", "rank")


@query(
    "search_compared_methods",
    f"""{_DV}, {_hybrid_cte("0.5::DOUBLE")}, a(alpha, method) AS (VALUES (0.0::DOUBLE, 'keyword'), (0.5::DOUBLE, 'hybrid'), (1.0::DOUBLE, 'semantic')),
      x AS (SELECT query_id, doc_id, method, round(alpha * sem + (1 - alpha) * kwn, 10) AS s FROM h CROSS JOIN a),
      y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY query_id, method ORDER BY s DESC, doc_id) <= 5),
      z AS (SELECT *, max((method = 'hybrid')::INT) OVER (PARTITION BY query_id, doc_id) AS shared FROM y)
    SELECT method, count(*) AS results, count(DISTINCT query_id) AS queries, round(avg(s), 6) AS mean_score, round(avg(shared), 6) AS share_in_hybrid FROM z GROUP BY 1""",
)
def _(spark, sf):
    q, d = _all(spark, sf)
    m = R.compared_methods(q, d)
    return m.select("method", "results", "queries", F.round("mean_score", 6).alias("mean_score"), F.round("share_in_hybrid", 6).alias("share_in_hybrid"))


@query(
    "search_tested_strategies",
    f"""{_DV}, {_hybrid_cte("0.5::DOUBLE")}, a(strategy, alpha, m) AS (VALUES ('High Precision', 0.9::DOUBLE, 0.7::DOUBLE), ('Balanced', 0.7::DOUBLE, 0.5::DOUBLE), ('High Recall', 0.5::DOUBLE, 0.3::DOUBLE)),
      x AS (SELECT query_id, doc_id, strategy, m, round(alpha * sem + (1 - alpha) * kwn, 10) AS s FROM h CROSS JOIN a),
      y AS (SELECT *, row_number() OVER (PARTITION BY query_id, strategy ORDER BY s DESC, doc_id) AS rank FROM x)
    SELECT query_id, strategy, count(*) FILTER (rank <= 5 AND s >= m) AS num_sources FROM y GROUP BY ALL""",
)
def _(spark, sf):
    q, d = _all(spark, sf)
    return R.tested_strategies(q, d)


@query("search_multi_step")
def _(spark, sf):
    """Every benchmark text in two steps, the second depending on what the first found."""
    q, d = _all(spark, sf)
    steps = F.array(
        F.struct(F.col("query").alias("query"), F.lit(False).alias("dependent")),
        F.struct(F.concat(F.lit("compare those in "), F.col("query")).alias("query"), F.lit(True).alias("dependent")),
    )
    out = R.multi_step_search(q.withColumn("steps", steps), d)
    return out.select("query_id", "doc_id", "step", "rank", F.round("score", 6).alias("score"))


@query("search_multi_step_by_rule")
def _(spark, sf):
    q, d = _all(spark, sf)
    out = R.multi_step_search(q, d)
    return out.select("query_id", "doc_id", "step", "rank", F.round("score", 6).alias("score"))


@query(
    "query_resolved_references",
    V.with_views("questions")
    + f""", e AS (SELECT q.query_id, q.query, regexp_extract_all(c.text, '(?i){fv.ENTITY_PATTERNS["names"]}') AS n FROM questions q
        JOIN conversations c ON c.conv_id * 1000 + c.turn = q.query_id),
      o AS (SELECT query_id, query, list_transform(n, lambda x, i: {{'x': x, 'first': list_position(n, x) = i}}) AS n FROM e),
      u AS (SELECT query_id, query, list_transform(list_filter(n, lambda s: s.first), lambda s: s.x)[1:2] AS two FROM o)
    SELECT query_id, md5(CASE WHEN {" OR ".join(f"contains(lower(query), '{m}')" for m in fv.REFERENCE_MARKERS)} THEN
      {sql_strip("query || CASE WHEN len(two) > 0 THEN ' (personas: ' || array_to_string(two, ', ') || ')' ELSE '' END")} ELSE query END) AS resolved_md5 FROM u""",
)
def _(spark, sf):
    c = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")
    d = questions(spark, sf).join(c, "query_id").withColumn("names", T.entities("text", "names"))
    none = F.array().cast("array<string>")
    return d.select("query_id", F.md5(Q.resolved(F.col("query"), F.col("names"), none, none)).alias("resolved_md5"))


# ---- evaluation -----------------------------------------------------------------------


def _judged(spark, sf, k=10):
    """Hits of the text queries by vector; relevant is a document of the same label."""
    q, d = _dv(spark, sf)
    hits = VV.nearest(q, d, k).join(d.select("doc_id", F.col("label").alias("d_label")), "doc_id")
    hits = hits.join(q.select("query_id", "label"), "query_id")
    sizes = d.groupBy("label").agg(F.count(F.lit(1)).alias("n_relevant"))
    rel = F.when(F.col("label") == F.col("d_label"), F.when(F.col("doc_id") == F.col("query_id"), 2).otherwise(1)).otherwise(0)
    return hits.withColumn("rel", rel), q.join(sizes, "label", "left").na.fill(0, ["n_relevant"])


_JUDGED = (
    _DV
    + f""", p AS (SELECT q.query_id, d.doc_id, CASE WHEN q.label = d.label THEN CASE WHEN q.query_id = d.doc_id THEN 2 ELSE 1 END ELSE 0 END AS rel,
      {COS.format(a="q", b="d")} AS s FROM text_queries q, doc_vec d),
   r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM p),
   t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rel DESC, rank) AS ideal FROM r WHERE rank <= 10),
   m AS (SELECT query_id, count(*) FILTER (rel > 0 AND rank <= @k@) AS hits, min(rank) FILTER (rel > 0) AS f, sum(rel / log2(rank + 1)) FILTER (rank <= @k@) AS dcg,
      sum(rel / log2(ideal + 1)) FILTER (ideal <= @k@) AS idcg FROM t GROUP BY 1),
   e AS (SELECT m.query_id, hits / @k@ AS precision, hits / (SELECT count(*) FROM doc_vec d WHERE d.label = q.label) AS recall, coalesce(1 / f, 0) AS rr,
      dcg, CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END AS ndcg FROM m JOIN text_queries q USING (query_id))"""
)


@query(
    "evaluate_ranking",
    _JUDGED.replace("@k@", "5")
    + """ SELECT query_id, round(precision, 6) AS precision, round(recall, 6) AS recall, round(rr, 6) AS reciprocal_rank, round(dcg, 6) AS dcg,
      round(ndcg, 6) AS ndcg FROM e""",
)
def _(spark, sf):
    hits, q = _judged(spark, sf)
    m = M.ranking_metrics(hits, q, 5)
    return m.select("query_id", *[F.round(c, 6).alias(c) for c in m.columns[1:]])


@query(
    "evaluate_methods",
    _JUDGED.replace("@k@", "5")
    + """ SELECT 'semantic' AS method, round(avg(precision), 6) AS mean_precision, round(avg(recall), 6) AS mean_recall, round(avg(rr), 6) AS mrr,
      round(avg(ndcg), 6) AS mean_ndcg, count(*) AS queries_evaluated FROM e""",
)
def _(spark, sf):
    hits, q = _judged(spark, sf)
    m = M.method_summary(M.ranking_metrics(hits, q, 5).withColumn("method", F.lit("semantic")), by=["method"])
    return m.select(*[F.round(c, 6).alias(c) if c.startswith("m") and c != "method" else c for c in m.columns])


@query(
    "evaluate_recall_50",
    _DV
    + f""", p AS (SELECT q.query_id, q.label AS ql, d.label AS dl, row_number() OVER (PARTITION BY q.query_id ORDER BY {COS.format(a="q", b="d")} DESC, d.doc_id) AS rank
        FROM text_queries q, doc_vec d)
    SELECT query_id, round(count(*) FILTER (ql = dl AND rank <= 50) / count(*) FILTER (ql = dl), 6) AS recall FROM p GROUP BY 1""",
)
def _(spark, sf):
    hits, q = _judged(spark, sf, 50)
    return M.ranking_metrics(hits, q, 50).select("query_id", F.round("recall", 6).alias("recall"))


_TOPICS = f"""topics AS (SELECT item_id AS query_id, list_distinct(list_filter({sql_tokens("text")}, lambda t: length(t) >= 7)) AS topics FROM benchmark)"""
_TOPIC_HITS = f"""WITH qs AS (SELECT item_id AS query_id, text AS query FROM benchmark), {_bm25_cte("documents", "qs")}, {_TOPICS},
    hits AS (SELECT query_id, doc_id FROM kw QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(kw, 9) DESC, doc_id) <= 5)"""


def _topics(spark, sf):
    b = table(spark, sf, "benchmark")
    q = b.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    t = F.array_distinct(F.filter(T.tokens("query"), lambda x: F.length(x) >= 7))
    return q, q.select("query_id", t.alias("topics"))


@query(
    "evaluate_topics",
    _TOPIC_HITS
    + """, tt AS (SELECT query_id, unnest(topics) AS topic FROM topics),
      m AS (SELECT DISTINCT t.query_id, d.doc_id FROM tt t JOIN documents d ON contains(lower(d.text), t.topic)),
      c AS (SELECT q.query_id, (SELECT count(*) FROM m WHERE m.query_id = q.query_id) AS total_relevant,
        (SELECT count(*) FROM m JOIN hits h USING (query_id, doc_id) WHERE m.query_id = q.query_id) AS relevant_retrieved FROM topics q),
      e AS (SELECT *, relevant_retrieved / 5::DOUBLE AS p, CASE WHEN total_relevant > 0 THEN relevant_retrieved / total_relevant ELSE 0 END AS r FROM c)
    SELECT query_id, total_relevant, relevant_retrieved, round(p, 6) AS precision, round(r, 6) AS recall,
      round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1_score FROM e""",
)
def _(spark, sf):
    q, t = _topics(spark, sf)
    docs = documents(spark, sf).select("doc_id", "text")
    m = M.topic_metrics(X.bm25_search(q, docs, 5), docs, t)
    return m.select("query_id", "total_relevant", "relevant_retrieved", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")])


@query(
    "evaluate_topic_coverage",
    _TOPIC_HITS
    + """, tt AS (SELECT query_id, unnest(topics) AS topic FROM topics),
      f AS (SELECT DISTINCT h.query_id, t.topic FROM hits h JOIN tt t USING (query_id) JOIN documents d ON d.doc_id = h.doc_id WHERE contains(lower(d.text), t.topic)),
      c AS (SELECT q.query_id, len(topics) AS expected_count, (SELECT count(*) FROM f WHERE f.query_id = q.query_id) AS true_positives,
        (SELECT count(*) FROM hits h WHERE h.query_id = q.query_id) AS retrieved_count FROM topics q),
      e AS (SELECT *, CASE WHEN retrieved_count > 0 THEN true_positives / retrieved_count ELSE 0 END AS p, CASE WHEN expected_count > 0 THEN true_positives / expected_count ELSE 0 END AS r FROM c)
    SELECT query_id, expected_count, true_positives, retrieved_count, round(p, 6) AS precision, round(r, 6) AS recall,
      round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1_score FROM e""",
)
def _(spark, sf):
    q, t = _topics(spark, sf)
    docs = documents(spark, sf).select("doc_id", "text")
    m = M.topic_coverage(X.bm25_search(q, docs, 5), docs, t)
    return m.select(
        "query_id", "expected_count", "true_positives", "retrieved_count", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")]
    )


_GATE_METRICS = """g AS (SELECT CASE event_type WHEN 'signup' THEN 'faithfulness' WHEN 'click' THEN 'answer_relevancy' WHEN 'view' THEN 'context_precision'
    WHEN 'purchase' THEN 'answer_correctness' ELSE 'unknown' END AS metric, avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) / 60 AS score FROM events GROUP BY 1),
   t(metric, threshold) AS (VALUES ('faithfulness', 0.80::DOUBLE), ('answer_relevancy', 0.75::DOUBLE), ('context_precision', 0.70::DOUBLE), ('context_recall', 0.65::DOUBLE), ('answer_correctness', 0.70::DOUBLE)),
   c AS (SELECT metric, score, threshold, score >= threshold AS passed FROM g JOIN t USING (metric))"""


def _gate(spark, sf):
    e = table(spark, sf, "events")
    name = (
        F.when(F.col("event_type") == "signup", "faithfulness")
        .when(F.col("event_type") == "click", "answer_relevancy")
        .when(F.col("event_type") == "view", "context_precision")
        .when(F.col("event_type") == "purchase", "answer_correctness")
        .otherwise("unknown")
    )
    m = e.groupBy(name.alias("metric")).agg((F.avg(F.get_json_object("props", "$.k").cast("double")) / 60).alias("score"))
    t = spark.createDataFrame(list(fv.QUALITY_GATES.items()), "metric string, threshold double")
    return M.gate(m, t)


@query("evaluate_gate", f"WITH {_GATE_METRICS} SELECT metric, round(score, 6) AS score, threshold, passed FROM c")
def _(spark, sf):
    return _gate(spark, sf).select("metric", F.round("score", 6).alias("score"), "threshold", "passed")


@query(
    "evaluate_gate_result",
    f"WITH {_GATE_METRICS} SELECT bool_and(passed) AS passed, coalesce(string_agg(CASE WHEN NOT passed THEN metric END, ',' ORDER BY metric), '') AS failures FROM c",
)
def _(spark, sf):
    return M.gate_result(_gate(spark, sf))


@query(
    "evaluate_golden_answers",
    f"""WITH a AS (SELECT c.conv_id, c.turn, list_distinct({sql_words("lower(c.text)")}) AS a, list_distinct({sql_words("lower(n.text)")}) AS b
         FROM conversations c JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1),
      s AS (SELECT conv_id, CASE WHEN len(a) > 0 AND len(b) > 0 THEN 0.4::DOUBLE * len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))
        + 0.6::DOUBLE * len(list_intersect(a, b)) / len(b) ELSE 0 END AS s FROM a)
    SELECT conv_id, round(avg(s), 6) AS mean_score, count(*) AS n FROM s GROUP BY 1""",
)
def _(spark, sf):
    c = table(spark, sf, "conversations")
    a = c.select(F.struct("conv_id", "turn").alias("key"), F.col("text").alias("answer"))
    g = c.select(F.struct("conv_id", (F.col("turn") - 1).alias("turn")).alias("key"), F.col("text").alias("ground_truth"))
    s = M.answer_scores(a, g, key="key")
    return s.groupBy(F.col("key.conv_id").alias("conv_id")).agg(F.round(F.avg("score"), 6).alias("mean_score"), F.count(F.lit(1)).alias("n"))
