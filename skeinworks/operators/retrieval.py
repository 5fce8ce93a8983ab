"""Hybrid retrieval, reranking and multi-step search over tables of queries and documents.

Queries are rows (query_id, query, q_vec), documents rows (doc_id, text, d_vec, metadata).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as fv, queries as Q, text as T
from ..session import cut_lineage
from .filters import best_scored, metadata_filter
from .lexical import bm25_weights, query_terms, synonym_expansion, triggered_expansion
from .logs import context_budget
from .vector import rank_top, scored_top_k


def _bm25_queries(queries: DataFrame, alpha: float | str, *, terms_from: Column | None = None) -> DataFrame:
    source = terms_from if terms_from is not None else T.words(F.lower(F.col("query")))
    return queries.select(
        "query_id",
        (F.col(alpha) if isinstance(alpha, str) else F.lit(float(alpha))).alias("alpha"),
        F.lit(-2.0).alias("min_score"),
        "q_vec",
        query_terms(source).alias("q_terms"),
        *[c for c in ("same",) if c in queries.columns],
    )


def hybrid_search(queries: DataFrame, docs: DataFrame, k: int = 5, *, alpha: float | str = 0.5, **options) -> DataFrame:
    """alpha * cosine + (1 - alpha) * min(1, BM25 / 10), best k per query.

    `alpha` is a number or the name of a query column.
    """
    d = docs.select("doc_id", "d_vec", T.words(F.lower("text")).alias("terms"))
    return scored_top_k(_bm25_queries(queries, alpha), d, k, fields={"terms": 1.0}, **options)


def fielded_search(
    queries: DataFrame, docs: DataFrame, k: int = 10, *, alpha: float = 0.7, expand: bool = False,
    title: str = "title", content: str = "text", title_weight: float = 2.0, **options,
) -> DataFrame:
    """Hybrid search whose keyword part is the best field, titles counting double.

    With `expand`, the words of the triggered expansions join the query's own.
    """
    d = docs.select("doc_id", F.col(title).alias("_title"), F.col(content).alias("_content"), "d_vec")
    d = bm25_weights(bm25_weights(d, "_title", "title_terms"), "_content", "content_terms")
    terms = None
    if expand:
        terms = T.words(F.lower(F.array_join(triggered_expansion(F.col("query")), " ")))
    q = _bm25_queries(queries, alpha, terms_from=terms)
    return scored_top_k(q, d, k, fields={"title_terms": title_weight, "content_terms": 1.0}, **options)


def search(
    queries: DataFrame, docs: DataFrame, k: int = 10, *, kind: str = "hybrid", rerank: str = "score",
    filters: dict | None = None, group: str | None = None, boost: str | None = None,
) -> DataFrame:
    """Hybrid, semantic or keyword search, fetched twice as deep as asked, reranked and cut.

    Filters hold for every kind of search.
    """
    alpha = {"hybrid": 0.7, "semantic": 1.0, "keyword": 0.0}[kind]
    picked = metadata_filter(docs, filters or {})
    found = fielded_search(queries, picked, 2 * k, alpha=alpha)
    extra = [c for c in (group, boost) if c]
    if extra:
        found = found.join(docs.select("doc_id", *extra), "doc_id")
    ranked = rerank_results(found, rerank, group=group, boost=boost)
    return ranked.where(F.col("rank") <= k)


def rerank_results(df: DataFrame, method: str, *, group: str | None = None, boost: str | None = None) -> DataFrame:
    """New rank per query: by score, by first hit of each group, or by score + 0.01 * boost."""
    if method == "score":
        order = [F.desc("score"), F.col("rank")]
    elif method == "diversity":
        nth = F.row_number().over(Window.partitionBy("query_id", group).orderBy("rank"))
        df = df.withColumn("_again", nth > 1)
        order = [F.col("_again"), F.col("rank")]
    elif method == "recency":
        order = [(F.col("score") + 0.01 * F.coalesce(F.col(boost), F.lit(0))).desc(), F.col("rank")]
    else:
        return df
    new = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return df.withColumn("rank", new).drop("_again")


def rerank_by_metadata(df: DataFrame, column: str, preferred, k: int = 5) -> DataFrame:
    """Rows with the preferred value first, otherwise in the old order."""
    liked = F.coalesce(F.col(column) == preferred, F.lit(False))
    new = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(liked), "rank"))
    return df.withColumn("rank", new).where(F.col("rank") <= k)


def _max_min_order(sets: list[frozenset], k: int) -> list[int]:
    """Greedy order: the first, then always the one whose nearest chosen neighbour is farthest."""
    if len(sets) <= 1:
        return list(range(len(sets)))

    def distance(a, b):
        return 1 - len(a & b) / max(len(a | b), 1)

    chosen, rest = [0], list(range(1, len(sets)))
    near = {i: distance(sets[i], sets[0]) for i in rest}
    while rest and len(chosen) < k:
        best = max(rest, key=lambda i: (near[i], -i))
        chosen.append(best)
        rest.remove(best)
        for i in rest:
            near[i] = min(near[i], distance(sets[i], sets[best]))
    return chosen


def rerank_by_diversity(df: DataFrame, text: str = "text", k: int = 5, *, candidates: int = 10) -> DataFrame:
    """Greedy max-min diversity of word sets among the retrieved candidates of each query.

    Works on the few rows a search returned, at most `candidates` per query.
    """
    small = df.where(F.col("rank") <= candidates)
    packed = small.groupBy("query_id").agg(
        F.sort_array(
            F.collect_list(F.struct("rank", "doc_id", F.array_distinct(T.words(F.lower(F.col(text)))).alias("ws")))
        ).alias("hits")
    )

    @F.pandas_udf("array<int>")
    def order(batch: pd.Series) -> pd.Series:
        return pd.Series([_max_min_order([frozenset(h["ws"]) for h in hits], k) for hits in batch])

    picked = packed.select("query_id", "hits", order(F.transform("hits", lambda h: h)).alias("o"))
    ranks = picked.select("query_id", F.posexplode_outer("o").alias("p", "i"), "hits").select(
        "query_id", (F.col("p") + 1).alias("rank"), F.get("hits", F.col("i"))["doc_id"].alias("doc_id")
    )
    return df.drop("rank").join(ranks, ["query_id", "doc_id"])


def rerank_by_listing(df: DataFrame, listing: DataFrame, k: int = 5) -> DataFrame:
    """Apply an outside ranking text such as "3, 1, 5" per query; rows it omits follow in old order.

    `listing` has query_id and ranking. Only bare numbers within range count, first mention wins.
    """
    cut = F.filter(F.split(F.regexp_replace("ranking", ",", " "), fv.SPACE + "+"), lambda x: x.rlike(r"^\p{Nd}+$"))
    places = listing.select("query_id", F.posexplode_outer(cut).alias("pos", "n")).where(F.col("n").isNotNull())
    first = places.groupBy("query_id", F.col("n").cast("int").alias("rank")).agg(F.min("pos").alias("pos"))
    joined = df.join(first, ["query_id", "rank"], "left")
    new = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.coalesce("pos", F.lit(2**31 - 1)), "rank")
    )
    return joined.withColumn("rank", new).where(F.col("rank") <= k).drop("pos")


def full_search(
    queries: DataFrame, docs: DataFrame, k: int = 5, *, expand: bool = True, rerank: str = "diversity",
    alpha: float = 0.6, fetch: int = 10, level: str = "level", preferred: str = "section",
) -> DataFrame:
    """Synonyms, hybrid search for `fetch` rows, reranking to k."""
    q = queries.withColumn("query", synonym_expansion(F.col("query"))) if expand else queries
    found = hybrid_search(q, docs, fetch, alpha=alpha)
    kept = ["doc_id", "text", *([level] if rerank == "metadata" else [])]
    full = found.join(docs.select(*kept), "doc_id")
    if rerank == "diversity":
        return rerank_by_diversity(cut_lineage(full), "text", k, candidates=fetch)  # it reads them twice
    if rerank == "metadata":
        return rerank_by_metadata(full, level, preferred, k)
    return full.where(F.col("rank") <= k)


def grounded_retrieval(
    queries: DataFrame, docs: DataFrame, *, max_results: int = 5, min_score: float = 0.5, alpha: float | str = 0.7,
    max_tokens: int = 3000, **options,
) -> DataFrame:
    """Hybrid hits twice as deep, those above the limit, cut to the context budget, with counts."""
    found = cut_lineage(hybrid_search(queries, docs, 2 * max_results, alpha=alpha, **options))  # read twice below
    totals = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("total_found"))
    good = best_scored(
        found.drop("rank"), "score", min_score=min_score, limit=max_results, by=["query_id"], tie=["doc_id"]
    )
    counts = good.groupBy("query_id").agg(F.count(F.lit(1)).alias("filtered_count"))
    texts = good.join(docs.select("doc_id", "text"), "doc_id")
    fitted = context_budget(texts, "query_id", "rank", "text", max_tokens=max_tokens)
    # counted in place: the texts are looked up once
    returned = fitted.withColumn("_returned", F.count(F.lit(1)).over(Window.partitionBy("query_id")))
    sizes = totals.join(counts, "query_id", "left").na.fill(0)
    return returned.join(sizes, "query_id").withColumn("returned_count", F.col("_returned")).drop("_returned")


def prompt_texts(contexts: DataFrame, queries: DataFrame, *, system_context: str = "", group: str = "source", date: str | None = None) -> DataFrame:
    """Instruction, numbered sources in rank order and the question, one text per query."""
    tag = F.concat(
        F.lit("\n[Source "), F.col("rank").cast("string"),
        F.coalesce(F.concat(F.lit(" - r/"), F.col(group)), F.lit("")),
        F.coalesce(F.concat(F.lit(" - "), F.col(date).cast("string")), F.lit("")) if date else F.lit(""),
        F.lit("]\n"), F.col("text"), F.lit("\n"),
    )
    blocks = contexts.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", tag.alias("block")))).alias("b")
    )
    body = F.array_join(F.transform("b", lambda x: x["block"]), "")
    return blocks.join(queries.select("query_id", "query"), "query_id").select(
        "query_id", 
        F.concat(
            F.lit(fv.PROMPT_HEAD), body, F.lit(fv.PROMPT_RULES + system_context + "\n\nQuestion: "),
            F.col("query"), F.lit("\n\nAnswer:"),
        ).alias("prompt"),
    
    )


def claim_text(claim_id, customer, amount, text) -> Column:
    return F.format_string("Claim ID: %s, Customer ID: %s, Amount: $%s, Text: %s", claim_id, customer, amount, text)


def formatted_hits(hits: DataFrame, *, k: int = 5, chars: int = 500) -> DataFrame:
    """The first k hits of each query as JSON with rank, score, shortened text and metadata defaults."""
    row = F.struct(
        F.col("rank"),
        F.col("score").alias("relevance_score"),
        F.substring("text", 1, chars).alias("text"),
        F.struct(
            F.coalesce(F.col("level"), F.lit("unknown")).alias("level"),
            F.coalesce(F.col("title"), F.lit("")).alias("title"),
        ).alias("metadata"),
    )
    few = hits.where(F.col("rank") <= k)
    return few.groupBy("query_id").agg(F.to_json(F.sort_array(F.collect_list(row))).alias("hits_json"))


def alpha_sweep(queries: DataFrame, docs: DataFrame, alphas: list[float], k: int = 3, **options) -> DataFrame:
    """The same queries under several alphas in one pass over the documents."""
    # the rows of one query have one number, by which the kernel knows them
    swept = queries.withColumn("same", F.monotonically_increasing_id()).withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))
    key = F.concat_ws("|", F.col("query_id").cast("string"), F.col("alpha").cast("string"))
    named = swept.withColumn("_orig", F.col("query_id")).withColumn("query_id", key)
    found = hybrid_search(named, docs, k, alpha="alpha", **options)
    back = named.select("query_id", "_orig", "alpha")
    return found.join(back, "query_id").drop("query_id").withColumnRenamed("_orig", "query_id")


def compared_methods(queries: DataFrame, docs: DataFrame, k: int = 5) -> DataFrame:
    """Keyword, semantic and hybrid results side by side: mean score, overlap with hybrid."""
    swept = alpha_sweep(queries, docs, [0.0, 0.5, 1.0], k)
    name = F.when(F.col("alpha") == 0.0, "keyword").when(F.col("alpha") == 1.0, "semantic").otherwise("hybrid")
    tagged = swept.withColumn("method", name)
    pair = Window.partitionBy("query_id", "doc_id")  # at most one row per method
    shared = F.max((F.col("method") == "hybrid").cast("int")).over(pair)
    return (
        tagged.withColumn("in_hybrid", shared)
        .groupBy("method")
        .agg(
            F.count(F.lit(1)).alias("results"),
            F.count_distinct("query_id").alias("queries"),
            F.avg("score").alias("mean_score"),
            F.avg("in_hybrid").alias("share_in_hybrid"),
        )
    )


def tested_strategies(queries: DataFrame, docs: DataFrame, strategies: list[tuple] = tuple(fv.STRATEGIES), *, sources: int = 5) -> DataFrame:
    """Number of sources each strategy (name, alpha, min_score) keeps per query. Alpha is applied."""
    swept = alpha_sweep(queries, docs, sorted({a for _, a, _ in strategies}), 2 * sources)
    spec = queries.sparkSession.createDataFrame(list(strategies), "strategy string, alpha double, min_score double")
    kept = swept.join(F.broadcast(spec), "alpha").where(
        (F.col("score") >= F.col("min_score")) & (F.col("rank") <= sources)
    )
    every = queries.select("query_id").withColumn("strategy", F.explode(F.array(*[F.lit(s) for s, _, _ in strategies])))
    counts = kept.groupBy("query_id", "strategy").agg(F.count(F.lit(1)).alias("num_sources"))
    return every.join(counts, ["query_id", "strategy"], "left").na.fill(0, ["num_sources"])


def step_entities(hits: DataFrame, *, top: int = 3, most: int = 5) -> DataFrame:
    """Entities of the first hits of each query, first seen first, at most `most` of a kind."""
    few = hits.where(F.col("rank") <= top).select(
        "query_id", "rank", *[T.entities("text", k).alias(k) for k in fv.ENTITY_PATTERNS]
    )
    packed = few.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", *fv.ENTITY_PATTERNS))).alias("h")
    )

    def merged(kind):
        return F.slice(F.array_distinct(F.flatten(F.transform("h", lambda x: x[kind]))), 1, most).alias(kind)

    return packed.select("query_id", *[merged(k) for k in fv.ENTITY_PATTERNS])


def multi_step_search(
    queries: DataFrame, docs: DataFrame, *, encode=None, best: int = 10, per_step: int = 5
) -> DataFrame:
    """Classify, split, search every step, and keep the best distinct hits of each query.

    Independent steps of all queries are searched together. A step that depends on the one
    before it is searched in a later round, with the names, places and dates of that step's
    hits appended; there are as many rounds as the longest query has steps, each written out
    before the next.
    `queries` may bring its own `steps` (array<struct<query, dependent>>); `encode` turns a
    DataFrame with `query` into one with `q_vec`, else the query's own vector serves its steps.
    """
    given = "steps" in queries.columns
    steps = F.col("steps") if given else Q.decompose(F.col("query"))
    flat = queries.select(
        F.col("query_id").alias("origin"),
        *([] if encode else ["q_vec"]),
        F.posexplode_outer(steps).alias("step", "s"),
    ).where(F.col("step").isNotNull())
    flat = flat.select(
        F.concat_ws("#", F.col("origin").cast("string"), F.col("step").cast("string")).alias("query_id"),
        "origin", "step", *([] if encode else ["q_vec"]),
        F.col("s.query").alias("asked"), F.col("s.dependent").alias("dependent"),
    )

    def run(some: DataFrame) -> DataFrame:
        ready = some.withColumn("query", Q.transformed(F.col("asked")))
        if encode:
            ready = encode(ready)
        hits = full_search(ready, docs, per_step)
        return hits.join(some.select("query_id", "origin", "step"), "query_id")

    results = run(flat.where(~F.col("dependent")))
    if given:
        results = cut_lineage(results)
        last = flat.where("dependent").agg(F.max("step")).first()[0]
        for at in range(1, (last or 0) + 1):
            waiting = flat.where(F.col("dependent") & (F.col("step") == at))
            before = results.where(F.col("step") == at - 1).select(F.col("origin").alias("query_id"), "rank", "text")
            seen = step_entities(before).withColumnRenamed("query_id", "origin")
            told = waiting.join(seen, "origin", "left").withColumn(
                "asked", Q.resolved(F.col("asked"), F.col("names"), F.col("places"), F.col("dates"))
            )
            results = cut_lineage(results.unionByName(run(told.select(*flat.columns))))
    from .scoring import first_of_prefix

    unique = first_of_prefix(results, ["origin"], "text", ["step", "rank"])
    top = unique.drop("query_id", "rank").withColumnRenamed("origin", "query_id")
    return rank_top(top, "query_id", "score", "doc_id", best)
