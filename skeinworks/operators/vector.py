"""Vector search: exact and cell-based nearest neighbours, similarity joins, quality measures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import ship

SMALL_SIDE_BYTES = 64 * 1024 * 1024


def dot(a, b) -> Column:
    """Inner product in double precision, inside the JVM."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.aggregate(
        F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y),
        F.lit(0.0),
        lambda s, x: s + x,
    )


def norm(v) -> Column:
    return F.sqrt(dot(v, v))


def unit(v) -> Column:
    """The vector scaled to length 1; a zero vector stays as it is."""
    v = F.col(v) if isinstance(v, str) else v
    n = norm(v)
    return F.when(n > 0, F.transform(v.cast("array<double>"), lambda x: x / n)).otherwise(v.cast("array<double>"))


def cosine(a, b) -> Column:
    """Cosine similarity, 0 when either vector has no length."""
    na, nb = norm(a), norm(b)
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb)).otherwise(F.lit(0.0))


# ---- scoring kernels: numpy over one Arrow batch or one block ---------------------------


def _vectors(col, width: int | None = None) -> np.ndarray:
    """A list column of equal-length vectors as a matrix of unit rows; a zero or missing one is a zero row."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.float64)
    there = col.is_valid().to_numpy(zero_copy_only=False)
    known = flat.reshape(int(there.sum()), -1) if there.any() else np.zeros((0, width or 1))
    m = np.zeros((len(col), known.shape[1]))
    m[there] = known
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def _terms(col) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row numbers, terms and weights of an array<struct<term, weight>> column."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    lengths = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(col)
    rows = np.repeat(np.arange(len(col)), lengths)
    return rows, flat.field("term"), flat.field("weight").to_numpy(zero_copy_only=False).astype(np.float64)


#: k1, b and the length of the plain BM25 weights of token lists.
PLAIN_BM25 = (1.5, 0.75, 100.0)


def _counted(col, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, places in `vocab` and plain BM25 weights of the known tokens of an array<string> column."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    lengths = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    at = pc.fill_null(pc.index_in(pc.list_flatten(col), vocab), -1).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(col)), lengths)
    known = at >= 0
    cells, times = np.unique(rows[known] * len(vocab) + at[known], return_counts=True)
    rows, at = np.divmod(cells, max(1, len(vocab)))
    k1, b, length = PLAIN_BM25
    return rows, at, times * (k1 + 1) / (times + (lengths[rows] * b / length + (1 - b)) * k1)


def _place(ids) -> np.ndarray:
    """Position of each id in sorted order: settles ties between equal scores."""
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    place = np.empty(len(ids), dtype=np.int64)
    place[pc.array_sort_indices(ids).to_numpy()] = np.arange(len(ids))
    return place


class _Queries:
    """Query vectors, weights and terms as arrays, ready to meet blocks of documents."""

    def __init__(self, q: pa.Table, fields: list[str], boosts: list[float]):
        self.ids = q["query_id"]
        self.n = q.num_rows
        self.alpha = q["alpha"].to_numpy().astype(np.float64)[:, None]
        self.floor = q["min_score"].to_numpy().astype(np.float64)[:, None]
        # rows that differ in alpha alone share the similarities of their first one
        self.rows = None
        if "same" in q.column_names:
            _, first, self.rows = np.unique(q["same"].to_numpy(), return_index=True, return_inverse=True)
            q = q.take(pa.array(first))
        self.asked = q.num_rows
        some = "q_vec" in q.column_names and q["q_vec"].null_count < q.num_rows
        self.vec = _vectors(q["q_vec"]) if some else None
        self.fields, self.boosts = fields, boosts
        if fields:
            rows, terms, weights = _terms(q["q_terms"])
            self.vocab = pc.unique(terms)
            self.weights = np.zeros((len(self.vocab), self.asked))
            np.add.at(self.weights, (pc.index_in(terms, self.vocab).to_numpy(zero_copy_only=False), rows), weights)

    def keyword(self, d) -> np.ndarray:
        """Best boosted field score of every (query, document)."""
        best = np.zeros((self.asked, d.num_rows))
        for f, boost in zip(self.fields, self.boosts):
            doc = np.zeros((d.num_rows, len(self.vocab)))
            if pa.types.is_string(d[f].type.value_type) or pa.types.is_large_string(d[f].type.value_type):
                rows, at, weights = _counted(d[f], self.vocab)
                doc[rows, at] = weights
            else:
                rows, terms, weights = _terms(d[f])
                at = pc.fill_null(pc.index_in(terms, self.vocab), -1).to_numpy(zero_copy_only=False)
                known = at >= 0
                np.add.at(doc, (rows[known], at[known]), weights[known])
            best = np.maximum(best, boost * (doc @ self.weights).T)
        return best

    def top(self, d, k: int, cap: float) -> pa.Table:
        """The k best documents of this block for every query."""
        n = d.num_rows
        sem = self.vec @ _vectors(d["d_vec"], self.vec.shape[1]).T if self.vec is not None else np.zeros((self.asked, n))
        kw = np.minimum(1.0, self.keyword(d) / cap) if self.fields else np.zeros((self.asked, n))
        if self.rows is not None:
            sem, kw = sem[self.rows], kw[self.rows]
        # equal scores are told apart by id, so sums that differ in the last bits must compare equal
        score = np.round(self.alpha * sem + (1 - self.alpha) * kw, 10)
        keep = min(k, n)
        limit = np.maximum(np.partition(score, n - keep, axis=1)[:, n - keep : n - keep + 1], self.floor)
        qi, di = np.nonzero(score >= limit)
        place = _place(d["doc_id"])
        order = np.lexsort((place[di], -score[qi, di], qi))
        qi, di = qi[order], di[order]
        first = np.searchsorted(qi, np.arange(self.n))
        mine = np.arange(len(qi)) - first[qi] < keep
        qi, di = qi[mine], di[mine]
        return pa.table(
            {
                "query_id": self.ids.take(pa.array(qi)),
                "doc_id": d["doc_id"].take(pa.array(di)),
                "score": score[qi, di],
                "semantic_score": sem[qi, di],
                "keyword_score": kw[qi, di],
            }
        )


def _met(q: pa.Table, d: pa.Table, k: int, fields: list[str], boosts: list[float], cap: float) -> Iterator[pa.Table]:
    """Two blocks against each other, in slices that keep the score matrix small: the k best of the block for each slice of queries."""
    for at in range(0, q.num_rows, 1024):
        side = _Queries(q.slice(at, 1024), fields, boosts)
        found = [side.top(d.slice(start, 4096), k, cap) for start in range(0, d.num_rows, 4096)]
        if found:
            yield found[0] if len(found) == 1 else _best_of(pa.concat_tables(found), k)


def _best_of(found: pa.Table, k: int) -> pa.Table:
    """The k best rows of each query, as `rank_top` orders them."""
    found = found.combine_chunks()
    ids = pc.fill_null(pc.dictionary_encode(found["query_id"].combine_chunks()).indices, -1).to_numpy()
    order = np.lexsort((_place(found["doc_id"]), -found["score"].to_numpy(), ids))
    ids = ids[order]
    return found.take(pa.array(order[np.arange(len(ids)) - np.searchsorted(ids, ids) < k]))


def _meet(q: pa.Table, d: pa.Table, k: int, fields: list[str], boosts: list[float], cap: float) -> pa.Table:
    """What `_met` finds, as one table."""
    parts = list(_met(q, d, k, fields, boosts, cap))
    if parts:
        return pa.concat_tables(parts)
    names = ("score", "semantic_score", "keyword_score")
    nothing = {n: pa.array([], pa.float64()) for n in names}
    return pa.table({"query_id": q["query_id"].slice(0, 0), "doc_id": d["doc_id"].slice(0, 0), **nothing})


_SCORES = "score double, semantic_score double, keyword_score double"


def scored_top_k(
    queries: DataFrame,
    docs: DataFrame,
    k: int,
    *,
    fields: dict[str, float] | None = None,
    keyword_cap: float = 10.0,
    block_rows: int = 32_768,
    query_block_rows: int = 4_096,
    small_side_bytes: int = SMALL_SIDE_BYTES,
) -> DataFrame:
    """The k best documents per query by alpha * cosine + (1 - alpha) * min(1, keyword / cap), exact.

    queries: query_id, alpha, min_score, and q_vec (vector) and/or q_terms
    (array<struct<term, weight>>). docs: doc_id, and d_vec and/or the term columns named in
    `fields` (array<struct<term, weight>>, or array<string>: tokens, weighed by plain BM25 where they meet the
    queries), mapped to their boosts; the best field counts. Queries that differ in alpha alone may share a number
    in the column `same`: their similarities are computed once.
    Where only vectors count, rows without one are left out; where keywords count too, a missing
    vector has cosine 0.

    When the queries fit in `small_side_bytes` they travel to the documents, which are then
    neither shuffled nor regrouped. Otherwise both sides are cut into pieces of at least `block_rows` and
    `query_block_rows`, as many more as SIDE_BYTES hold (`_pieces`), and every pair of pieces is met by itself, in
    slices. A row is shuffled once a piece of the other side. Either way a task keeps only k rows per query.
    """
    fields = fields or {}
    names, boosts = list(fields), list(fields.values())
    q = queries.select(*[c for c in ("query_id", "alpha", "min_score", "q_vec", "q_terms", "same") if c in queries.columns])
    with_vec = "q_vec" in q.columns
    d = docs.select("doc_id", *(["d_vec"] if with_vec else []), *names)
    if with_vec and not fields:
        q, d = q.where(F.col("q_vec").isNotNull()), d.where(F.col("d_vec").isNotNull())
    types = dict(q.dtypes) | dict(d.dtypes)
    schema = f"query_id {types['query_id']}, doc_id {types['doc_id']}, {_SCORES}"

    small = _small_side(q, small_side_bytes)
    if small is not None:
        shared = q.sparkSession.sparkContext.broadcast(small)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for found in _met(shared.value, pa.table(batch), k, names, boosts, keyword_cap):
                    yield from found.combine_chunks().to_batches()

        per_task = d.mapInArrow(run, schema)
    else:
        db, qb = _pieces(d, block_rows), _pieces(q, query_block_rows)
        dd = d.withColumn("_d", F.pmod(F.xxhash64("doc_id"), F.lit(db)).cast("int")).withColumn(
            "_q", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)))
        )
        qq = q.withColumn("_q", F.pmod(F.xxhash64("same" if "same" in q.columns else "query_id"), F.lit(qb)).cast("int")).withColumn(
            "_d", F.explode(F.sequence(F.lit(0), F.lit(db - 1)))
        )

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            return _meet(left, right, k, names, boosts, keyword_cap)

        dd = dd.toDF(*dd.columns)
        per_task = qq.groupBy("_q", "_d").cogroup(dd.groupBy("_q", "_d")).applyInArrow(meet, schema)
    return rank_top(per_task, "query_id", "score", "doc_id", k)


#: Bytes of a piece of a side that is shuffled to meet pieces of the other.
SIDE_BYTES = 64 << 20


def _pieces(side: DataFrame, block_rows: int) -> int:
    """Pieces to cut a side into: of SIDE_BYTES at most and enough for every core, but not of less than `block_rows` rows."""
    held = F.lit(0)
    for name, kind in side.dtypes:
        if kind.startswith("array"):
            held = held + F.coalesce(F.size(name), F.lit(0)) * (8 if kind in ("array<float>", "array<double>") else 96)
    n, held = side.agg(F.count(F.lit(1)), F.coalesce(F.sum(held.cast("long") + 64), F.lit(0))).first()
    spread = int(np.ceil(np.sqrt(4 * side.sparkSession.sparkContext.defaultParallelism)))
    return max(1, min(-(-n // block_rows), max(spread, -(-held // SIDE_BYTES))))


def fits(df: DataFrame, row_bytes: Column, limit: int = SMALL_SIDE_BYTES) -> bool:
    """Whether a side is provably small: its bytes are summed up on the cluster, no row is fetched."""
    total = df.agg(F.sum(row_bytes.cast("long") + 64)).first()[0] or 0
    return total <= limit


def _small_side(q: DataFrame, limit: int) -> pa.Table | None:
    """The queries as one Arrow table when they are provably small, else nothing."""
    size = F.lit(0)
    if "q_vec" in q.columns:
        size = size + F.coalesce(F.size("q_vec"), F.lit(0)) * 8
    if "q_terms" in q.columns:
        size = size + F.coalesce(F.size("q_terms"), F.lit(0)) * 96
    return q.toArrow() if fits(q, size, limit) else None


def rank_top(df: DataFrame, query: str, score: str, tie: str, k: int) -> DataFrame:
    """The k best rows per query with their rank; tasks cut to k before the shuffle."""
    w = Window.partitionBy(query).orderBy(F.desc(score), tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def as_vector_queries(df: DataFrame, id_col: str, vec: str, *, min_score: float = -2.0) -> DataFrame:
    return df.select(
        F.col(id_col).alias("query_id"),
        F.lit(1.0).alias("alpha"),
        F.lit(float(min_score)).alias("min_score"),
        F.col(vec).alias("q_vec"),
    )


def nearest(
    queries: DataFrame, docs: DataFrame, k: int = 10, *, min_score: float = -2.0, filters: dict | None = None, **options
) -> DataFrame:
    """Exact cosine neighbours of (query_id, q_vec) among (doc_id, d_vec), best k.

    `filters` apply to the documents before any score is computed.
    """
    from .filters import metadata_filter

    picked = metadata_filter(docs, filters or {})
    out = scored_top_k(as_vector_queries(queries, "query_id", "q_vec", min_score=min_score), picked, k, **options)
    return out.select("query_id", "doc_id", F.col("score").alias("similarity"), "rank")


def nearest_in_indices(queries: DataFrame, docs: DataFrame, index: str, wanted: list | None = None, k: int = 10, **options) -> DataFrame:
    """Search several indices (values of a metadata column) at once, hits tagged with their index.

    The k best of each index, merged and cut to k, are the k best over all chosen indices, so
    one pass over the documents of those indices is enough.
    """
    found = nearest(queries, docs, k, filters={index: wanted} if wanted else None, **options)
    return found.join(docs.select("doc_id", F.col(index).alias("index_name")), "doc_id")


# ---- cells: approximate search ----------------------------------------------------------


def cell_centres(docs: DataFrame, *, cells: int = 100, seed: int = 7, iterations: int = 10) -> DataFrame:
    """Centres (cell, centre) of k-means cells over (doc_id, d_vec)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    features = docs.select(array_to_vector(unit("d_vec")).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=iterations).fit(features)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return docs.sparkSession.createDataFrame(rows, "cell int, centre array<double>")


def nearest_cells(df: DataFrame, id_col: str, vec: str, centres: list, probes: int) -> DataFrame:
    """(id, vector, cell, angle) for the `probes` centres closest to each vector.

    The centres are a number of short rows fixed by the caller, so they travel with the task.
    """
    mat = _unit_rows(np.array([r["centre"] for r in centres]))
    cells = np.array([r["cell"] for r in centres], dtype=np.int32)
    kinds = dict(df.dtypes)
    schema = f"{id_col} {kinds[id_col]}, {vec} {kinds[vec]}, cell int, angle double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.table(b)
            sim = _vectors(t[vec]) @ mat.T
            near = np.argsort(-sim, axis=1, kind="stable")[:, :probes]
            rows = np.repeat(np.arange(t.num_rows), near.shape[1])
            out = t.take(pa.array(rows))
            angle = np.arccos(np.clip(sim[rows, near.ravel()], -1.0, 1.0))
            yield from (
                out.append_column("cell", pa.array(cells[near.ravel()]))
                .append_column("angle", pa.array(angle))
                .to_batches()
            )

    return df.select(id_col, vec).where(F.col(vec).isNotNull()).mapInArrow(run, schema)


def _unit_rows(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def nearest_by_cells(
    queries: DataFrame,
    docs: DataFrame,
    k: int = 10,
    *,
    cells: int = 100,
    probes: int = 8,
    seed: int = 7,
    piece_rows: int = 100_000,
    centres: DataFrame | None = None,
) -> DataFrame:
    """Approximate neighbours: only documents in the cells nearest to the query are scored.

    A cell with many documents is split into pieces of about `piece_rows`, and the queries
    probing it are copied to each piece; all its documents are still scored.
    """
    centre_rows = (centres if centres is not None else cell_centres(docs, cells=cells, seed=seed)).collect()
    placed = nearest_cells(docs, "doc_id", "d_vec", centre_rows, 1)
    # one short row per cell
    pieces = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / piece_rows).cast("int").alias("pieces"))
    d = placed.join(pieces, "cell").withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int"))
    probing = nearest_cells(queries, "query_id", "q_vec", centre_rows, probes)
    q = (
        probing.join(pieces, "cell")
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select("query_id", "q_vec", "cell", "piece", F.lit(1.0).alias("alpha"), F.lit(-2.0).alias("min_score"))
    )
    types = dict(queries.dtypes) | dict(docs.dtypes)
    schema = f"query_id {types['query_id']}, doc_id {types['doc_id']}, {_SCORES}"

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return _meet(left, right, k, [], [], 1.0)

    d = d.toDF(*d.columns)
    scored = q.groupBy("cell", "piece").cogroup(d.groupBy("cell", "piece")).applyInArrow(meet, schema)
    best = rank_top(scored, "query_id", "score", "doc_id", k)
    return best.select("query_id", "doc_id", F.col("score").alias("similarity"), "rank")


def recall_against(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours an approximate search found, over all queries."""
    hit = exact.select("query_id", "doc_id").join(
        found.select("query_id", "doc_id").withColumn("hit", F.lit(1)), ["query_id", "doc_id"], "left"
    )
    return hit.agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"), F.count(F.lit(1)).alias("expected"))


# ---- similarity join and matrix -----------------------------------------------------------


#: A task of a similarity join holds about so many bytes of vectors of each side.
PIECE_BYTES = 16 << 20


def _rows_per_piece(docs: DataFrame, piece_bytes: int) -> tuple[int, int]:
    """(rows with a vector, rows of a piece) for vectors of eight-byte numbers."""
    n, width = docs.where("d_vec is not null").agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("d_vec")), F.lit(1))).first()
    return n, max(1, piece_bytes // (8 * max(1, width)))


def grid(rows: DataFrame, pieces: Column) -> tuple[DataFrame, DataFrame]:
    """(left, right) with `pa` <= `pb`: rows in `pieces` pieces per key, so that every two pieces meet once.

    A row of piece p goes left to the pieces from p on and right to those up to p: one copy more than there
    are pieces, whose number is the root of twice the tasks.
    """
    placed = rows.withColumn("_n", pieces).withColumn("_p", F.pmod(F.xxhash64("doc_id"), F.col("_n")).cast("int"))
    left = placed.withColumn("pa", F.col("_p")).withColumn("pb", F.explode(F.sequence(F.col("_p"), F.col("_n") - 1)))
    right = placed.withColumn("pb", F.col("_p")).withColumn("pa", F.explode(F.sequence(F.lit(0), F.col("_p"))))
    return left.drop("_n", "_p"), right.select(*left.drop("_n", "_p").columns)


#: Similarities that a task of a similarity join holds at once.
CELLS = 1 << 20


def _meet_pieces(left: DataFrame, right: DataFrame, keys: list[str], min_similarity: float, once=None) -> DataFrame:
    """(i, j, similarity) of the rows of two pieces that are alike enough; `once` may reject pairs of row numbers.

    A task holds the two pieces and CELLS similarities, and gives the pairs out as they are found, however many.
    """
    ship(left.sparkSession)
    kind = dict(left.dtypes)["doc_id"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pa.Table.from_batches(batches)
        is_left = both["_left"]
        a, b = both.filter(is_left), both.filter(pc.invert(is_left))
        if not a.num_rows or not b.num_rows:
            return
        same = a["pa"][0].as_py() == a["pb"][0].as_py()
        right_m, right_ids = _vectors(b["d_vec"]), b["doc_id"]
        step = max(1, CELLS // b.num_rows)
        for at in range(0, a.num_rows, step):
            part = a.slice(at, step)
            sim = np.round(_vectors(part["d_vec"]) @ right_m.T, 10)
            x, y = np.nonzero(sim >= min_similarity)
            if once is not None:
                first = once(part, b, x, y)
                x, y = x[first], y[first]
            i, j = part["doc_id"].take(pa.array(x)), right_ids.take(pa.array(y))
            swap = pc.greater(i, j)
            t = pa.table({"i": pc.if_else(swap, j, i), "j": pc.if_else(swap, i, j), "similarity": sim[x, y]})
            yield from (t.filter(pc.invert(swap)) if same else t).combine_chunks().to_batches(max_chunksize=65_536)

    both = left.withColumn("_left", F.lit(True)).unionByName(right.withColumn("_left", F.lit(False)))
    return both.groupBy(*keys, "pa", "pb").applyInArrow(meet, f"i {kind}, j {kind}, similarity double")


def similar_pairs(docs: DataFrame, *, min_similarity: float = 0.8, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """All pairs (i <= j, diagonal included) at least `min_similarity` alike, exactly.

    The rows are cut into pieces and every two pieces meet in a task, which emits only the pairs above the
    limit. That is all pairs' work, in any dimension and for any limit; for a high limit over many rows
    `similar_pairs_banded` does far less. Rows without a vector are left out, zero vectors are like nothing.
    """
    n, size = _rows_per_piece(docs, piece_bytes)
    rows = docs.select("doc_id", "d_vec").where("d_vec is not null")
    spread = int(np.ceil(np.sqrt(2 * docs.sparkSession.sparkContext.defaultParallelism))) if n > 1024 else 1
    return _meet_pieces(*grid(rows, F.lit(max(1, -(-n // size), spread))), [], min_similarity)


def bands_for(min_similarity: float, recall: float, most: int = 64) -> tuple[int, int]:
    """(bands, bits of a band): the longest bands of which `most` find a pair of just the limit with chance `recall`.

    One random hyperplane leaves two vectors on the same side with chance 1 - angle / pi.
    """
    p = 1 - float(np.arccos(np.clip(min_similarity, -1.0, 1.0))) / np.pi
    found = (most, 1)
    for bits in range(1, 31):
        hit = p**bits
        bands = 1 if hit >= recall else int(np.ceil(np.log(1 - recall) / np.log1p(-hit)))
        if bands > most:
            break
        found = (bands, bits)
    return found


def similar_pairs_banded(
    docs: DataFrame, *, min_similarity: float = 0.9, recall: float = 0.97, seed: int = 7, piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """Pairs (i <= j, diagonal included) at least `min_similarity` alike: at least `recall` of them, none wrongly.

    Random hyperplanes give each row a few bits in each of several bands; rows that agree on a band meet,
    and their similarity is computed exactly. The stated recall is the expected one for pairs of just the
    limit; more similar pairs are found more often. A bucket of many rows is cut into pieces of which every
    two meet, so none is dropped. A pair that agrees on several bands is emitted by the first one only.
    Zero vectors are like nothing, and are left out as rows without a vector are.
    """
    bands, bits = bands_for(min_similarity, recall)
    _, size = _rows_per_piece(docs, piece_bytes)
    kinds = dict(docs.dtypes)
    ship(docs.sparkSession)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for b in batches:
            v = _vectors(b["d_vec"])
            if planes is None:
                planes = np.random.default_rng(seed).standard_normal((v.shape[1], bands * bits))
            side = (v @ planes > 0).reshape(len(v), bands, bits)
            keys = (side << np.arange(bits)).sum(2).astype(np.int64)
            some = np.flatnonzero(np.abs(v).sum(1) > 0)
            t = pa.table(b).select(["doc_id", "d_vec"]).append_column("keys", pa.array(list(keys), pa.list_(pa.int64())))
            yield from t.take(pa.array(some)).to_batches()

    rows = docs.select("doc_id", "d_vec").where("d_vec is not null")
    rows = rows.mapInArrow(keyed, f"doc_id {kinds['doc_id']}, d_vec {kinds['d_vec']}, keys array<bigint>")
    placed = rows.select("doc_id", "d_vec", "keys", F.posexplode("keys").alias("band", "key"))
    full = rows.select(F.posexplode("keys").alias("band", "key")).groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = placed.join(full, ["band", "key"])

    def once(a: pa.Table, b: pa.Table, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        ka, kb = (np.asarray(t["keys"].combine_chunks().flatten()).reshape(t.num_rows, -1) for t in (a, b))
        band, out = a["band"][0].as_py(), np.ones(len(x), bool)
        for k in range(band):
            out &= ka[x, k] != kb[y, k]
        return out

    left, right = grid(placed.withColumn("_pieces", F.ceil(F.col("n") / size).cast("int")), F.col("_pieces"))
    near = _meet_pieces(left, right, ["band", "key"], min_similarity, once).where("i != j")
    alone = rows.select(F.col("doc_id").alias("i"), F.col("doc_id").alias("j"), F.lit(1.0).alias("similarity"))
    return near.union(alone.where(F.lit(min_similarity) <= 1.0))


def pair_moments(docs: DataFrame, vec: str = "d_vec") -> DataFrame:
    """Count, mean and population deviation of the cosine over all unordered pairs, without pairs.

    With unit vectors v, the sum over pairs of v.w is (|S|^2 - n) / 2 for S = sum v, and the sum
    of squares is (|M|^2 - n) / 2 for M = sum v v'. Each task adds up its own S and M.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, m = 0, None, None
        for b in batches:
            if b.num_rows:
                v = _vectors(b["v"])
                n += len(v)
                s = v.sum(axis=0) if s is None else s + v.sum(axis=0)
                m = v.T @ v if m is None else m + v.T @ v
        if n:
            for cell, x in (("n", np.array([float(n)])), ("s", s), ("m", m.ravel())):
                yield pa.record_batch(
                    {
                        "cell": pa.array([cell] * len(x)),
                        "place": pa.array(np.arange(len(x), dtype=np.int32)),
                        "x": pa.array(x),
                    }
                )

    cells = docs.select(F.col(vec).alias("v")).where("v is not null").mapInArrow(partial, "cell string, place int, x double")
    sums = cells.groupBy("cell", "place").agg(F.sum("x").alias("x"))
    t = sums.agg(
        F.sum(F.when(F.col("cell") == "n", F.col("x"))).alias("n"),
        F.sum(F.when(F.col("cell") == "s", F.col("x") * F.col("x"))).alias("s2"),
        F.sum(F.when(F.col("cell") == "m", F.col("x") * F.col("x"))).alias("m2"),
    )
    pairs = F.col("n") * (F.col("n") - 1) / 2
    d = t.select(
        F.col("n").cast("long").alias("n"),
        pairs.cast("long").alias("pairs"),
        ((F.col("s2") - F.col("n")) / 2 / pairs).alias("mean_similarity"),
        ((F.col("m2") - F.col("n")) / 2 / pairs).alias("_sq"),
    )
    var = F.greatest(F.lit(0.0), F.col("_sq") - F.col("mean_similarity") * F.col("mean_similarity"))
    return d.withColumn("std_similarity", F.sqrt(var)).drop("_sq")


def embedding_quality(docs: DataFrame, id_col: str = "doc_id", vec: str = "d_vec") -> DataFrame:
    """Neighbour similarity, distant similarity, their contrast, clustering and spread, over all rows.

    Neighbours are consecutive in id order; the distant partner of a row is a third of the
    table further on plus a shift of up to another third taken from the md5 of its rank.
    """
    from .filters import hash_number
    from .running import global_rank

    ranked = global_rank(docs.select(id_col, F.col(vec).alias("v")), id_col)
    n = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    base = ranked.withColumn("_n", n).select(
        F.col("rank0"), "v", "_n", F.floor(F.col("_n") / 3).cast("long").alias("_third")
    )
    shift = F.pmod(hash_number(F.col("rank0").cast("string")), F.greatest(F.col("_third"), F.lit(1)))
    far = F.pmod(F.col("rank0") + F.col("_third") + shift, F.col("_n"))
    links = base.select(
        "v",
        F.explode(
            F.array(
                F.struct(F.lit("next").alias("kind"), (F.col("rank0") + 1).alias("to")),
                F.struct(F.lit("far").alias("kind"), far.alias("to")),
            )
        ).alias("l"),
    ).select("v", "l.kind", "l.to")
    other = ranked.select(F.col("rank0").alias("to"), F.col("v").alias("w"))
    sims = links.join(other, "to").withColumn("sim", cosine("v", "w"))
    flat = sims.agg(
        F.avg(F.when(F.col("kind") == "next", F.col("sim"))).alias("avg_similar"),
        F.avg(F.when(F.col("kind") == "far", F.col("sim"))).alias("avg_dissimilar"),
        F.count_if(F.col("kind") == "next").alias("num_similar_pairs"),
        F.count_if(F.col("kind") == "far").alias("num_dissimilar_pairs"),
    )
    m = pair_moments(docs, vec)
    return flat.select(
        "*",
        (F.col("avg_similar") - F.col("avg_dissimilar")).alias("contrast"),
        (F.col("avg_similar") - m.select("mean_similarity").scalar()).alias("clustering_quality"),
        m.select("std_similarity").scalar().alias("relevance_score"),
    )


def historical_matches(claims: DataFrame, docs: DataFrame, k: int = 3, *, min_score: float = -2.0) -> DataFrame:
    """Texts of the k most similar past documents per claim, or one notice row."""
    from ..functions.fixed_values import NO_MATCH_NOTICE

    found = nearest(claims, docs, k, min_score=min_score).join(docs.select("doc_id", "text"), "doc_id")
    out = claims.select("query_id").join(found.select("query_id", "rank", "doc_id", "text"), "query_id", "left")
    return out.select(
        "query_id",
        F.coalesce("rank", F.lit(1)).alias("rank"),
        "doc_id",
        F.coalesce("text", F.lit(NO_MATCH_NOTICE)).alias("text"),
    )


def hashing_encoder(df: DataFrame, text: str, *, dims: int = 256, out: str = "embedding"):
    """A stand-in encoder: hashed word counts weighted by rarity, scaled to length 1.

    Returns the encoded DataFrame and the fitted stages, to encode queries the same way.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    from ..functions.text import tokens

    prepared = df.withColumn("_tokens", tokens(text))
    stages = [
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dims),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
    ]
    model = Pipeline(stages=stages).fit(prepared)

    def encode(d: DataFrame) -> DataFrame:
        got = model.transform(d.withColumn("_tokens", tokens(text)))
        return got.withColumn(out, vector_to_array("_unit", "float32")).drop("_tokens", "_tf", "_idf", "_unit")

    return encode(df), encode


def encode_with(df: DataFrame, text: str, encoder, *, dims: int, max_chars: int | None = None, out: str = "embedding") -> DataFrame:
    """Run a user's batch encoder (list of texts -> list of vectors) and record how it went.

    When a batch fails its texts are tried one by one; those that fail get zeros and the status `failed`, so that
    a later run can find them. A vector of another length than `dims` counts as a failure.
    """
    from ..session import ship

    ship(df.sparkSession)
    body = F.substring(text, 1, max_chars) if max_chars else F.col(text)
    schema = f"struct<{out}: array<float>, status: string>"

    def checked(texts: list) -> list[list[float]]:
        got = [list(map(float, v)) for v in encoder(texts)]
        if len(got) != len(texts) or any(len(v) != dims for v in got):
            raise ValueError("the encoder gave vectors of another number or length")
        return got

    def one(x) -> tuple[list[float], str]:
        try:
            return checked([x])[0], "completed"
        except Exception:  # noqa: BLE001
            return [0.0] * dims, "failed"

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = list(b)
            try:
                done = [(v, "completed") for v in checked(texts)]
            except Exception:  # noqa: BLE001
                done = [one(x) for x in texts]
            yield pd.DataFrame({out: [v for v, _ in done], "status": [s for _, s in done]})

    return df.withColumn("_e", run(body)).select(*df.columns, f"_e.{out}", "_e.status")


def word_hash_encoder(dims: int):
    """A stand-in for a neural encoder, for `encode_with`: hashed words, length 1; a text without words is refused."""

    def encode(texts: list[str]) -> list[list[float]]:
        from zlib import crc32

        rows = np.zeros((len(texts), dims))
        for row, x in zip(rows, texts):
            words = x.lower().split()
            if not words:
                raise ValueError("no words")
            np.add.at(row, [crc32(w.encode()) % dims for w in words], 1.0)
        return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).tolist()

    return encode
