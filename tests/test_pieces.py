import numpy as np

from skeinworks.operators import vector as V


def test_small_blocks_do_not_copy_rows_once_a_block(spark, monkeypatch):
    g = np.random.default_rng(3)
    rows = [(i, [float(x) for x in g.normal(size=6)]) for i in range(200)]
    d = spark.createDataFrame(rows, "doc_id long, d_vec array<float>")
    q = d.withColumnsRenamed({"doc_id": "query_id", "d_vec": "q_vec"})
    spread = int(np.ceil(np.sqrt(4 * spark.sparkContext.defaultParallelism)))
    assert V._pieces(d, 2) == spread < 100 and V._pieces(d, 150) == 2 and V._pieces(d.limit(0), 2) == 1
    cuts, real = [], V._pieces
    monkeypatch.setattr(V, "_pieces", lambda *a: cuts.append(real(*a)) or cuts[-1])
    got = V.nearest(q, d, 3, small_side_bytes=0, block_rows=2, query_block_rows=2)
    assert cuts == [spread, spread]  # a row is copied so often, not once for each of 100 blocks
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, V.nearest(q, d, 3).collect()))
    monkeypatch.setattr(V, "SIDE_BYTES", 200 * (48 + 64) // 20)
    assert V._pieces(d, 2) == 20  # many bytes are cut further
