import os

from skeinworks.operators import build as B
from skeinworks.operators.vector import word_hash_encoder
from skeinworks.sources import versions as VS


def test_a_run_leaves_only_its_tables(spark, tmp_path):
    store = str(tmp_path / "store")
    d = spark.createDataFrame([(1, "some words"), (2, "x"), (3, None)], "doc_id long, text string")
    for n in (1, 2, 2):
        done = B.rebuild(d, store, word_hash_encoder(8), dims=8, run=n, min_chars=5)
        assert not os.listdir(f"{store}/runs") and not os.listdir(f"{store}/chunks/incoming")
    for name in ("chunks", "vectors", "status"):
        VS.expire(spark, f"{store}/{name}", keep=1)
    assert {r.doc_id: (r.status, r.retries, r.run) for r in done.collect()} == {1: ("completed", 0, 1), 2: ("failed", 2, 2), 3: ("failed", 2, 2)}
    assert [r.chunk_text for r in VS.read(spark, f"{store}/chunks").collect()] == ["some words"]
