import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.quality import evidence_of, fit, judged, op6_quality, with_sites


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op6_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 5 == 0]
    assert np.mean([got[d].keep == bool(labels[d]) for d in held]) >= 0.95


def test_sparse_sites_are_drawn_to_their_host_and_to_all(spark):
    rows = [(f"h{h}", f"h{h}/p{p}", 0.9 if h % 2 else 0.1) for h in range(20) for p in range(2) for _ in range(50)]
    rows += [("new", "new/p", 0.9), ("h1", "h1/new", 0.1)]
    out = with_sites(spark.createDataFrame(rows, "host string, path string, own double"), F.col("host"), F.col("path"))
    got = {r.path: r for r in out.collect()}
    assert got["h1/p0"].path_share > 0.85 and got["h0/p0"].path_share < 0.15
    assert abs(got["new/p"].path_share - 0.5) < 0.05  # left out itself: the share of all
    assert got["h1/new"].host_share > 0.85 and got["h1/new"].score > got["h1/new"].own
    assert out.count() == len(rows)
    for r in out.limit(5).collect():
        z = sum(s * np.log(p / (1 - p)) for s, p in ((1, r.own), (1, r.path_share), (-1, sum(x[2] for x in rows) / len(rows))))
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-6)


@pytest.mark.parametrize("chars", [4_999, 9_999, 14_999, 100_000])
def test_digits_are_counted_over_the_whole_text(chars):
    digits = 12
    assert evidence_of("7" * chars)[digits] == 1.0
    assert evidence_of(("7" + "a" * 19) * (chars // 20))[digits] == pytest.approx(0.05)


def test_odd_rows(spark, odd, none):
    for scorer in (fit([], np.zeros(0)), fit(["a b"], np.ones(1)), fit(["some words"] * 4 + ["x x x x"] * 4, np.repeat([1.0, 0.0], 4))):
        rows = with_sites(judged(odd, scorer), F.col("source"), F.col("lang")).collect()
        assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
        assert with_sites(judged(none, scorer), F.col("source"), F.col("lang")).count() == 0
