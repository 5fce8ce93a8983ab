import subprocess
import zlib

import numpy as np
from pyspark.sql import functions as F

from llm.toxicity import fit, fit_apart, fitted, labelled, op2_toxicity, scored, share_of
from tests.llm.conftest import SF


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op2_toxicity(spark, "/root/testdata/sf0.01").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(got[d].held_out for d in held)
    assert all(r.predicted == int(r.score >= 0.5) for r in got.values())
    assert np.mean([got[d].predicted == labels[d] for d in held]) >= 0.95


def test_learns_words_and_beginnings():
    rng = np.random.default_rng(2)
    plain = [f"word{k}" for k in range(200)]
    texts, labels = [], []
    for k in range(300):
        w = list(rng.choice(plain, 30))
        if k % 5 == 0:
            w[3] = "villain" if k % 2 else f"vexo{rng.integers(0, 99)}"
        texts.append(" ".join(w))
        labels.append(float(k % 5 == 0))
    model = fit(texts[:200], np.array(labels[:200]))
    assert model.table.shape[0] and model.scale.shape == (4, 2)


def test_fit_in_a_process_of_its_own():
    texts, labels = [f"word{k} {'bad' if k % 4 == 0 else 'good'} end{k % 3}" for k in range(60)], np.array([float(k % 4 == 0) for k in range(60)])
    here, apart = fit(texts, labels, share=0.1), fit_apart(texts, labels, share=0.1)
    assert all(np.array_equal(getattr(here, a), getattr(apart, a)) for a in ("table", "bias", "out", "scale")) and here.base == apart.base
    assert all(np.array_equal(a, b) for a, b in zip(here.filters, apart.filters, strict=True))


def test_the_driver_holds_no_texts_and_runs_no_fit(spark, monkeypatch):
    rows = [(k, f"word{k % 7} {'bad' if k % 4 == 0 else 'good'} end{k % 3}", int(k % 4 == 0)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    here = fit(*labelled(docs, docs, "toxic"), share=share_of(docs, docs, "toxic"))
    monkeypatch.setattr(subprocess, "run", None)
    monkeypatch.setattr(type(docs), "toArrow", None)
    got = fitted(docs, docs)
    assert all(np.array_equal(getattr(here, a), getattr(got, a)) for a in ("table", "bias", "out", "scale")) and here.base == got.base
    assert fitted(docs.where("doc_id < 0"), docs).base == fit([], np.zeros(0), share=0.5).base


def test_learns_only_from_allowed_ids(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    texts, _ = labelled(docs, labels, "toxic")
    assert set(texts) == {f"text {k}" for k in range(100) if zlib.crc32(str(k).encode()) % 5}


def test_scores_keep_the_base_rate_when_the_sample_does_not(spark):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(f"word{w}" for w in rng.integers(0, 40, 20)), int(k % 10 == 0)) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    _, sample = labelled(docs, docs, "toxic", 100)
    assert len(sample) == 200 and sample.mean() == 0.5  # of 2,400 rows, a tenth of them toxic
    assert abs(share_of(docs, docs, "toxic") - 0.1) < 0.02
    got = scored(docs.select("doc_id", "text"), fitted(docs, docs, rows=100)).collect()
    assert abs(np.mean([r.score for r in got]) - 0.1) < 0.06  # nothing in the texts tells
    assert np.mean([r.predicted for r in got]) < 0.1


def test_odd_rows(spark, odd, none):
    for model in (fit([], np.zeros(0)), fit(["a b"], np.ones(1)), fit(["good words"] * 5 + ["bad words"] * 5, np.repeat([0.0, 1.0], 5))):
        rows = scored(odd, model).collect()
        assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
        by_text = {}
        for r in rows:
            assert abs(by_text.setdefault(r.text or "", r.score) - r.score) < 2e-6
        assert scored(none, model).count() == 0
    assert SF
