import duckdb
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from llm.common import WordHashes
from llm.near_dedup import bag_of, overlap
from llm.registry import oracles, queries
from tests.llm.conftest import SF


def test_stages_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("n_words", F.lit("theirs"))
    columns = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        after = {r.doc_id: r for r in docs.collect()}
        gone = [before[d] for d in before.keys() - after.keys()]
        if name == "near_dedup":
            h = WordHashes()
            bags = {d: bag_of(r.text, h) for d, r in after.items()}
            assert all(any(overlap(bag_of(g.text, h), b) >= 0.5 for b in bags.values()) for g in gone)
            ids = sorted(bags)
            assert not [(a, b) for k, a in enumerate(ids) for b in ids[:k] if overlap(bags[a], bags[b]) >= 0.8]
        if name == "decontamination":
            con = duckdb.connect()
            for t in ("documents", "benchmark"):
                con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
            bad = {r[0] for r in con.execute(f"select doc_id from ({oracles()['op7_decontaminate']}) where contaminated").fetchall()}
            assert {g.doc_id for g in gone} == bad & before.keys()
        if name == "secrets":
            assert not gone and all(r.n_chars == len(r.text) for r in after.values())
            assert all(before[d].text == r.text for d, r in after.items() if "[SECRET]" not in r.text)
    assert pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_odd_rows_go_through(spark, odd, none):
    for docs in (odd, none):
        n = docs.count()
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() <= n


def test_every_operator_is_registered():
    names = set(queries())
    assert {n.split("_")[0] for n in names} == {"pipeline", *(f"op{k}" for k in range(1, 14))}


def test_a_text_goes_to_python_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.lit(1).alias("a.b"), "*")
    sent = pipeline._wrapped(docs)
    assert [f.name for f in sent.schema["_row"].dataType.fields] == [c for c in docs.columns if c != "text"]
    back = pipeline._unwrapped(sent, docs)
    assert back.columns == docs.columns and back.schema == docs.schema
    assert back.exceptAll(docs).count() == 0 and docs.exceptAll(back).count() == 0
