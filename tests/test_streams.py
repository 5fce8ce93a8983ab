import random

from pyspark.sql import functions as F

from skeinworks.sources import readers as RD, versions as VS, writers as W
from skeinworks.streaming import jobs as X


def test_circuit_states_over_batches_and_replay(spark, tmp_path):
    r = random.Random(3)
    log = [(i, "hot" if i % 4 else f"k{i % 3}", i // 2, r.random() < 0.2) for i in range(240)]
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id long, k string, t long, ok boolean"

    def arrive(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        s = X.arriving(spark, src, schema, files_per_batch=1).withColumn("ts", F.timestamp_seconds("t"))
        X.circuit_states(s, out, out + "/checkpoint", key="k", ts="ts", tie="id", ok="ok")

    arrive(log[:100])
    run()
    arrive(log[100:])
    run()
    run()  # nothing new
    got = {x["id"]: x["failure_count"] for x in spark.read.parquet(out + "/attempts").collect()}
    state = {}
    assert len(got) == len(log)
    for i, k, _, ok in log:
        state[k] = 0 if ok else state.get(k, 0) + 1
        assert got[i] == state[k]
    held = {x["k"]: x["failures"] for x in VS.read(spark, out + "/states").collect()}
    assert held == state


def test_recent_turns_keep_the_newest(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "c long, turn long, text string"
    for part in ([(1, 0, "a"), (1, 2, "c")], [(1, 1, "b"), (1, 3, "d"), (2, 0, "z")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        s = X.recent_turns(X.arriving(spark, src, schema), conversation="c", turn="turn", text="text", keep=2)
        X.run_batches(s, X.numbered_batches(out), out + "-cp", mode="update")
    last = {r["c"]: r["turns"] for r in W.latest(spark.read.parquet(out), "c", [F.col("batch")]).collect()}
    assert last == {1: [2, 3], 2: [0]}


def test_chunk_store_replaces_chunks(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for text in ("one two", "three"):
        spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1).write.mode("append").parquet(src)
        X.chunk_store(X.arriving(spark, src, "doc_id long, text string"), out, out + "-cp")
    assert [(r["chunk_id"], r["chunk_text"]) for r in VS.read(spark, out + "/chunks").collect()] == [("1_chunk_0", "three")]
    spark.createDataFrame([(1, "..."), (2, "two"), (2, "three"), (3, None)], "doc_id long, text string").coalesce(1).write.mode("append").parquet(src)
    X.chunk_store(X.arriving(spark, src, "doc_id long, text string"), out, out + "-cp")
    status = {r["doc_id"]: (r["status"], r["chunks"]) for r in VS.read(spark, out + "/status").collect()}
    assert status[2] == ("chunked", 1) and status[3] == ("failed", 0)
    assert {r["chunk_text"] for r in VS.read(spark, out + "/chunks").where("doc_id = 2").collect()} == {"two"}


def test_windows_are_merged_and_late_rows_change_them(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "t long, v double"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        s = X.arriving(spark, src, schema).withColumn("ts", F.timestamp_seconds("t"))
        X.merged_windows(s, out, out + "-cp", "ts", "v", width="5 minutes")
        d = VS.read(spark, out)
        return {r["s"]: (r["count"], r["total"]) for r in d.select(F.unix_timestamp("window_start").alias("s"), "count", "total").collect()}

    assert arrive([(0, 1.0), (10, 2.0), (900, 4.0)]) == {0: (2, 3.0), 900: (1, 4.0)}  # the open window is there
    # 590 is late by less than ten minutes, 20 by more
    assert arrive([(590, 8.0), (20, 16.0), (901, 32.0)]) == {0: (2, 3.0), 300: (1, 8.0), 900: (2, 36.0)}


def test_status_merge_keeps_what_updates_leave_out(spark):
    old = spark.createDataFrame([(1, "pending", 10), (2, "pending", 20)], "id int, status string, size int")
    upd = spark.createDataFrame([(2, "failed", "boom"), (3, "new", None)], "id int, status string, error string")
    got = {r["id"]: (r["status"], r["size"], r["error"]) for r in W.status_merged(old, upd, "id").collect()}
    assert got == {1: ("pending", 10, None), 2: ("failed", 20, "boom"), 3: ("new", None, None)}


def test_quoted_lines(spark, tmp_path):
    f = tmp_path / "x.csv"
    f.write_text('"Text, Sentiment"\n"I like it , Positive "\n  "plain, \'n\'"  \n', encoding="utf-8")
    rows = RD.read_quoted_lines_csv(spark, str(f), "Text, Sentiment", "Text string, Sentiment string").collect()
    assert [(r["Text"], r["Sentiment"]) for r in rows] == [("I like it", "Positive"), ("plain", "'n'")]


def test_reviews_skip_other_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("plain")
    (tmp_path / "b.json").write_text('{"review_text": "coded", "rating": 1}')
    (tmp_path / "c.json").write_text('{"rating": 1}')
    (tmp_path / "d.pdf").write_text("no")
    assert sorted(r["text"] for r in RD.read_reviews(spark, str(tmp_path)).collect()) == ["", "coded", "plain"]
    assert RD.list_objects(spark, str(tmp_path), suffix=".json").count() == 2
