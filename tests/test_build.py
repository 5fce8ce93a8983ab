from pyspark.sql import functions as F

from skeinworks.operators import build as B, chunking as C
from skeinworks.operators.vector import encode_with, word_hash_encoder
from skeinworks.sources import versions as VS


def test_a_failed_batch_is_tried_text_by_text(spark):
    d = spark.createDataFrame([(1, "one"), (2, "bad"), (3, "three")], "id int, t string").coalesce(1)

    def fn(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("refused")
        return [[float(len(t)), 1.0] for t in texts]

    got = {r["id"]: (list(r["embedding"]), r["status"]) for r in encode_with(d, "t", fn, dims=2).collect()}
    assert got == {1: ([3.0, 1.0], "completed"), 2: ([0.0, 0.0], "failed"), 3: ([5.0, 1.0], "completed")}
    short = encode_with(d, "t", lambda texts: [[1.0] for _ in texts], dims=2)
    assert {r["status"] for r in short.collect()} == {"failed"}


def test_only_new_and_failed_texts_are_encoded(spark, tmp_path):
    table = str(tmp_path / "vectors")
    d = spark.createDataFrame([(1, "one"), (2, "bad"), (3, "one"), (4, None), (5, "x" * 30)], "id int, t string")

    def refuse(texts):
        if "bad" in texts:
            raise RuntimeError("refused")
        return [[float(len(t)), 1.0] for t in texts]

    def count_calls(texts):
        raise AssertionError("nothing to encode")

    def rows(out):
        return {r["id"]: (r["embedding"] and list(r["embedding"]), r["encoding"]) for r in out.collect()}

    first = rows(B.encode_new(d, "t", table, refuse, dims=2, max_chars=20))
    assert first[1] == first[3] == ([3.0, 1.0], "completed") and first[2] == ([0.0, 0.0], "failed")
    assert first[4] == (None, None) and first[5] == ([20.0, 1.0], "completed")
    second = rows(B.encode_new(d, "t", table, lambda texts: [[9.0, 9.0] for _ in texts], dims=2, max_chars=20))
    assert second == first | {2: ([9.0, 9.0], "completed")}
    before = VS.version(spark, table).number
    assert rows(B.encode_new(d, "t", table, count_calls, dims=2, max_chars=20)) == second
    assert VS.version(spark, table).number == before


def test_rebuild_does_only_what_is_open(spark, tmp_path):
    store, encoder = str(tmp_path / "store"), word_hash_encoder(8)

    def run(n, rows):
        d = spark.createDataFrame(rows, "doc_id long, text string")
        st = {r["doc_id"]: (r["status"], r["retries"], r["run"]) for r in B.rebuild(d, store, encoder, dims=8, run=n, min_chars=5).collect()}
        held = {r["doc_id"]: r["chunk_text"] for r in VS.read(spark, f"{store}/chunks").collect()}
        return st, held

    one = [(1, "kept as it is"), (2, "first words"), (3, "tiny"), (4, "going away"), (5, None), (6, "      ")]
    st, held = run(1, one)
    assert st == {1: ("completed", 0, 1), 2: ("completed", 0, 1), 3: ("failed", 1, 1), 4: ("completed", 0, 1), 5: ("failed", 1, 1), 6: ("failed", 1, 1)}
    assert held == {1: "kept as it is", 2: "first words", 4: "going away"}
    two = [(1, "kept as it is"), (2, "cut"), (3, "tiny"), (5, "now a text"), (6, "      ")]
    st, held = run(2, two)
    assert st == {1: ("completed", 0, 1), 2: ("failed", 1, 2), 3: ("failed", 2, 2), 5: ("completed", 0, 2), 6: ("failed", 2, 2)}
    assert held == {1: "kept as it is", 2: "first words", 5: "now a text"}  # the last good chunks stay
    assert run(2, [(1, "another text")]) == (st, held)  # a number seen before
    for n in (3, 4, 5, 6):
        st, held = run(n, two)
    assert st[3] == ("failed", 4, 4) and st[2] == ("failed", 4, 5)  # three retries, then no more


def test_chunks_of_a_build_are_made_once(spark, tmp_path, monkeypatch):
    made, real = spark.sparkContext.accumulator(0), C.linked_chunks

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    def counted(df, *a, **k):
        out = real(df, *a, **k)
        return out.mapInArrow(count, out.schema)

    monkeypatch.setattr(C, "linked_chunks", counted)
    d = spark.createDataFrame([(i, "word " * (i + 1)) for i in range(12)], "doc_id int, text string")
    done = B.rebuild(d, str(tmp_path / "store"), word_hash_encoder(8), dims=8, run=1)
    assert {r["status"] for r in done.collect()} == {"completed"} and made.value == 12


def test_pages_are_joined_in_order(spark):
    rows = [(d, p, f"text {d}.{p}") for d in (1, 2) for p in range(30, 0, -1)] + [(3, 1, None), (3, 2, ""), (None, 1, "lost")]
    d = spark.createDataFrame(rows, "doc long, page int, body string").repartition(7)
    got = {r["doc"]: r["joined"] for r in C.joined_pages(d, "doc", "page", "body", out="joined").collect()}
    assert got[2] == "".join(f"\n--- Page {p} ---\ntext 2.{p}" for p in range(1, 31))
    assert got[3] == "\n--- Page 1 ---\n\n--- Page 2 ---\n" and got[None].endswith("lost") and len(got) == 4
    assert C.joined_pages(d.where("doc = 9"), "doc", "page", "body").count() == 0
