from llm.decontaminate import hits, report


def test_windows_blocks_and_odd_rows(spark, odd, none):
    words = [f"v{k}" for k in range(40)]
    items = spark.createDataFrame([(1, " ".join(words[:13])), (10, " ".join(words[5:30])), (2, "Three"), (3, ""), (4, None), (None, "one two")], "item_id long, text string")
    docs = spark.createDataFrame([(100, " ".join(["x"] * 5 + words[:20] + ["y"] * 5)), (101, " ".join(words[:12])), (102, " ".join(words)), (103, " ".join(words[:13]) + " " + " ".join(words[:13]))], "doc_id long, text string")
    whole = {r.doc_id: r for r in report(hits(docs, items)).collect()}
    parts = {r.doc_id: r for r in report(hits(docs, items, block_bytes=10)).collect()}
    assert whole == parts
    assert [(whole[d].n_words, whole[d].n_hit, whole[d].n_items, whole[d].contaminated) for d in (100, 101, 102, 103)] == [(30, 20, 2, True), (12, 0, 0, False), (40, 30, 2, True), (26, 26, 1, True)]
    got = sorted((str(r.doc_id), r.n_words, r.n_hit) for r in report(hits(odd, items)).collect())
    assert got == sorted([("1", 0, 0), ("2", 0, 0), ("3", 30000, 0), ("4", 3, 1), ("4", 3, 1), ("5", 3, 1), ("None", 3, 1), ("6", 0, 0), ("7", 4, 0)])
    assert report(hits(none, items)).count() == 0 and report(hits(odd, items.limit(0))).where("contaminated").count() == 0
