import random

import pytest
from pyspark.sql import functions as F

from skeinworks.sources import versions as T

ROW = "id long, v string, at int"


def table(spark, path, number=None):
    return sorted(map(tuple, T.read(spark, path, number).select("id", "v", "at").collect()), key=str)


def merge(spark, rows, path, **options):
    return T.merge(spark.createDataFrame(rows, ROW), path, "id", [F.col("at")], **options)


def test_merges_make_versions_and_old_ones_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    assert merge(spark, [(1, "a", 1), (2, "b", 1), (None, "n", 1)], path) == 1
    assert merge(spark, [(2, "old", 0), (3, "c", 1), (3, "cc", 2)], path) == 2
    assert merge(spark, [(1, "tie", 1), (None, "m", 2)], path) == 3
    assert table(spark, path, 1) == sorted([(1, "a", 1), (2, "b", 1), (None, "n", 1)], key=str)
    assert table(spark, path, 2) == sorted([(1, "a", 1), (2, "b", 1), (3, "cc", 2), (None, "n", 1)], key=str)
    assert table(spark, path) == sorted([(1, "tie", 1), (2, "b", 1), (3, "cc", 2), (None, "m", 2)], key=str)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert merge(spark, [(1, "a", 1)], path, batch=("w", 0)) == 1
    assert merge(spark, [(1, "b", 2)], path, batch=("w", 1)) == 2
    assert merge(spark, [(1, "z", 9)], path, batch=("w", 0)) == 2
    assert merge(spark, [(1, "z", 9)], path, batch=("w", 1)) == 2
    assert table(spark, path) == [(1, "b", 2)]
    assert merge(spark, [(2, "other", 1)], path, batch=("x", 0)) == 3


def test_broken_merge_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(spark, [(1, "a", 1), (2, "b", 1)], path)
    bad = spark.createDataFrame([(1, "new", 2)], ROW).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        T.merge(bad, path, "id", [F.col("at")])
    # a merge that ended after its files and before its name
    held = T._published
    T._published = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError, match="lost"):
            merge(spark, [(1, "new", 2)], path)
    finally:
        T._published = held
    assert T.versions(spark, path) == [1] and table(spark, path) == [(1, "a", 1), (2, "b", 1)]
    with pytest.raises(TypeError, match="column v"):
        T.merge(spark.createDataFrame([(1, 5, 2)], "id long, v int, at int"), path, "id", [F.col("at")])


def test_second_of_two_merges_starts_again(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(spark, [(1, "a", 1)], path)
    held, raced = T._published, []

    def overtaken(*a):
        if not raced:
            raced.append(1)
            merge(spark, [(2, "first", 1)], path)
        return held(*a)

    T._published = overtaken
    try:
        assert merge(spark, [(3, "second", 1)], path) == 3
    finally:
        T._published = held
    assert table(spark, path) == [(1, "a", 1), (2, "first", 1), (3, "second", 1)]


def test_buckets_grow_and_untouched_ones_keep_their_files(spark, tmp_path):
    path, r, held = str(tmp_path / "t"), random.Random(5), {}
    for step in range(4):
        rows = [(i, f"{step}-{r.random()}", step) for i in r.sample(range(4000), 900)]
        merge(spark, rows, path, bucket_bytes=8192)
        held |= {row[0]: row for row in rows}
    assert table(spark, path) == sorted(held.values(), key=str)
    before = T.version(spark, path)
    assert before.buckets >= 4
    merge(spark, [(7, "one", 99)], path, bucket_bytes=8192 * 4)
    after = T.version(spark, path)
    assert sum(before.folders[b] != after.folders[b] for b in before.folders) == 1


def test_replace_takes_all_rows_of_a_key_and_new_columns_come_in(spark, tmp_path):
    path = str(tmp_path / "t")
    T.replace(spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 0)], ROW), spark.range(0), path, "id")
    keys = spark.createDataFrame([(1,), (2,), (9,)], "id long")
    T.replace(spark.createDataFrame([(1, "x", 0, 5)], ROW + ", extra int"), keys, path, "id")
    assert [tuple(r) for r in T.read(spark, path).collect()] == [(1, "x", 0, 5)]
    T.replace(spark.createDataFrame([], ROW), keys, path, "id")
    assert T.read(spark, path).columns == ["id", "v", "at", "extra"] and T.read(spark, path).count() == 0
    assert T.expire(spark, path, keep=1) == [1, 2]
    assert T.versions(spark, path) == [3] and T.read(spark, path).count() == 0


def test_rows_of_a_replacing_batch_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    new = spark.range(20).select((F.col("id") % 7).alias("k"), "id").mapInArrow(count, "k long, id long")
    T.replace(new, spark.range(9).select(F.col("id").alias("k")), str(tmp_path), "k")
    assert made.value == 20 and T.read(spark, str(tmp_path)).count() == 20


def test_empty_batch_and_missing_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        T.read(spark, path)
    assert merge(spark, [], path) == 1 and table(spark, path) == []
    assert merge(spark, [(1, "a", 1)], path) == 2
    assert merge(spark, [], path) == 2 and table(spark, path) == [(1, "a", 1)]
