from pyspark.sql import functions as F

import __spark_entry__ as entry
from skeinworks.plans import table_queries


def test_events_are_listed_from_their_own_partitions(spark, monkeypatch, tmp_path):
    events = spark.range(0, 80, 1, 4).withColumn("event_type", F.when(F.col("id") % 8 < 7, F.concat(F.lit("a/b "), F.col("id") % 2)))
    monkeypatch.setattr(table_queries, "table", lambda *_: events)
    monkeypatch.setattr(table_queries, "fresh_folder", lambda *_: str(tmp_path / "listed"))
    (row,) = entry.queries()["source_listed_objects"](spark, "").collect()
    assert (row.files, row.all_have_bytes) == (2, True)  # as count(DISTINCT event_type), null left out
    assert {len(list(d.glob("*.json"))) for d in (tmp_path / "listed").glob("event_type=*")} == {4}
