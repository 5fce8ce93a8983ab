"""What the plans must and must not hold."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
EAGER = ("stream_", "source_", "sink_", "document_build", "changes_rebuilt", "encoding_store", "classifier_boosted", "classifier_tuning", "search_multi_step", "bm25_search_indexed")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not n.startswith(EAGER)))
def test_no_cross_join(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_top_k_is_cut_before_the_shuffle(spark):
    p = plan(entry.queries()["vector_nearest"](spark, SF))
    assert p.count("WindowGroupLimit") == 2


def test_keyword_sums_stay_in_the_document_partition(spark):
    p = plan(entry.queries()["bm25_search"](spark, SF))
    head = p[: p.index("REPARTITION_BY_COL")]
    assert "partial_sum" in head
    between = head[head.index("functions=[sum(") : head.index("functions=[partial_sum(")]
    assert "Exchange" not in between


def test_filter_and_columns_reach_the_scan(spark):
    p = plan(entry.queries()["filter_metadata"](spark, SF))
    assert "EqualTo(lang,fr)" in p and "In(source, [src1,src2,src3])" in p
    p = plan(entry.queries()["series_step"](spark, SF))
    assert "l_extendedprice" not in p


def test_running_sums_share_their_shuffle(spark):
    df = entry.queries()["ltr_negatives"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df)
