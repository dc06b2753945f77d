"""Physical-plan checks for the scale properties the README claims."""

import os
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from txlake.operators import dedup_exact, late_arrivals
from txlake.sources.files import spread

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_lookup(spark):
    plan = _plan(E.queries()["point_lookup"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,1234)]" in plan
    scan = _plan(E.queries()["scan_parquet"](spark, SF))
    assert "o_orderpriority" not in scan.split("ReadSchema:")[1]


def test_no_python_in_batch_queries(spark):
    for name in ("envelope_decode", "clean_transactions", "uuid5_id", "dedup_exact",
                 "sequence_number", "semi_filter_topk", "late_rows"):
        plan = _plan(E.queries()[name](spark, SF))
        assert "Python" not in plan, name


def test_batch_dedup_aggregates_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "t", 1, "p")] * 50 + [("b", "t", 1, "q")],
                               "object_id string, object_type string, sent_dttm int, payload string")
    plan = _plan(dedup_exact(df))
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")
    assert sorted(r.object_id for r in dedup_exact(df).collect()) == ["a", "b"]


def test_late_audit_broadcasts_only_the_per_batch_table(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", 0)] * 3,
                               "id int, ts string, b int").withColumn("ts", F.col("ts").cast("timestamp"))
    plan = _plan(late_arrivals(df, "b", "ts", 60))
    assert "BroadcastExchange" in plan and "BroadcastHashJoin" in plan


def test_spread_is_a_no_op_for_split_inputs(spark):
    wide = spark.range(0, 1000, numPartitions=64)
    assert "Exchange" not in _plan(spread(wide, 8))
    narrow = spark.range(0, 1000, numPartitions=1)
    assert spread(narrow, 8).rdd.getNumPartitions() == 8
    half = spark.range(0, 1000, numPartitions=5)  # most cores busy already
    assert "Exchange" not in _plan(spread(half, 8))


def test_processing_time_trigger(spark, tmp_path):
    from tests.fixtures import TX_T, dumps
    from txlake.sources import record_stream
    from txlake.streaming import FanOutSink, TablePaths, start_collector
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.txt").write_text(dumps(TX_T) + "\n")
    paths = TablePaths.under(str(tmp_path / "t"))
    q = start_collector(record_stream(spark, str(feed), fmt="text"), FanOutSink(paths),
                        str(tmp_path / "ck"), query_name="collector_test", trigger="1 second")
    try:
        q.processAllAvailable()
        (feed / "b.txt").write_text(dumps({**TX_T, "object_id": "x2"}) + "\n")
        time.sleep(0.1)
        q.processAllAvailable()
        assert q.name == "collector_test"
    finally:
        q.stop()
    assert spark.read.parquet(paths.raw).count() == 2


def _final_plan(df):
    df.collect()  # the adaptive plan is final only after this query ran
    return _plan(df).split("\n+- == Initial Plan ==")[0]


def test_numbering_is_shuffled_once_per_query(spark):
    for name in ("sequence_number", "semi_filter_topk", "double_semi_topk"):
        final = _final_plan(E.queries()[name](spark, SF))
        ranges = [ln for ln in final.splitlines()
                  if "Exchange rangepartitioning" in ln and "ReusedExchange" not in ln]
        # at most one: AQE drops the hot branch when a filter leaves it empty
        assert len(ranges) <= 1, name
        assert "SortMergeJoin" not in final, name
