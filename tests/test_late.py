"""Late rows kept, the guarded clock, exact dedup over bounded state, state
audits: one-file-per-trigger feeds against plain Python."""

import json
import os
import time
from collections import Counter

import pytest
from pyspark.sql.utils import StreamingQueryException

from tests.fixtures import failing_once
from txlake.schemas import RAW_TABLE
from txlake.sources import read_partitioned, record_stream
from txlake.streaming import FanOutSink, TablePaths, run_collector
from txlake.streaming.late import late_watermark
from txlake.streaming.metrics import batch_metrics_table
from txlake.streaming.state import state_keys, state_sizes, unfinalized


def msg(oid, time_, otype="VIEW"):
    return json.dumps({"object_id": oid, "object_type": otype, "sent_dttm": time_, "payload": {"k": 1}})


def put(folder, batches, start=0):
    os.makedirs(folder, exist_ok=True)
    t0 = time.time() - 100_000
    for i, rows in enumerate(batches, start):
        p = os.path.join(folder, f"part-{i:03d}.txt")
        with open(p, "w") as f:
            f.write("\n".join(rows) + "\n")
        os.utime(p, (t0 + 10 * i, t0 + 10 * i))


def run(spark, root, **kw):
    sink = kw.pop("sink", None) or FanOutSink(TablePaths.under(f"{root}/t"))
    records = record_stream(spark, f"{root}/feed", fmt="text", max_files_per_trigger=1)
    return run_collector(records, sink, f"{root}/ck", **kw)


def ids(spark, path):
    return Counter(r.object_id for r in spark.read.parquet(path).collect())


def raw_ids(spark, root):
    return Counter(r.object_id for r in read_partitioned(spark, f"{root}/t/raw", RAW_TABLE).collect())


#: copies among the late rows; one late by a second, one just in time
FEED = [
    [msg("a", "2022-05-04 10:00:00")],
    [msg("b", "2022-05-04 14:00:00")],
    [msg("c", "2022-05-04 09:00:00"), msg("c", "2022-05-04 09:00:00"), msg("d", "2022-05-04 09:00:01"),
     msg("a", "2022-05-04 10:00:00"), msg("e", "2022-05-04 14:30:00"), "not json", "not json"],
    [msg("f", "2022-05-04 13:00:00"), msg("g", "2022-05-04 13:00:01"), msg("x", "2022-05-04 09:30:00")],
]


@pytest.mark.parametrize("mode,predup", [("watermark_first", False), ("watermark_first", True),
                                         ("within_watermark", False), ("finalized", False)])
def test_every_late_row_is_kept(spark, tmp_root, mode, predup):
    put(f"{tmp_root}/feed", FEED)
    q = run(spark, tmp_root, watermark_delay="1 hour", dedup_mode=mode, predup=predup)
    late = spark.read.parquet(f"{tmp_root}/t/late").collect()
    # batch 2 drops by the mark of batch 1 (09:00), batch 3 by that of batch 2 (13:00)
    assert Counter(r.object_id for r in late) == Counter("ccfx")
    assert {(r.batch_id, str(r.watermark)) for r in late} == {(2, "2022-05-04 09:00:00"), (3, "2022-05-04 13:00:00")}
    dropped = sum(int(s.numRowsDroppedByWatermark) for p in q.recentProgress for s in p.stateOperators)
    assert dropped <= len(late) and (mode == "finalized" or predup or dropped == len(late))
    kept = raw_ids(spark, tmp_root)
    if mode == "finalized":  # the newest is in state; the feed's end lets it out
        left = [r.object_id for r in unfinalized(spark, f"{tmp_root}/ck").collect()]
        kept += Counter(left)
    assert kept == Counter("abdeg")
    assert [r.raw_value for r in spark.read.parquet(f"{tmp_root}/t/rejects").collect()] == ["not json"] * 2


def test_late_rows_after_a_restart(spark, tmp_root):
    put(f"{tmp_root}/feed", FEED[:2])
    run(spark, tmp_root, watermark_delay="1 hour")
    # the run ended with an idle batch: the mark of 14:00 is in force now
    put(f"{tmp_root}/feed", [[msg("p", "2022-05-04 13:00:00"), msg("q", "2022-05-04 13:00:01")]], start=2)
    run(spark, tmp_root, watermark_delay="1 hour")
    assert ids(spark, f"{tmp_root}/t/late") == Counter("p")
    assert raw_ids(spark, tmp_root) == Counter("abq")
    assert late_watermark(spark, f"{tmp_root}/ck", 0) is None


@pytest.mark.parametrize("mode", ["watermark_first", "within_watermark", "finalized"])
def test_a_message_from_the_far_future_moves_no_clock(spark, tmp_root, mode):
    wild = msg("wild", "9999-12-31 00:00:00")
    put(f"{tmp_root}/feed", [[msg("a", "2022-05-04 10:00:00"), wild], [msg("b", "2022-05-04 10:20:00"), wild],
                             [msg("c", "2022-05-04 10:10:00")], [msg("d", "2022-05-04 12:00:00")]])
    run(spark, tmp_root, watermark_delay="1 hour", dedup_mode=mode)
    kept = raw_ids(spark, tmp_root)
    if mode == "finalized":
        kept += Counter(r.object_id for r in unfinalized(spark, f"{tmp_root}/ck").collect())
    assert kept == Counter("abcd")
    aside = spark.read.parquet(f"{tmp_root}/t/rejects").collect()
    assert [(r.reject_reason, r.raw_value) for r in aside] == [("future_time", wild)] * 2


def test_exact_dedup_keeps_little_state(spark, tmp_root):
    # 20 batches; each repeats the one before, the first, and a row as old as can be
    fresh = [[msg(f"{b}-{i}", f"2022-05-{b + 1:02d} 10:00:00") for i in range(20)] for b in range(20)]
    old = msg("old", "1969-07-20 20:17:00")
    none = msg("none", None)
    put(f"{tmp_root}/feed", [[*fresh[b], *fresh[b - 1][:5], *fresh[0][:5], old, none, none, "broken"] for b in range(20)])
    q = run(spark, tmp_root, watermark_delay="0 seconds", dedup_mode="bounded")
    want = Counter(f"{b}-{i}" for b in range(20) for i in range(20)) + Counter(["old", "none"])
    assert raw_ids(spark, tmp_root) == want
    assert spark.read.parquet(f"{tmp_root}/t/rejects").count() == 20
    held = [int(s.numRowsTotal) for p in q.recentProgress for s in p.stateOperators]
    assert max(held) <= 70  # two batches' keys, whatever came before
    assert sum(int(s.numRowsDroppedByWatermark) for p in q.recentProgress for s in p.stateOperators) == 0


def test_bounded_dedup_survives_a_failed_batch(spark, tmp_root):
    put(f"{tmp_root}/feed", [[msg("a", "2022-05-04 10:00:00"), msg("b", "2022-05-04 10:00:00")], [msg("a", "2022-05-04 10:00:00"), msg("c", "2022-05-04 11:00:00")]])
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_root, watermark_delay="0 seconds", dedup_mode="bounded",
            sink=failing_once(FanOutSink(TablePaths.under(f"{tmp_root}/t"))))
    run(spark, tmp_root, watermark_delay="0 seconds", dedup_mode="bounded")
    # the batch that ran again did not take its own keys for earlier ones
    assert raw_ids(spark, tmp_root) == Counter("abc")


def test_state_and_metrics_as_tables(spark, tmp_root):
    put(f"{tmp_root}/feed", FEED)
    q = run(spark, tmp_root, watermark_delay="1 hour")
    sizes = {r.batch_id: r.state_rows for r in state_sizes(spark, f"{tmp_root}/ck", range(4)).collect()}
    # marks for eviction: none, 09:00, 13:00, 13:30
    assert sizes == {0: 1, 1: 2, 2: 2, 3: 2}
    assert {r.object_id for r in state_keys(spark, f"{tmp_root}/ck", 3).collect()} == {"b", "e"}
    got = [(r.batch_id, r.rows_in, r.rejected, r.rows_out, r.dropped_late) for r in batch_metrics_table(spark, q).collect()]
    # a late row went nowhere: four rows and two rejects of batch 2 came out less its two late ones
    assert got == [(0, 1, 0, 1, 0), (1, 1, 0, 1, 0), (2, 7, 2, 4, 2), (3, 3, 0, 1, 2)]


def test_large_arrivals_are_fed_in_a_file_per_core(spark, tmp_root, monkeypatch):
    import glob

    from txlake.plans import queries as Q
    (spark.range(3000).selectExpr("id AS event_id", "timestamp_ntz '2024-01-01' + make_dt_interval(id % 30) AS ts", "id AS user_id",
                                  "'click' AS event_type", "1.0D AS value", "'{}' AS props").write.parquet(f"{tmp_root}/sf/events.parquet"))
    cores = spark.sparkContext.defaultParallelism
    for rows, want in ((10_000, 2), (10, max(2, min(cores, 60)))):
        monkeypatch.setattr(Q, "FEED_ROWS", rows)
        feed, n = Q._arrival_feed(spark, f"{tmp_root}/sf", f"{tmp_root}/{rows}")
        assert n == want and len(glob.glob(f"{feed}/part-*")) == 5 * n
        assert spark.read.parquet(feed).count() == 3000
