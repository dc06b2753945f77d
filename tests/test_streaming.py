"""Streaming behaviour: exact and watermark-first dedup on one-file-per-trigger
feeds, late rows, the idempotent fan-out sink across a crash and restart."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from tests.fixtures import TX_T, failing_once
from txlake.operators import late_arrivals
from txlake.schemas import CLEAN_TRANSACTIONS, RAW_TABLE
from txlake.sources import read_partitioned, record_stream
from txlake.streaming import (
    FanOutSink,
    TablePaths,
    VolumeCheck,
    collector_plan,
    dedup_stream,
    run_collector,
)


def _msg(oid, hhmmss, otype="TRANSACTION"):
    return json.dumps({"object_id": oid, "object_type": otype,
                       "sent_dttm": f"2021-03-09T{hhmmss}", "payload": {"k": 1}})


def _write_files(folder, batches):
    """One text file per batch, modification times strictly increasing."""
    os.makedirs(folder, exist_ok=True)
    t0 = time.time() - 1000
    for i, rows in enumerate(batches):
        p = os.path.join(folder, f"part-{i:03d}.txt")
        with open(p, "w") as f:
            f.write("\n".join(rows) + "\n")
        os.utime(p, (t0 + 10 * i, t0 + 10 * i))


FEED = [
    [_msg("a", "10:00:00"), _msg("b", "10:30:00"), _msg("a", "10:00:00")],
    [_msg("c", "12:00:00")],
    [_msg("a", "10:00:00"), _msg("late", "09:00:00"), _msg("d", "12:00:30")],
    [_msg("e", "13:00:00"), _msg("c", "12:00:00")],
    [_msg("f", "13:00:01")],
]


def _run_collect(spark, folder, ckpt, watermark, mode="watermark_first"):
    out = {}

    def sink(df, bid):
        out[bid] = sorted(r.object_id for r in df.collect())

    plan = collector_plan(record_stream(spark, folder, fmt="text", max_files_per_trigger=1),
                          watermark_delay=watermark, dedup_mode=mode)
    q = (plan.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert q.exception() is None
    data = [p for p in q.recentProgress if p["numInputRows"] > 0]
    return out, data


def test_exact_dedup_stream(spark, tmp_root):
    _write_files(f"{tmp_root}/feed", FEED)
    out, prog = _run_collect(spark, f"{tmp_root}/feed", f"{tmp_root}/ck", None)
    assert [out[i] for i in range(5)] == [["a", "b"], ["c"], ["d", "late"], ["e"], ["f"]]
    assert [p["stateOperators"][0]["numRowsTotal"] for p in prog] == [2, 3, 5, 6, 7]


def test_watermark_first_dedup_stream(spark, tmp_root):
    _write_files(f"{tmp_root}/feed", FEED)
    out, prog = _run_collect(spark, f"{tmp_root}/feed", f"{tmp_root}/ck", "1 minute")
    got = [out[b] for b in sorted(out) if out[b]]
    assert got == [["a", "b"], ["c"], ["d"], ["e"], ["f"]]
    dropped = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in prog]
    assert dropped == [0, 0, 2, 0, 0]
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in prog) <= 3


def test_dedup_first_order_keeps_state_and_late_rows(spark, tmp_root):
    """The upstream order (dedup, then watermark): nothing expires and the
    three-hour-late row passes."""
    _write_files(f"{tmp_root}/feed", FEED)
    out, prog = _run_collect(spark, f"{tmp_root}/feed", f"{tmp_root}/ck", "1 minute",
                             mode="dedup_first")
    got = [out[b] for b in sorted(out) if out[b]]
    assert got == [["a", "b"], ["c"], ["d", "late"], ["e"], ["f"]]
    assert [p["stateOperators"][0]["numRowsTotal"] for p in prog] == [2, 3, 5, 6, 7]


def test_within_watermark_dedup(spark, tmp_root):
    _write_files(f"{tmp_root}/feed", FEED)
    out, _ = _run_collect(spark, f"{tmp_root}/feed", f"{tmp_root}/ck", "1 minute",
                          mode="within_watermark")
    got = [out[b] for b in sorted(out) if out[b]]
    assert got == [["a", "b"], ["c"], ["d"], ["e"], ["f"]]


def test_late_rule_matches_single_run(spark, tmp_root):
    """In one run with one file per trigger, the late filter of batch n uses
    the maximum event time of batches <= n - 2."""
    rows = []
    for b, batch in enumerate(FEED):
        for m in batch:
            j = json.loads(m)
            rows.append((j["object_id"], dt.datetime.fromisoformat(j["sent_dttm"]), b))
    arr = spark.createDataFrame(rows, "object_id string, sent_dttm timestamp, b int")
    late = late_arrivals(arr, "b", "sent_dttm", 60, lag=2).where("is_late")
    assert sorted((r.object_id, r.b) for r in late.collect()) == [("a", 2), ("late", 2)]


def test_one_batch_later_is_kept(spark, tmp_root):
    _write_files(f"{tmp_root}/feed", [[_msg("x", "12:00:00")], [_msg("old", "09:00:00")]])
    out, _ = _run_collect(spark, f"{tmp_root}/feed", f"{tmp_root}/ck", "1 minute")
    assert sorted(sum(out.values(), [])) == ["old", "x"]


def test_watermark_bound_is_inclusive_in_millis(spark, tmp_root):
    folder = f"{tmp_root}/feed"
    os.makedirs(folder)
    files = [
        [("m", "2021-03-09 12:00:00")],
        [("filler", "2021-03-09 11:00:00")],
        [("p1", "2021-03-09 11:58:59.999"), ("p2", "2021-03-09 11:59:00"),
         ("p3", "2021-03-09 11:59:00.000500"), ("p4", "2021-03-09 11:59:00.001")],
    ]
    t0 = time.time() - 1000
    for i, rows in enumerate(files):
        p = f"{folder}/f{i}.json"
        with open(p, "w") as f:
            for oid, ts in rows:
                f.write(json.dumps({"object_id": oid, "object_type": "t",
                                    "sent_dttm": ts, "payload": "{}"}) + "\n")
        os.utime(p, (t0 + 10 * i, t0 + 10 * i))
    schema = "object_id string, object_type string, sent_dttm timestamp, payload string"
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)
    got = []
    q = (dedup_stream(src, watermark_delay="1 minute").writeStream
         .foreachBatch(lambda df, b: got.extend(r.object_id for r in df.collect()))
         .option("checkpointLocation", f"{tmp_root}/ck").trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(got) == ["filler", "m", "p3", "p4"]


def _tx_records(n, tmp_root):
    rows = [json.dumps({**TX_T, "object_id": f"id-{i}",
                        "payload": {**TX_T["payload"], "operation_id": f"id-{i}"}})
            for i in range(n)]
    rows += ["not json", json.dumps({**TX_T, "object_type": "REFUND", "object_id": "r1"})]
    _write_files(f"{tmp_root}/feed", [rows])
    return f"{tmp_root}/feed"


def test_fanout_idempotent_across_crash_and_restart(spark, tmp_root):
    feed = _tx_records(10, tmp_root)
    paths = TablePaths.under(f"{tmp_root}/tables")
    ckpt = f"{tmp_root}/ck"
    with pytest.raises((StreamingQueryException, RuntimeError, Exception)):
        run_collector(record_stream(spark, feed, fmt="text"),
                      failing_once(FanOutSink(paths)), ckpt)
    run_collector(record_stream(spark, feed, fmt="text"), FanOutSink(paths), ckpt)
    raw = read_partitioned(spark, paths.raw, RAW_TABLE)
    assert raw.count() == 11  # 10 transactions + 1 unrouted, once each
    assert read_partitioned(spark, paths.transactions, CLEAN_TRANSACTIONS).count() == 10
    rejects = spark.read.parquet(paths.rejects)
    assert [r.raw_value for r in rejects.collect()] == ["not json"]
    # a fresh checkpoint is a new stream: its batches land beside the old ones
    run_collector(record_stream(spark, feed, fmt="text"), FanOutSink(paths), f"{tmp_root}/ck2")
    raw = read_partitioned(spark, paths.raw, RAW_TABLE)
    assert raw.count() == 22
    assert raw.select("stream_id").distinct().count() == 2
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0  # batch released


def test_partition_columns_and_pruning(spark, tmp_root):
    feed = _tx_records(5, tmp_root)
    paths = TablePaths.under(f"{tmp_root}/tables")
    run_collector(record_stream(spark, feed, fmt="text"), FanOutSink(paths), f"{tmp_root}/ck")
    raw = read_partitioned(spark, paths.raw, RAW_TABLE, F.col("object_type") == "transaction")
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(object_type" in plan
    assert raw.count() == 5
    assert {f.name: f.dataType.simpleString() for f in raw.schema.fields}["date"] == "string"


def test_volume_listener(spark, tmp_root):
    feed = _tx_records(7, tmp_root)
    listener = VolumeCheck(limit=9, tolerance=0)
    spark.streams.addListener(listener)
    try:
        q = run_collector(record_stream(spark, feed, fmt="text"),
                          FanOutSink(TablePaths.under(f"{tmp_root}/t")), f"{tmp_root}/ck")
        deadline = time.time() + 30
        while time.time() < deadline and not any(
                b["id"] == str(q.id) and b["input_rows"] for b in listener.batches):
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    mine = [b for b in listener.batches if b["id"] == str(q.id) and b["input_rows"]]
    assert mine and mine[0]["input_rows"] == 9
    assert mine[0]["observed"]["collector_input"]["rejected_rows"] == 1
    assert mine[0]["observed"]["collector_input"]["unrouted_rows"] == 1


def test_publish_then_collect_round_trip(spark, tmp_root):
    from txlake.operators import encode_transactions
    from txlake.streaming import publish_envelopes
    rows = [(f"op{i}", i, i + 1, 11, "sylvania", "queued", "sbp", 100 * i,
             dt.datetime(2021, 3, 9, 0, 0, i)) for i in range(12)]
    dump = spark.createDataFrame(rows, "operation_id string, account_number_from long, "
                                 "account_number_to long, currency_code int, country string, "
                                 "status string, transaction_type string, amount long, "
                                 "transaction_dt timestamp")
    sent = publish_envelopes(encode_transactions(dump), path=f"{tmp_root}/topic")
    assert sent == 12
    paths = TablePaths.under(f"{tmp_root}/tables")
    run_collector(record_stream(spark, f"{tmp_root}/topic", fmt="text"), FanOutSink(paths),
                  f"{tmp_root}/ck")
    back = read_partitioned(spark, paths.transactions, CLEAN_TRANSACTIONS)
    assert sorted(tuple(r)[:9] for r in back.collect()) == sorted(rows)


def test_backfill_equals_stream_and_is_idempotent(spark, tmp_root):
    from txlake.streaming import backfill
    feed = _tx_records(6, tmp_root)
    # the same feed delivered twice, out of order
    dup = [json.dumps({**TX_T, "object_id": f"id-{i}",
                       "payload": {**TX_T["payload"], "operation_id": f"id-{i}"}})
           for i in reversed(range(6))]
    _write_files(f"{tmp_root}/feed2", [dup])
    recs = spark.read.text(feed).unionByName(spark.read.text(f"{tmp_root}/feed2"))
    paths = TablePaths.under(f"{tmp_root}/bf")
    backfill(recs, FanOutSink(paths), run_id="bf1")
    backfill(recs, FanOutSink(paths), run_id="bf1")  # re-run replaces itself
    stream_paths = TablePaths.under(f"{tmp_root}/st")
    run_collector(record_stream(spark, feed, fmt="text"), FanOutSink(stream_paths),
                  f"{tmp_root}/ck")
    a = read_partitioned(spark, paths.raw, RAW_TABLE).select("object_id", "object_type", "payload")
    b = read_partitioned(spark, stream_paths.raw, RAW_TABLE).select("object_id", "object_type", "payload")
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.count() == 7
    assert [r.raw_value for r in spark.read.parquet(paths.rejects).collect()] == ["not json"]


def test_backfill_keeps_its_ingest_time_when_run_again(spark, tmp_root):
    from txlake.streaming import backfill
    recs = spark.read.text(_tx_records(6, tmp_root))
    paths = TablePaths.under(f"{tmp_root}/bf")
    for day, hour in ((1, 10), (1, 11), (2, 3)):  # another hour, another day
        backfill(recs, FanOutSink(paths), run_id="bf1", now=dt.datetime(2024, 5, day, hour))
    raw = read_partitioned(spark, paths.raw, RAW_TABLE)
    assert raw.count() == 7
    for path in (paths.raw, paths.transactions, paths.rejects):
        stamps = spark.read.parquet(path).select("date", "hour").distinct().collect()
        assert [(str(r.date), r.hour) for r in stamps] == [("2024-05-01", 10)]
    assert raw.select("trigger_dttm").distinct().count() == 1
    backfill(recs, FanOutSink(paths), run_id="bf2", now=dt.datetime(2024, 5, 3))
    assert read_partitioned(spark, paths.raw, RAW_TABLE).count() == 14


@pytest.mark.parametrize("mode", ["watermark_first", "within_watermark", "finalized"])
def test_rejects_and_timeless_messages_pass_beside_the_state(spark, tmp_root, mode):
    bad = ["not json"] * 3 + [json.dumps({**TX_T, "object_id": None})]
    timeless = [_msg("t1", "10:00:00.123"), json.dumps({"object_id": "t2", "object_type": "x", "sent_dttm": None})]
    feed = [[*rows, *bad, *timeless] for rows in FEED]
    feed[0] += [json.dumps({**TX_T, "object_id": o, "sent_dttm": t}) for o, t in
                (("first", "0001-01-01T00:00:00"),)]
    _write_files(f"{tmp_root}/feed", feed)
    paths = TablePaths.under(f"{tmp_root}/tables")
    q = run_collector(record_stream(spark, f"{tmp_root}/feed", fmt="text", max_files_per_trigger=1),
                      FanOutSink(paths), f"{tmp_root}/ck", watermark_delay="1 minute", dedup_mode=mode)
    assert spark.read.parquet(paths.rejects).count() == 5 * len(bad)
    raw = read_partitioned(spark, paths.raw, RAW_TABLE)
    assert raw.where("sent_dttm is null").count() == 5 * len(timeless)
    assert raw.where("object_id = 'first'").count() == 1
    state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["numInputRows"] > 0]
    assert max(state) <= 4  # messages with a time only


def test_distinct_malformed_messages_stay_distinct(spark, tmp_root):
    bad = ["not json", "also not json", "[1, 2]", "not json"]
    _write_files(f"{tmp_root}/feed", [bad + [json.dumps(TX_T)]])
    paths = TablePaths.under(f"{tmp_root}/t")
    run_collector(record_stream(spark, f"{tmp_root}/feed", fmt="text"), FanOutSink(paths),
                  f"{tmp_root}/ck")
    rejects = sorted(r.raw_value for r in spark.read.parquet(paths.rejects).collect())
    assert rejects == ["[1, 2]", "also not json", "not json", "not json"]  # equal ones too
    assert read_partitioned(spark, paths.raw, RAW_TABLE).count() == 1


def test_null_type_reaches_raw_and_key_has_three_columns(spark, tmp_root):
    rows = [json.dumps({**TX_T, "object_type": None}),
            json.dumps(TX_T),
            json.dumps({**TX_T, "sent_dttm": "2021-03-09T05:42:18"}),  # new key
            json.dumps(TX_T)]                                          # copy
    _write_files(f"{tmp_root}/feed", [rows])
    paths = TablePaths.under(f"{tmp_root}/t")
    run_collector(record_stream(spark, f"{tmp_root}/feed", fmt="text"), FanOutSink(paths),
                  f"{tmp_root}/ck")
    raw = read_partitioned(spark, paths.raw, RAW_TABLE)
    got = sorted((r.object_type or "", str(r.sent_dttm)) for r in raw.collect())
    assert got == [("", "2021-03-09 05:42:17"), ("transaction", "2021-03-09 05:42:17"),
                   ("transaction", "2021-03-09 05:42:18")]
    assert read_partitioned(spark, paths.transactions, CLEAN_TRANSACTIONS).count() == 2


@pytest.mark.parametrize("mode,predup", [("within_watermark", False),
                                         ("watermark_first", False)])
def test_collector_takes_dedup_mode_and_predup(spark, tmp_root, mode, predup):
    """The collector's own entry point passes the dedup mode and the
    pre-dedup switch through; every mode keeps one row per message here."""
    _write_files(f"{tmp_root}/feed", FEED)
    paths = TablePaths.under(f"{tmp_root}/tables")
    run_collector(record_stream(spark, f"{tmp_root}/feed", fmt="text"), FanOutSink(paths),
                  f"{tmp_root}/ck", watermark_delay="1 minute", dedup_mode=mode,
                  predup=predup)
    raw = read_partitioned(spark, paths.raw, RAW_TABLE)
    assert sorted(r.object_id for r in raw.collect()) == ["a", "b", "c", "d", "e", "f", "late"]


def test_sink_preview_prints_schema_plan_and_rows(spark, tmp_root, capsys):
    _write_files(f"{tmp_root}/feed", FEED[:1])
    paths = TablePaths.under(f"{tmp_root}/tables")
    run_collector(record_stream(spark, f"{tmp_root}/feed", fmt="text"),
                  FanOutSink(paths, preview_rows=100), f"{tmp_root}/ck")
    out = capsys.readouterr().out
    assert "|-- object_id" in out and "Physical Plan" in out
    assert "2021-03-09 10:30:00" in out  # a shown row (message b)


def test_finalized_dedup_emits_each_message_once_after_the_watermark(spark, tmp_root):
    hot = [_msg("h", "10:00:05")] * 200  # one message, delivered 200 times
    feed = [FEED[0] + hot, *FEED[1:]]
    _write_files(f"{tmp_root}/feed", feed)
    out, prog = _run_collect(spark, f"{tmp_root}/feed", f"{tmp_root}/ck", "1 minute",
                             mode="finalized")
    emitted = [oid for b in sorted(out) for oid in out[b]]
    # each message once, the late one never; the two newest (13:00, 13:00:01)
    # are still ahead of the final watermark (12:59:01) and wait in state
    assert sorted(emitted) == ["a", "b", "c", "d", "h"]
    assert out[0] == []  # nothing is final before the watermark moves
    assert prog[-1]["stateOperators"][0]["numRowsTotal"] >= 2


def test_sink_writes_exact_rates(spark, tmp_root):
    from tests.fixtures import CUR, dumps
    _write_files(f"{tmp_root}/feed", [[dumps(CUR)]])
    paths = TablePaths.under(f"{tmp_root}/tables")
    run_collector(record_stream(spark, f"{tmp_root}/feed", fmt="text"),
                  FanOutSink(paths, exact_rates=True), f"{tmp_root}/ck")
    cur = spark.read.parquet(paths.currencies)
    assert dict(cur.dtypes)["currency_with_div"] == "decimal(18,6)"
    assert str(cur.first().currency_with_div) == "2.360000"


def test_finalized_dedup_combines_before_its_shuffle(spark, tmp_root, capsys):
    _write_files(f"{tmp_root}/feed", FEED[:1])
    plan = collector_plan(record_stream(spark, f"{tmp_root}/feed", fmt="text"),
                          watermark_delay="1 minute", dedup_mode="finalized")
    q = (plan.writeStream.format("noop").option("checkpointLocation", f"{tmp_root}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    capsys.readouterr()
    q.explain()
    text = capsys.readouterr().out
    # the tree prints top-down: the partial aggregate sits below the
    # stateful operator's exchange, and nothing runs in Python
    assert text.index("partial_min") > text.index("Exchange hashpartitioning")
    assert "StateStoreSave" in text and "Python" not in text
