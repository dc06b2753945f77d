"""The collector: records -> messages -> dedup -> fan-out sink.

``collector_plan`` is a pure transform (usable on a batch frame too);
``start_collector`` / ``run_collector`` are the only functions that start a
streaming query.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txlake.operators.envelope import decode_envelopes, normalize_messages
from txlake.operators.route import stamp_ingest_metadata
from txlake.schemas import (
    CURRENCY,
    DEDUP_KEYS,
    DEFAULT_FUTURE_TOLERANCE,
    DEFAULT_TRIGGER,
    TRANSACTION,
)
from txlake.streaming.dedup import dedup_stream
from txlake.streaming.sinks import FanOutSink


def collector_plan(records: DataFrame, watermark_delay: str | None = None,
                   keys=DEDUP_KEYS, observe_name: str | None = "collector_input",
                   value_col: str = "value", predup: bool = False,
                   dedup_mode: str = "watermark_first", late: bool = False,
                   future_tolerance: str | None = DEFAULT_FUTURE_TOLERANCE) -> DataFrame:
    """Decode, normalise, count (before dedup), deduplicate and stamp ingest
    time. The stamp is ``current_timestamp()`` inside the streaming plan, so
    a retried micro-batch sees the same value and the same partitions.

    Under an event-time watermark, messages dated more than
    ``future_tolerance`` after their ingest time are rejects
    (``future_time``): the clock the watermark follows never runs ahead of the
    wall clock by more. ``late`` is for a sink that keeps the late rows (see
    ``dedup_stream``)."""
    guard = None
    if watermark_delay is not None and future_tolerance and dedup_mode != "bounded":
        guard = F.current_timestamp() + F.expr(f"INTERVAL {future_tolerance}")
    msgs = normalize_messages(decode_envelopes(records, value_col), not_after=guard)
    if observe_name:
        msgs = msgs.observe(
            observe_name,
            F.count(F.lit(1)).alias("input_rows"),
            F.count(F.col("reject_reason")).alias("rejected_rows"),
            # well-formed messages of a type no typed table takes (raw only)
            F.count(F.when(F.col("reject_reason").isNull()
                           & ~F.coalesce(F.col("object_type").isin(TRANSACTION, CURRENCY),
                                         F.lit(False)), 1)).alias("unrouted_rows"),
        )
    if dedup_mode == "bounded":
        # its state time is the ingest stamp
        out = dedup_stream(stamp_ingest_metadata(msgs), keys, watermark_delay, mode=dedup_mode)
    else:
        out = stamp_ingest_metadata(
            dedup_stream(msgs, keys, watermark_delay, predup=predup, mode=dedup_mode, late=late))
    if observe_name:
        through = F.when(~F.col("_side"), 1) if "_side" in out.columns else F.lit(1)
        out = out.observe("collector_output", F.count(through).alias("rows_out"))
    return out


def start_collector(records: DataFrame, sink: FanOutSink, checkpoint: str,
                    query_name: str | None = None, trigger: str = DEFAULT_TRIGGER,
                    available_now: bool = False,
                    watermark_delay: str | None = None,
                    dedup_mode: str = "watermark_first",
                    predup: bool = False,
                    future_tolerance: str | None = DEFAULT_FUTURE_TOLERANCE) -> StreamingQuery:
    """Start the collector on a streaming frame of records (``dedup_mode``
    and ``predup`` as in ``dedup_stream``). Late rows, which a watermark
    drops, go to the sink's late table."""
    plan = collector_plan(records, watermark_delay, predup=predup,
                          dedup_mode=dedup_mode, late=True,
                          future_tolerance=future_tolerance)
    sink.follow(checkpoint, exact=dedup_mode == "bounded")
    w = plan.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now \
        else w.trigger(processingTime=trigger)
    return w.start()


def run_collector(records: DataFrame, sink: FanOutSink, checkpoint: str,
                  watermark_delay: str | None = None,
                  timeout_s: float | None = None,
                  dedup_mode: str = "watermark_first",
                  predup: bool = False) -> StreamingQuery:
    """Process everything available now and stop (backfills, tests)."""
    q = start_collector(records, sink, checkpoint, available_now=True,
                        watermark_delay=watermark_delay, dedup_mode=dedup_mode,
                        predup=predup)
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise q.exception()
    return q


def backfill(records: DataFrame, sink: FanOutSink, run_id: str = "backfill",
             keys=DEDUP_KEYS, value_col: str = "value",
             now: dt.datetime | None = None) -> None:
    """Replay a batch of records (e.g. a topic dump) into the collector's
    tables in one batch job.

    History replayed in file order through a watermark would drop every
    out-of-order row as late, so a backfill deduplicates in batch instead:
    ``dedup_exact`` (a partial aggregate, safe for hot keys; rejects pass it
    by), then the same writer, under ``stream_id = run_id`` and
    ``batch_id = 0``.

    A run has one ingest time: that of its first start, kept in a small table
    beside the raw layer (``_runs/<run_id>``; ``now`` sets it, for tests). A
    re-run reads it back and so replaces its own output, whenever it runs.
    The deduplicated batch is written once under the shared folder, and the
    four tables are written from there.
    """
    from txlake.operators.dedup import dedup_exact
    from txlake.session import scratch_path

    spark = records.sparkSession
    stamp = _run_stamp(spark, f"{sink.paths.runs}/{run_id}", now)
    msgs = normalize_messages(decode_envelopes(records, value_col))
    bad = F.col("reject_reason").isNotNull()
    once = dedup_exact(msgs.where(~bad), keys).unionByName(msgs.where(bad))
    staged = scratch_path(spark, f"backfill-{run_id}")
    once.write.parquet(staged)
    batch = stamp_ingest_metadata(spark.read.schema(once.schema).parquet(staged),
                                  trigger=F.timestamp_micros(F.lit(stamp))).withColumns({
        "stream_id": F.lit(run_id),
        "batch_id": F.lit(0).cast("long"),
    })
    sink.write_batch(batch)


def _run_stamp(spark, path: str, now: dt.datetime | None) -> int:
    """The ingest time of a run, in microseconds: read back if the run has
    one, else ``now`` (default: the clock), written for its re-runs."""
    schema = "stamp long"
    at = now or dt.datetime.now(dt.timezone.utc)
    if at.tzinfo is None:
        at = at.replace(tzinfo=dt.timezone.utc)
    micros = (at - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    # "ignore" leaves a stamp that is there; one row
    spark.createDataFrame([(micros,)], schema).coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path).first()["stamp"]
