"""Batch deduplication and the late-arrival audit.

The streaming forms (stateful ``dropDuplicates`` with a watermark) live in
``txlake.streaming.dedup``; these are their batch counterparts, used for
backfills and as oracles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.schemas import DEDUP_KEYS


def dedup_exact(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """One row per key; the survivor is the least of the other columns.

    A hash aggregate with ``min(struct(...))``: deterministic, and partial
    aggregation collapses copies map-side, so a key holding a large share of
    the rows costs one row per task in the shuffle, not all of its copies.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    return (df.groupBy(*keys)
            .agg(F.min(F.struct(*others)).alias("_r"))
            .select(*keys, "_r.*")
            .select(*df.columns))


def late_arrivals(arrivals: DataFrame, batch_col: str, time_col: str,
                  delay_seconds: float, lag: int = 1) -> DataFrame:
    """Flag rows a watermark-first streaming dedup drops as late.

    A row of arrival batch ``n`` is late iff its event time is at or before
    ``max(event time over batches <= n - lag) - delay`` (the watermark is kept
    in milliseconds). ``lag=1`` is a query that advances its watermark between
    arrivals (no-data batches, or one trigger per arrival); ``lag=2`` is a
    single run with one batch per trigger and no idle batches between them.

    Only the per-batch maxima (one row per batch) are windowed and joined
    back: one partial aggregation plus a broadcast join. The broadcast side
    has exactly one row per arrival batch (a timestamp and an id), so its
    size is bounded by the batch count, never by the data; a shuffle join on
    the batch id instead would put each whole batch in one task.
    """
    per_batch = arrivals.groupBy(batch_col).agg(F.max(time_col).alias("_bmax"))
    w = Window.orderBy(batch_col).rowsBetween(Window.unboundedPreceding, -lag)
    wm = per_batch.select(
        batch_col,
        # watermark in whole milliseconds, as the engine keeps it
        F.timestamp_millis(
            F.unix_millis(F.max("_bmax").over(w))
            - F.lit(int(round(delay_seconds * 1000)))
        ).alias("_watermark"),
    )
    return (arrivals.join(F.broadcast(wm), batch_col, "left")
            .withColumn("is_late",
                        F.coalesce(F.col(time_col) <= F.col("_watermark"),
                                   F.lit(False)))
            .drop("_watermark"))
