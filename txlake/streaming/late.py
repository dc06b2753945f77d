"""Late rows of a watermarked stream, kept instead of dropped.

A stateful operator drops rows at or before the watermark it was given for late
events: that of the micro-batch before. Spark writes each batch's watermark to
the query's offset log before the batch runs, so a ``foreachBatch`` callback can
read it there -- after a restart too -- and tell the late rows of the batch
exactly, whatever the dedup mode.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def late_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int | None:
    """Watermark, in epoch milliseconds, at or before which batch ``batch_id``
    drops rows; None while there is none (the first batch)."""
    if batch_id == 0:
        return None
    lines = [r.value for r in
             spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id - 1}").collect()]
    for line in lines:
        if "batchWatermarkMs" in line:
            ms = int(json.loads(line)["batchWatermarkMs"])
            return ms or None
    return None


def late_split(batch: DataFrame, checkpoint: str, batch_id: int,
               event_time: str = "sent_dttm") -> DataFrame:
    """A batch of ``dedup_stream(late=True)`` with ``_side`` true for exactly
    the late rows, and ``_watermark`` they were late for."""
    ms = late_watermark(batch.sparkSession, checkpoint, batch_id)
    mark = F.lit(None).cast("timestamp") if ms is None else F.timestamp_millis(F.lit(ms))
    return (batch.withColumn("_watermark", mark)
            .where(~F.col("_side") | F.coalesce(F.col(event_time) <= F.col("_watermark"), F.lit(False))))
