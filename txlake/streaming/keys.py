"""Exact deduplication over bounded state.

Every key ever seen has to be remembered, but not in the state store. The
stateful operator keeps the keys of the last ``recent`` time span by *ingest*
time, so no row is ever late for it, however old its event time, and its state
stays flat. Keys older than that are in a table laid out by event hour. A key
holds its event time, so a batch can only repeat keys of the event hours it
holds itself: only those folders are listed, read and joined. Files are sorted
by id and carry Parquet Bloom filters on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.schemas import DEDUP_KEYS

#: How long a key stays in state, by ingest time. It should exceed any step
#: back of the wall clock: a row stamped that much earlier would be dropped.
DEFAULT_RECENT = "10 minutes"

KEY_PARTITIONS = ("event_date", "event_hour", "stream_id", "batch_id")


def recent_dedup(messages: DataFrame, keys: Sequence[str] = DEDUP_KEYS,
                 recent: str = DEFAULT_RECENT) -> DataFrame:
    """Drops copies of what came within ``recent`` of ingest time
    (``trigger_dttm``). One reading: a reject gets a key of its own, so equal
    ones all pass."""
    bad = (F.col("reject_reason").isNotNull() if "reject_reason" in messages.columns else F.lit(False))
    # a seed per batch and task: a task that runs again draws the same ones
    own = F.when(bad, F.expr("uuid()"))
    return (messages.withColumn("_own", own).withWatermark("trigger_dttm", recent)
            .dropDuplicatesWithinWatermark([*keys, "_own"]).drop("_own"))


def _event_hour(event_time: str, hours: int) -> dict[str, Column]:
    """Folder of a key: ``hours`` event hours share one; messages without an
    event time have one of their own."""
    t = F.col(event_time)
    return {"event_date": F.coalesce(F.date_format(t, "yyyy-MM-dd"), F.lit("none")),
            "event_hour": F.coalesce((F.floor(F.hour(t) / hours) * hours).cast("int"), F.lit(-1))}


def drop_known(batch: DataFrame, path: str, stream_id: str, batch_id: int,
               keys: Sequence[str] = DEDUP_KEYS, event_time: str = "sent_dttm",
               hours: int = 1) -> DataFrame:
    """Rows of ``batch`` whose key no earlier batch wrote to the key table. A
    batch that runs again does not see what its failed attempt wrote. Rejects
    pass."""
    spark = batch.sparkSession
    placed = batch.withColumns(_event_hour(event_time, hours))
    held = placed.select("event_date", "event_hour").distinct().collect()
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f for f in (f"{path}/event_date={h.event_date}/event_hour={h.event_hour}" for h in held)
               if fs.exists(fs_path(f))]
    if not folders:
        return batch
    fields = [batch.schema[k] for k in keys] + [
        T.StructField("event_date", T.StringType()), T.StructField("event_hour", T.IntegerType()),
        T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType())]
    known = (spark.read.schema(T.StructType(fields)).option("basePath", path).parquet(*folders)
             .where(~((F.col("stream_id") == stream_id) & (F.col("batch_id") >= batch_id)))
             .select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    good = F.col("reject_reason").isNull() if "reject_reason" in batch.columns else F.lit(True)
    return batch.where(good).join(known, same, "left_anti").unionByName(batch.where(~good))


def remember(batch: DataFrame, path: str, keys: Sequence[str] = DEDUP_KEYS,
             event_time: str = "sent_dttm", hours: int = 1,
             rows_per_file: int = 2_000_000) -> None:
    """Adds the keys of a batch (with ``stream_id`` and ``batch_id``) to the
    key table, in place of its own earlier attempt's. Four tasks share a hot
    hour; adaptive execution merges them where a batch is small."""
    good = batch.where("reject_reason is null") if "reject_reason" in batch.columns else batch
    rows = good.withColumns(_event_hour(event_time, hours)).select(*keys, *KEY_PARTITIONS)
    (rows.repartition(*KEY_PARTITIONS[:2], F.pmod(F.xxhash64(*keys), F.lit(4)))
     .sortWithinPartitions(*KEY_PARTITIONS, keys[0])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option(f"parquet.bloom.filter.enabled#{keys[0]}", "true")
     .option("maxRecordsPerFile", rows_per_file)
     .partitionBy(*KEY_PARTITIONS).parquet(path))
