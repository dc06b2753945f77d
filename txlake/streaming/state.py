"""What a streaming query's state holds, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_keys(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The keys (and ``value``) a stateful query held after a micro-batch
    (default: the last). Spark's state reader opens the store's files, a task
    per state partition; the query need not run."""
    r = spark.read.format("statestore")
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    return r.load(checkpoint).select("key.*", "value")


def state_sizes(spark: SparkSession, checkpoint: str, batches: range) -> DataFrame:
    """batch_id, state_rows: how many keys were held after each batch."""
    out = None
    for b in batches:
        one = (state_keys(spark, checkpoint, b).agg(F.count(F.lit(1)).alias("state_rows"))
               .select(F.lit(b).cast("long").alias("batch_id"), "state_rows"))
        out = one if out is None else out.unionByName(one)
    return out


def unfinalized(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Messages a ``finalized`` dedup still holds back when its feed has ended:
    the watermark never passes the newest ones. To be written once, after the
    query's last run."""
    left = state_keys(spark, checkpoint)
    return left.select(*[c for c in left.columns if c != "value"], "value.min.*")
