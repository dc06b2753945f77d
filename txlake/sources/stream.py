"""File-backed record streams (the offline stand-in for a topic)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RECORD = T.StructType([T.StructField("value", T.StringType())])


def record_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None,
                  schema: T.StructType = RECORD) -> DataFrame:
    """Streaming frame of records with a ``value`` column.

    ``fmt="text"`` reads one JSON envelope per line; ``parquet`` / ``json``
    read files with a ``value`` column. ``max_files_per_trigger`` is the
    file-source form of admission control.
    """
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        return r.text(path)
    return r.schema(schema).format(fmt).load(path)
