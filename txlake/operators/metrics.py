"""Frame metrics: shape and distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shape(df: DataFrame, label: str | None = None) -> DataFrame:
    """One row: ``rows`` (a count aggregate) and ``columns``."""
    out = df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("int"))
    return out.withColumn("frame", F.lit(label)).select("frame", "rows", "columns") \
        if label is not None else out


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column (a two-phase hash aggregate)."""
    return df.select(col).distinct()
