"""Batch file readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread ``df`` over ``min_partitions`` (default: the session's
    default parallelism) only when its scan is badly under-split: at most
    half that many splits.

    A large table already has far more splits than cores and is returned
    untouched (no shuffle), and so is one that would keep at least half the
    cores busy (a full shuffle would cost more than it gains). A small file
    that is a single row group would otherwise run every downstream
    projection in one task.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if 2 * splits > target:
        return df
    # hash of a per-row id: even spread, and unlike round-robin no local
    # sort of the whole input before the exchange
    return df.repartition(target, F.monotonically_increasing_id())


def read_table(spark: SparkSession, sf_dir: str, name: str,
               balance: bool = False) -> DataFrame:
    """One of the driver's test tables (``{sf_dir}/{name}.parquet``);
    ``balance`` spreads it over the cores when the file is under-split
    (use it ahead of CPU-heavy projections such as JSON or hashing)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if balance else df


def read_parquet(spark: SparkSession, path: str,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet dump; selecting ``columns`` prunes the scan's ReadSchema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_in_order(spark: SparkSession, path: str,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet dump with each row's place in it: ``_file`` and ``_row``. A
    frame has no order of its own; these two are the input's, for numbering
    rows as they come."""
    df = spark.read.parquet(path)
    return df.select(*(columns or df.columns), F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.row_index").alias("_row"))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType,
                     where: Column | str | None = None) -> DataFrame:
    """A Hive-partitioned table read with an explicit schema (partition
    inference would turn a ``date`` text column into DATE). A predicate on
    partition columns becomes a ``PartitionFilters`` entry: only matching
    folders are read, though the whole table is listed
    (``manifest.read_manifest`` lists nothing)."""
    df = (spark.read.schema(schema)
          .option("basePath", path)
          .parquet(path))
    return df.where(where) if where is not None else df
