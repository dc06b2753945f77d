"""Exploration operators: sequence numbers inside look-alike groups, membership
(semi-join) filters, exclusion filters, point lookups and top-k.

All are plain DataFrame plans. Null semantics follow SQL for joins; the
sequence number is null for a row with a null group key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.session import scratch_path

#: A group is "hot" when it holds more than 1 / (HOT_SHARE * partitions) of
#: the keyed rows. By counting, at most HOT_SHARE * partitions groups are
#: hot, whatever the data size; a cold group is at most 1 / HOT_SHARE of a
#: partition's fair share.
HOT_SHARE = 4


def _all_not_null(cols: Iterable[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def sequence_number(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    out: str = "row_number", skew_safe: bool = True,
                    num_partitions: int | None = None,
                    hot_share: int = HOT_SHARE) -> DataFrame:
    """Zero-based position (bigint: a hot group can pass 2**31 rows) of each
    row inside its group of ``keys``, in ``order`` (which should make rows of
    a group unique). Null when any key is null.

    ``skew_safe=False`` is the textbook ``row_number()`` window: one shuffle
    on the keys, but a group lives in one task, so a key holding a third of
    the rows makes one task do a third of the work.

    ``skew_safe=True`` (default) never puts a hot group in one task:

    1. find the hot groups (more than 1 / (``HOT_SHARE`` * partitions) of
       the keyed rows) with partial aggregates; there are at most
       ``HOT_SHARE`` * partitions of them, so tagging rows is a broadcast
       join of a table whose size does not grow with the data;
    2. cold rows: the textbook window, one hash shuffle on the keys; each
       cold group is at most 1 / ``HOT_SHARE`` of a partition's fair share;
    3. hot rows: one range exchange on (keys, order) cuts each hot group into
       contiguous slices across partitions; the hot rows are written with
       their slice to the shared folder. A hot row's number is its
       ``row_number`` in its slice plus a carry (the group's rows in earlier
       slices). The carry table has at most (hot groups + partitions) rows:
       a group spans a contiguous run of partitions and each partition
       boundary cuts at most one group. It is broadcast back, with that bound.

    ``hot_share`` trades the two bounds: a larger value keeps cold groups
    smaller (at most 1 / ``hot_share`` of a partition's share) and lets more
    groups be hot (at most ``hot_share`` * partitions rows to broadcast).

    Ties in ``order`` are numbered in an arbitrary order, as in a window.
    """
    keys, order = list(keys), list(order)
    if not order:
        raise ValueError("a sequence number needs an order (and a hot group "
                         "can only be cut by it)")
    w = Window.partitionBy(*keys).orderBy(*order)
    if not skew_safe:
        return df.withColumn(
            out, F.when(_all_not_null(keys),
                        (F.row_number().over(w) - 1).cast("long")))

    has_key = _all_not_null(keys)
    cols = df.columns
    keyed = df.where(has_key)
    nulls = df.where(~has_key).withColumn(out, F.lit(None).cast("long"))

    # an explicit width for the hot rows' range exchange: left to AQE, a small
    # input's ranges are merged back into one task and a hot group is not split
    n = num_partitions or int(
        df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    # 1. hot groups, at most hot_share * n rows by construction
    # (the threshold is a scalar subquery over the same sizes, so the sizes'
    # shuffle is computed once and reused)
    sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    limit = sizes.agg(F.sum("_size") / F.lit(hot_share * n)).scalar()
    hot = (sizes.where(F.col("_size") > limit)
           .select(*keys, F.lit(True).alias("_hot")))
    tagged = keyed.join(F.broadcast(hot), keys, "left")

    # 2. cold rows
    cold = (tagged.where(F.col("_hot").isNull())
            .withColumn(out, (F.row_number().over(w) - 1).cast("long"))
            .select(*cols, out))

    # 3. hot rows: the slice a row was dealt to becomes a column of a table
    # written once, so counts and numbers read the same slices whatever
    # columns each of them needs
    path = scratch_path(df.sparkSession, "sequence")
    (tagged.where(F.col("_hot")).drop("_hot").repartitionByRange(n, *keys, *order)
     .withColumn("_slice", F.spark_partition_id()).write.parquet(path))
    sliced = df.sparkSession.read.parquet(path)
    slice_keys = [*keys, "_slice"]
    carry = (sliced.groupBy(*slice_keys).agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_carry", F.coalesce(
                 F.sum("_n").over(Window.partitionBy(*keys).orderBy("_slice")
                                  .rowsBetween(Window.unboundedPreceding, -1)),
                 F.lit(0)))
             .select(*slice_keys, "_carry"))
    own = Window.partitionBy(*slice_keys).orderBy(*order)
    hot_rows = (sliced.withColumn("_own", F.row_number().over(own) - 1)
                .join(F.broadcast(carry), slice_keys, "inner")
                .withColumn(out, (F.col("_own") + F.col("_carry")).cast("long"))
                .select(*cols, out))
    return cold.unionByName(hot_rows).unionByName(nulls)


def deep_groups(df: DataFrame, key: str, threshold: int,
                seq_col: str = "row_number") -> DataFrame:
    """Distinct ``key`` values of rows whose sequence number exceeds
    ``threshold`` (the groups at least ``threshold + 2`` deep)."""
    return df.where(F.col(seq_col) > F.lit(threshold)).select(key).distinct()


def deep_keys(df: DataFrame, keys: Sequence[str], key: str,
              threshold: int) -> DataFrame:
    """The same set as ``deep_groups(sequence_number(df, keys, ..), key,
    threshold)`` -- ``key`` values of groups with a row numbered above
    ``threshold``, i.e. groups of more than ``threshold + 1`` rows -- from
    group sizes alone: a partial aggregate, no numbering, no sort."""
    keys = list(keys)
    sizes = df.where(_all_not_null(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_size"))
    return sizes.where(F.col("_size") > F.lit(threshold + 1)).select(key).distinct()


def semi_filter(df: DataFrame, members: DataFrame, key: str,
                member_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``members`` (a left-semi join;
    null keys never match). The member side is reduced to distinct keys
    first, so its size is the number of distinct keys, not rows."""
    mk = member_key or key
    m = members.select(F.col(mk).alias(key)).where(F.col(key).isNotNull()).distinct()
    return df.join(m, key, "left_semi")


def exclude_sentinel(df: DataFrame, col: str, sentinel=-1) -> DataFrame:
    """Drop rows equal to ``sentinel``; a null value is kept (null-safe)."""
    return df.where(~F.col(col).eqNullSafe(F.lit(sentinel)))


def exclude_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Drop rows whose ``col`` is one of ``values``; a null value is kept."""
    return df.where(~F.coalesce(F.col(col).isin(list(values)), F.lit(False)))


def point_lookup(df: DataFrame, col: str, value) -> DataFrame:
    """Rows with ``col == value`` (pushed to the scan as an equality filter)."""
    return df.where(F.col(col) == F.lit(value))


def _sort_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """First ``k`` rows by ``order`` ascending, nulls last. Planned as
    ``TakeOrderedAndProject``: each task keeps its own k best, the driver
    merges k rows per task -- no full sort, no shuffle of the data."""
    return df.orderBy(*_sort_cols(order)).limit(k)


def head_k(df: DataFrame, k: int, order: Sequence[str | Column] | None = None) -> DataFrame:
    """First ``k`` rows; deterministic when ``order`` is given (every column
    by default)."""
    return top_k(df, order if order is not None else df.columns, k)
