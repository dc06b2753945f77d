"""Idempotent partitioned Parquet writers and the per-micro-batch fan-out.

``foreachBatch`` is at-least-once: a batch whose callback fails (or whose
commit is lost) runs again with the same offsets. Appending would duplicate
its rows. Here every table is partitioned down to (stream_id, batch_id) and
written with *dynamic partition overwrite*, so a re-run replaces exactly the
files of its own batch. ``stream_id`` is the query id, which is stable across
restarts of one checkpoint; a fresh checkpoint gets a new id and so cannot
overwrite the batches of an older run whose batch ids restart at 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.operators.envelope import split_rejects
from txlake.operators.route import clean_currencies, clean_transactions
from txlake.schemas import CLEAN_PARTITIONS, RAW_PARTITIONS
from txlake.sources.manifest import commit, has_entry, put_entry
from txlake.streaming.keys import drop_known, remember
from txlake.streaming.late import late_split

#: Upper bound on rows per output file, so a large batch never makes one
#: huge file per task and partition.
DEFAULT_MAX_RECORDS_PER_FILE = 2_000_000

#: A sized write gives a task at most so many rows of files smaller than that,
#: and up to so many files a task each.
TASK_ROWS = 1 << 16
FEW_TASKS = 64


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
                      fmt: str = "parquet") -> None:
    """Write ``df`` replacing only the partitions present in ``df``.

    No shuffle: every task writes its own files for the partition values it
    holds. The number of files per partition is bounded by the number of
    input tasks (the source's split count) and ``maxRecordsPerFile``.
    """
    (df.write.format(fmt)
     .mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file)
     # tasks put their files into the staged folders themselves; the driver
     # only moves whole partitions
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .partitionBy(*partition_cols)
     .save(path))


def write_sized(df: DataFrame, path: str, partition_cols: Sequence[str],
                rows_per_file: int) -> list[Row]:
    """``write_partitioned`` with the file count under control: a partition of
    n rows becomes exactly ceil(n / ``rows_per_file``) files.

    The rows of each partition are counted first (a partial aggregate) and
    numbered by hash, in buckets of about ``TASK_ROWS`` (a shuffle); a row's
    number names its file, of equal sizes. A second shuffle deals the files to
    tasks: one each while they are few or large, else up to ``TASK_ROWS`` rows
    of files that follow each other, which the task cuts at ``rows_per_file``
    (only the last of a task's files of a partition is smaller). So the number
    of tasks follows the rows, not the files, and a hot partition still is
    written by many tasks. The counts, one row per folder being written and one
    per bucket, are broadcast. Returns the partitions written.
    """
    parts = list(partition_cols)
    sizes = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("_rows")).collect()
    if not sizes:
        return []
    spark = df.sparkSession
    n_files = [-(-r["_rows"] // rows_per_file) for r in sizes]
    first = [0, *accumulate(n_files)]
    few = max(FEW_TASKS, 4 * spark.sparkContext.defaultParallelism)
    per_task = max(1, min(TASK_ROWS // rows_per_file, -(-first[-1] // few)))
    schema = T.StructType([df.schema[p] for p in parts] + [
        T.StructField(c, T.LongType()) for c in ("_rows", "_files", "_first", "_buckets")])
    counts = spark.createDataFrame(
        [(*r, k, a, -(-r["_rows"] // TASK_ROWS)) for r, k, a in zip(sizes, n_files, first, strict=False)], schema).select(
        *[F.col(p).alias(f"_p_{p}") for p in parts], "_rows", "_files", "_first", "_buckets")
    same = F.lit(True)
    for p in parts:
        same = same & F.col(p).eqNullSafe(F.col(f"_p_{p}"))
    others = [c for c in df.columns if c not in parts]
    keyed = (df.join(F.broadcast(counts), same).withColumn("_hash", F.xxhash64(*others))
             .withColumn("_bucket", F.pmod("_hash", "_buckets")))
    # rows of the partition in the buckets before; only large ones have several
    before: dict[int, int] = {}
    starts = []
    if any(r["_rows"] > TASK_ROWS for r in sizes):
        for r in keyed.where("_buckets > 1").groupBy("_first", "_bucket").count().orderBy("_first", "_bucket").collect():
            starts.append((r["_first"], r["_bucket"], before.get(r["_first"], 0)))
            before[r["_first"]] = before.get(r["_first"], 0) + r["count"]
    offsets = spark.createDataFrame(starts, "_first long, _bucket long, _before long")
    number = (F.row_number().over(Window.partitionBy("_first", "_bucket").orderBy("_hash")) - 1
              + F.coalesce("_before", F.lit(0)))
    dealt = (keyed.join(F.broadcast(offsets), ["_first", "_bucket"], "left").withColumn("_number", number)
             .withColumn("_task", F.floor((F.col("_first") + F.expr("_number * _files div _rows")) / per_task).cast("int")))
    write_partitioned(dealt.repartitionById(-(-first[-1] // per_task), "_task").select(*df.columns), path, parts, rows_per_file)
    return [Row(**{p: r[p] for p in parts}) for r in sizes]


@dataclass(frozen=True)
class TablePaths:
    """Output locations of the collector."""

    raw: str
    transactions: str
    currencies: str
    rejects: str
    #: ingest times of backfill runs, one small table per run id
    runs: str
    #: rows a watermark's dedup dropped as late
    late: str
    #: keys of all messages, for the exact dedup over bounded state
    keys: str

    @classmethod
    def under(cls, root: str) -> "TablePaths":
        root = root.rstrip("/")
        return cls(f"{root}/raw", f"{root}/clean/transactions",
                   f"{root}/clean/currencies", f"{root}/rejects", f"{root}/_runs",
                   f"{root}/late", f"{root}/_keys")


class FanOutSink:
    """``foreachBatch`` callback writing one micro-batch to four tables.

    The batch is computed once (persisted MEMORY_AND_DISK, released in
    ``finally`` on the *same* handle), then split into rejects, the raw
    layer and the two typed tables.
    """

    def __init__(self, paths: TablePaths, date_only_currency: bool = False,
                 exact_rates: bool = False,
                 max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
                 concurrent_writes: bool = True,
                 preview_rows: int = 0,
                 rows_per_file: int | None = None,
                 manifest: bool = False,
                 key_hours: int = 1):
        self.paths = paths
        # file counts: by size (one more shuffle), or by the input's tasks
        self.rows_per_file = rows_per_file
        # whether each table keeps a list of its files (needs rows_per_file)
        self.manifest = manifest
        if manifest and not rows_per_file:
            raise ValueError("a manifest is kept by sized writes: give rows_per_file")
        # event hours that share a folder of the key table
        self.key_hours = key_hours
        # development aid: print each batch's schema, plan and first rows
        self.preview_rows = preview_rows
        self.date_only_currency = date_only_currency
        self.exact_rates = exact_rates
        self.max_records_per_file = max_records_per_file
        # the four writes are independent jobs over the cached batch; submit
        # them together so the scheduler can overlap them
        self.concurrent_writes = concurrent_writes
        self.checkpoint: str | None = None
        self.exact = False

    def follow(self, checkpoint: str, exact: bool = False) -> None:
        """The query this sink belongs to: where its watermarks are logged, and
        whether older keys are looked up in the key table."""
        self.checkpoint, self.exact = checkpoint, exact

    @staticmethod
    def stream_id(df: DataFrame) -> str:
        sc = df.sparkSession.sparkContext
        return sc.getLocalProperty("sql.streaming.queryId") or "batch"

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        stream = self.stream_id(df)
        if "_side" in df.columns:
            df = late_split(df, self.checkpoint, batch_id)
        batch = df.withColumns({
            "stream_id": F.lit(stream),
            "batch_id": F.lit(batch_id).cast("long"),
        })
        held = [batch.persist(StorageLevel.MEMORY_AND_DISK)]
        try:
            # no-data batches (run to evict watermarked state) write nothing
            if not batch.isEmpty():
                if self.exact:
                    batch = drop_known(batch, self.paths.keys, stream, batch_id, hours=self.key_hours)
                    held.append(batch.persist(StorageLevel.MEMORY_AND_DISK))
                if self.preview_rows:
                    self.preview(batch)
                self.write_batch(batch)
        finally:
            for df in held:
                df.unpersist()

    def preview(self, batch: DataFrame) -> None:
        """Schema, formatted plan and the first ``preview_rows`` rows of a
        batch, printed on the driver (a bounded ``limit``; for development)."""
        batch.printSchema()
        batch.explain("formatted")
        batch.show(self.preview_rows, truncate=False)

    def write_batch(self, batch: DataFrame) -> None:
        late = None
        if "_side" in batch.columns:
            late = batch.where("_side").select("object_id", "object_type", "sent_dttm", "payload", "trigger_dttm",
                                               F.col("_watermark").alias("watermark"), *CLEAN_PARTITIONS)
            batch = batch.where("not _side").drop("_side", "_watermark")
        good, rejects = split_rejects(batch) if "reject_reason" in batch.columns \
            else (batch, None)
        n = self.max_records_per_file
        raw = good.select("object_id", "sent_dttm", "payload", "trigger_dttm",
                          *RAW_PARTITIONS)
        writes = [
            (raw, self.paths.raw, RAW_PARTITIONS),
            (clean_transactions(good), self.paths.transactions, CLEAN_PARTITIONS),
            (clean_currencies(good, date_only=self.date_only_currency,
                              exact_rate=self.exact_rates),
             self.paths.currencies, CLEAN_PARTITIONS),
        ]
        if rejects is not None:
            writes.append((rejects, self.paths.rejects, CLEAN_PARTITIONS))
        if late is not None:
            writes.append((late, self.paths.late, CLEAN_PARTITIONS))
        if self.exact:
            # before the tables: a batch that fails between them runs again and
            # does not see its own keys
            remember(good, self.paths.keys, hours=self.key_hours)
        stamp = batch.select("stream_id", "batch_id").first() if self.manifest else None

        def write(df: DataFrame, path: str, parts: Sequence[str], n: int) -> None:
            if not self.rows_per_file:
                write_partitioned(df, path, parts, n)
                return
            written = write_sized(df, path, parts, self.rows_per_file)
            if self.manifest:
                # a batch that runs again replaces its entry with its files
                commit(df.sparkSession, path, f"{stamp.stream_id}-{stamp.batch_id}", written)
        if not self.concurrent_writes:
            for df, path, parts in writes:
                write(df, path, parts, n)
            return
        from concurrent.futures import ThreadPoolExecutor

        from pyspark import inheritable_thread_target

        # inherit the callback thread's local properties and job tags
        target = inheritable_thread_target(batch.sparkSession)(write)
        with ThreadPoolExecutor(max_workers=len(writes)) as pool:
            futures = [pool.submit(target, df, path, parts, n)
                       for df, path, parts in writes]
            for f in futures:
                f.result()  # re-raise the first failure: the batch is retried


def publish_envelopes(envelopes: DataFrame, path: str | None = None,
                      kafka=None, fmt: str = "text", run_id: str | None = None,
                      log: str | None = None) -> int:
    """Publish a frame of envelopes (column ``value``) and return how many
    were sent.

    One distributed write -- every task sends its own rows -- to a Kafka
    topic (``kafka``: ``KafkaSettings``) or to a folder (``text``: one JSON
    envelope per line, the offline stand-in for a topic). The count comes
    from an ``observe`` on the write itself, not from a second pass.

    With ``run_id`` a run is published once: its count is recorded in ``log``
    (default: ``_published`` in the folder) when the write is done, and a run
    that is recorded sends nothing again. A folder's run writes to a folder of
    its own, so an attempt that failed half way is replaced; what a failed
    attempt sent to Kafka stays there, for the collector's dedup to drop.
    """
    from pyspark.sql import Observation

    spark = envelopes.sparkSession
    if kafka is None and path is None:
        raise ValueError("give a folder or Kafka settings")
    log = log or (f"{path}/_published" if path else None)
    if run_id and not log:
        raise ValueError("a run published to Kafka needs a log folder")
    if run_id and has_entry(spark, log, run_id):
        return int(spark.read.schema("sent long").json(f"{log}/{run_id}.json").first()["sent"])
    obs = Observation("published")
    out = envelopes.select("value").observe(obs, F.count(F.lit(1)).alias("sent"))
    if kafka is not None:
        out.write.format("kafka").options(**kafka.writer_options()).save()
    elif run_id:
        out.write.mode("overwrite").format(fmt).save(f"{path}/run_id={run_id}")
    else:
        out.write.mode("append").format(fmt).save(path)
    sent = int(obs.get["sent"])
    if run_id:
        put_entry(spark, log, run_id, [{"sent": sent}])
    return sent
