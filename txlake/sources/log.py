"""A file log with partitions and offsets: a topic where no broker is at hand.

Each append writes one segment per log partition and then an index entry (base
offset, count, times), which is what makes its records visible. Readers start at
the beginning, at an offset or at a time, as on a topic, and open only the
segments that can hold what they ask for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.operators.explore import sequence_number
from txlake.sources.manifest import has_entry, put_entry

INDEX = "segment string, partition int, base long, n long, min_ts long, max_ts long, trimmed boolean"


class DataLossError(RuntimeError):
    """An offset asked for is no longer in the log."""


@dataclass(frozen=True)
class FileLog:
    """The log under ``path``; records keep the columns they are appended with
    (``timestamp`` among them) and gain ``partition`` and ``offset``."""

    spark: SparkSession
    path: str

    def _segments(self, trimmed: bool) -> list:
        """Index rows, one per segment and partition, with or without what was
        trimmed. They grow with the appends, not with the records."""
        folder = f"{self.path}/_index"
        if not has_entry(self.spark, folder, "start"):
            put_entry(self.spark, folder, "start", [])
        rows = self.spark.read.schema(INDEX).json(folder).collect()
        gone = set() if trimmed else {r.segment for r in rows if r.trimmed}
        return [r for r in rows if r.partition is not None and r.segment not in gone]

    def append(self, records: DataFrame, segment: str, partition: Column, order: list[str]) -> None:
        """Appends ``records`` as ``segment``, offsets ascending in ``order``
        within each partition. A segment that is there already is left alone,
        so an append that is tried again adds nothing. One writer at a time."""
        known = self._segments(trimmed=True)
        if any(r.segment == segment for r in known):
            return
        base: dict[int, int] = {}
        for r in known:
            base[r.partition] = max(base.get(r.partition, 0), r.base + r.n)
        numbered = sequence_number(records.withColumn("partition", partition.cast("int")), ["partition"], order, out="offset")
        # one row per log partition
        start = F.lit(0).cast("long")
        for p, n in base.items():
            start = F.when(F.col("partition") == p, F.lit(n).cast("long")).otherwise(start)
        folder = f"{self.path}/segment={segment}"
        (numbered.withColumn("offset", F.col("offset") + start)
         .write.mode("overwrite").partitionBy("partition").parquet(folder))
        counts = (self.spark.read.parquet(folder).groupBy("partition")
                  .agg(F.min("offset").alias("base"), F.count(F.lit(1)).alias("n"),
                       F.min(F.unix_millis("timestamp")).alias("min_ts"), F.max(F.unix_millis("timestamp")).alias("max_ts")).collect())
        put_entry(self.spark, f"{self.path}/_index", f"segment-{segment}",
                  [{"segment": segment, **r.asDict(), "trimmed": False} for r in counts])

    def trim(self, segment: str) -> None:
        """Retention: a segment is no longer readable."""
        put_entry(self.spark, f"{self.path}/_index", f"trim-{segment}", [{"segment": segment, "trimmed": True}])

    def _first_at(self, ms: int, live: list) -> dict[int, int]:
        """Per partition, the first offset whose time is at or after ``ms``."""
        held = sorted({r.segment for r in live if r.max_ts >= ms})
        if not held:
            return {}
        rows = (self._read(held).where(F.unix_millis("timestamp") >= ms)
                .groupBy("partition").agg(F.min("offset").alias("o")).collect())
        return {r.partition: r.o for r in rows}

    def _read(self, segments: list[str]) -> DataFrame:
        return (self.spark.read.option("basePath", self.path)
                .parquet(*[f"{self.path}/segment={s}" for s in segments]).drop("segment"))

    def tail(self, start: str | int | dict[int, int] = "beginning",
             fail_on_data_loss: bool = True) -> DataFrame:
        """Records from ``start``: ``"beginning"``, an offset on every
        partition, offsets by partition, or ``"s@<ms>"``, the first record at or
        after a time in epoch milliseconds. An offset that was trimmed away is
        an error, or, without ``fail_on_data_loss``, reads from the oldest
        record left."""
        live = self._segments(trimmed=False)
        parts = sorted({r.partition for r in live})
        oldest = {p: min(r.base for r in live if r.partition == p) for p in parts}
        if start == "beginning":
            wanted = oldest
        elif isinstance(start, str) and start[:2] == "s@":
            wanted = self._first_at(int(start[2:]), live)
        elif isinstance(start, dict):
            wanted = {p: start.get(p, oldest[p]) for p in parts}
        else:
            wanted = dict.fromkeys(parts, int(start))
        lost = {p: o for p, o in wanted.items() if o < oldest[p]}
        if lost and fail_on_data_loss:
            raise DataLossError(f"offsets {lost} were trimmed; the oldest are {oldest}")
        segments = sorted({r.segment for r in live if r.partition in wanted and r.base + r.n > wanted[r.partition]})
        if not segments:
            segments = sorted({r.segment for r in live})
            return self._read(segments).where("false")
        keep = F.lit(False)
        for p, o in wanted.items():
            keep = keep | ((F.col("partition") == p) & (F.col("offset") >= o))
        return self._read(segments).where(keep)
