"""The sink's own list of a table's files.

A partitioned table grows a folder per partition and micro-batch, and a reader
that lists the table pays for all of them. A manifest is a folder of small
entries, ``_manifest/<name>.json``, each naming the files one writing added and
those it replaced. An entry appears by a rename, so a reader sees all of a
writing or nothing: that is what makes a compaction atomic. Readers filter the
entries by partition and open only the files they name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = "op string, file string, bytes long, part map<string,string>"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def folder_of(spark: SparkSession, part: dict) -> str:
    """Folder of a partition below its table, escaped as Spark's writer does."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(name(k, None if v is None else str(v)) for k, v in part.items())


def put_entry(spark: SparkSession, folder: str, name: str, lines: Iterable[dict]) -> None:
    """Writes ``folder/name.json``, a line per dict: beside its place first and
    renamed there, so that readers see all of it or nothing. An entry of that
    name, from an earlier attempt, is replaced."""
    fs = _fs(spark, folder)
    there = _path(spark, f"{folder}/{name}.json")
    aside = _path(spark, f"{folder}/.{name}-{uuid.uuid4().hex[:8]}")
    out = fs.create(aside)
    out.write("".join(json.dumps(x) + "\n" for x in lines).encode())
    out.close()
    if not fs.rename(aside, there):
        fs.delete(there, False)
        fs.rename(aside, there)


def has_entry(spark: SparkSession, folder: str, name: str) -> bool:
    return _fs(spark, folder).exists(_path(spark, f"{folder}/{name}.json"))


def _files_in(spark: SparkSession, path: str, parts: Iterable[dict]) -> list[dict]:
    """The files in the folders of ``parts``: Spark lists them, and no file is
    opened, as their contents are not asked for."""
    of = {folder_of(spark, part): {k: None if v is None else str(v) for k, v in part.items()} for part in parts}
    if not of:
        return []
    found = []
    files = spark.read.format("binaryFile").load([f"{path}/{folder}" for folder in of])
    for r in files.select("path", "length").collect():
        names = r.path.split("/")
        for depth in {folder.count("/") + 1 for folder in of}:
            folder = "/".join(names[-depth - 1:-1])
            if folder in of:
                found.append({"op": "add", "file": f"{folder}/{names[-1]}", "bytes": r.length, "part": of[folder]})
    return found


def commit(spark: SparkSession, path: str, name: str, parts: Iterable[Row],
           replaced: Sequence[str] = ()) -> None:
    """Enters the files now in the folders of ``parts`` (rows of the partition
    columns; a writing knows its own), in place of the files ``replaced``."""
    added = _files_in(spark, path, [p.asDict() for p in parts])
    put_entry(spark, f"{path}/_manifest", name, [*added, *({"op": "remove", "file": f} for f in replaced)])


def live_files(spark: SparkSession, path: str, schema: T.StructType, parts: Sequence[str],
               where: Column | str | None = None) -> DataFrame:
    """file, bytes and the partition columns of every file the table holds now,
    filtered by partition."""
    entries = spark.read.schema(ENTRY).json(f"{path}/_manifest")
    gone = entries.where("op = 'remove'").select("file").distinct()
    live = entries.where("op = 'add'").select("file", "bytes", *[
        F.col("part")[p].cast(schema[p].dataType).alias(p) for p in parts])
    live = live.where(where) if where is not None else live
    return live.join(gone, "file", "left_anti")


def _open(spark: SparkSession, path: str, schema: T.StructType, files: Sequence[str]) -> DataFrame:
    """The rows of the named files. Spark looks at each of them in a job, by
    default of a task per file: here a few tasks a core look at many each."""
    tasks, n = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4 * spark.sparkContext.defaultParallelism
    default = spark.conf.get(tasks)
    spark.conf.set(tasks, str(min(n, int(default))))
    try:
        return (spark.read.schema(schema).option("basePath", path)
                .parquet(*[f"{path}/{f}" for f in files]))
    finally:
        spark.conf.set(tasks, default)


def read_manifest(spark: SparkSession, path: str, schema: T.StructType, parts: Sequence[str],
                  where: Column | str | None = None) -> DataFrame:
    """The rows of the partitions ``where`` chooses. Only the files named for
    them are looked at; no folder is listed."""
    files = [r.file for r in live_files(spark, path, schema, parts, where).select("file").collect()]
    return _open(spark, path, schema, files) if files else spark.createDataFrame([], schema)


def compact(spark: SparkSession, path: str, schema: T.StructType, parts: Sequence[str],
            merge: dict[str, Column], rows_per_file: int,
            where: Column | str | None = None) -> str:
    """Rewrites the partitions ``where`` chooses with the partition columns in
    ``merge`` set to one value each (say ``batch_id``), so that their small
    folders become one, of evenly sized files. Readers of the manifest see the
    old files until the entry appears, then the new ones. Returns its name.
    For partitions nothing is written to any more."""
    from txlake.streaming.sinks import write_sized

    old = [r.file for r in live_files(spark, path, schema, parts, where).select("file").collect()]
    name = f"compact-{uuid.uuid4().hex[:12]}"
    if not old:
        return name
    rows = _open(spark, path, schema, old).withColumns(merge)
    written = write_sized(rows, path, parts, rows_per_file)
    commit(spark, path, name, written, replaced=old)
    return name


def vacuum(spark: SparkSession, path: str) -> int:
    """Deletes the files that entries replaced, once no reader of the old list
    is left; returns how many."""
    entries = spark.read.schema(ENTRY).json(f"{path}/_manifest")
    fs, n = _fs(spark, path), 0
    for r in entries.where("op = 'remove'").select("file").distinct().toLocalIterator():
        n += bool(fs.delete(_path(spark, f"{path}/{r.file}"), False))
    return n
