"""File counts, manifest, compaction, published runs, the file log."""

import os

import pytest
from pyspark.sql import functions as F

from txlake.schemas import RAW_PARTITIONS, RAW_TABLE
from txlake.sources.log import DataLossError, FileLog
from txlake.sources.manifest import commit, compact, live_files, read_manifest, vacuum
from txlake.streaming import FanOutSink, TablePaths, backfill
from txlake.streaming.sinks import publish_envelopes, write_partitioned, write_sized

PARTS = ("kind", "batch")


def table(spark, n=1000):
    # a third of all rows in one partition; a null and an odd partition value
    kind = (F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("k/="), F.col("id") % 5)))
    return spark.range(n).select("id", kind.alias("kind"), (F.col("id") % 4).cast("int").alias("batch"))


def files(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-"))


def test_sized_write_controls_the_file_count(spark, tmp_root):
    df = table(spark).withColumn("batch", F.lit(0)).repartition(8)
    write_sized(df, f"{tmp_root}/t", PARTS, 50)
    per = {}
    for f in files(f"{tmp_root}/t"):
        per.setdefault(os.path.dirname(f), []).append(f)
    sizes = {r.kind: r["count"] for r in df.groupBy("kind").count().collect()}
    assert sorted(map(len, per.values())) == sorted(-(-n // 50) for n in sizes.values())
    # the hot partition's files come from tasks of their own
    hot = next(v for k, v in per.items() if "hot" in k)
    assert len({os.path.basename(f).split("-")[1] for f in hot}) == len(hot) == 7
    back = spark.read.parquet(f"{tmp_root}/t")
    assert {(r.id, r.kind) for r in back.collect()} == {(r.id, r.kind) for r in df.collect()}
    assert write_sized(df.where("false"), f"{tmp_root}/t", PARTS, 50) == []


def test_sized_write_of_many_files_by_few_tasks(spark, tmp_root, monkeypatch):
    from txlake.streaming import sinks
    monkeypatch.setattr(sinks, "TASK_ROWS", 200)
    # equal rows too, whose hashes tell no files apart; several buckets a partition
    df = table(spark, 3000).unionByName(spark.range(900).select(F.lit(7).cast("long").alias("id"), F.lit("same").alias("kind"), F.lit(0).alias("batch")))
    df = df.withColumn("batch", F.lit(0)).repartition(8)
    write_sized(df, f"{tmp_root}/t", PARTS, 10)
    held = spark.read.parquet(f"{tmp_root}/t").groupBy("kind", F.col("_metadata.file_path").alias("f")).count().collect()
    sizes = {r.kind: r["count"] for r in df.groupBy("kind").count().collect()}
    assert {k: sum(r.kind == k for r in held) for k in sizes} == {k: -(-n // 10) for k, n in sizes.items()}
    assert max(r["count"] for r in held) <= 10
    tasks = {os.path.basename(f).split("-")[1] for f in files(f"{tmp_root}/t")}
    assert len(tasks) <= max(sinks.FEW_TASKS, 4 * spark.sparkContext.defaultParallelism) < len(held)
    back = spark.read.parquet(f"{tmp_root}/t").select("id", "kind").exceptAll(df.select("id", "kind"))
    assert back.isEmpty() and sum(r["count"] for r in held) == df.count()


def test_manifest_files_are_looked_at_by_few_tasks(spark, tmp_root):
    path, df = f"{tmp_root}/t", table(spark, 2000)
    part = df.withColumn("batch", F.lit(0)).withColumn("kind", F.lit("all"))
    n = 8 * spark.sparkContext.defaultParallelism
    write_partitioned(part.repartition(n), path, PARTS)
    commit(spark, path, "all", part.select(*PARTS).distinct().collect())
    conf = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    default, sc = spark.conf.get(conf), spark.sparkContext
    sc.setJobGroup("manifest-read", "")
    try:
        back = read_manifest(spark, path, df.schema, PARTS)
        # the jobs of reading the entries and of looking at the files
        stages = [sc.statusTracker().getStageInfo(s) for j in sc.statusTracker().getJobIdsForGroup("manifest-read")
                  for s in sc.statusTracker().getJobInfo(j).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(back.inputFiles()) == n and back.count() == 2000
    assert max(s.numTasks for s in stages if s) <= 4 * sc.defaultParallelism and spark.conf.get(conf) == default


def test_manifest_names_the_files_and_compaction_swaps_them(spark, tmp_root):
    path, df = f"{tmp_root}/t", table(spark)
    for b in range(4):
        part = df.where(F.col("batch") == b).repartition(3)
        write_partitioned(part, path, PARTS)
        commit(spark, path, f"batch-{b}", part.select(*PARTS).distinct().collect())
    want = {tuple(r) for r in df.select("id", "kind", "batch").collect()}
    def read(where=None):
        return read_manifest(spark, path, df.schema, PARTS, where).select("id", "kind", "batch")
    assert {tuple(r) for r in read().collect()} == want
    assert sorted(r.file for r in live_files(spark, path, df.schema, PARTS).collect()) == files(path)
    hot = read(F.col("kind") == "hot")
    assert len(hot.inputFiles()) == 12 and {r.kind for r in hot.collect()} == {"hot"}
    # a batch that runs again replaces its files and its entry
    part = df.where("batch = 2").repartition(1)
    write_partitioned(part, path, PARTS)
    commit(spark, path, "batch-2", part.select(*PARTS).distinct().collect())
    assert {tuple(r) for r in read().collect()} == want
    # a reader that planned before the compaction still finds its files
    before = read(F.col("kind") == "hot")
    compact(spark, path, df.schema, PARTS, {"batch": F.lit(-1)}, 100, F.col("kind") == "hot")
    after = read(F.col("kind") == "hot")
    assert len(after.inputFiles()) == 4 and {r.batch for r in after.collect()} == {-1}
    assert sorted(r.id for r in before.collect()) == sorted(r.id for r in after.collect())
    assert {r.id for r in read().collect()} == {r.id for r in df.collect()}
    n = len(files(path))
    assert vacuum(spark, path) > 0 and len(files(path)) < n
    assert sorted(r.id for r in read().collect()) == sorted(r.id for r in df.collect())
    assert read(F.col("kind") == "absent").count() == 0
    compact(spark, path, df.schema, PARTS, {"batch": F.lit(-1)}, 100, F.col("kind") == "absent")


def test_a_compaction_that_fails_changes_nothing(spark, tmp_root, monkeypatch):
    from txlake.sources import manifest
    path, df = f"{tmp_root}/t", table(spark, 200)
    write_partitioned(df, path, PARTS)
    commit(spark, path, "all", df.select(*PARTS).distinct().collect())
    def stop(*a, **k):
        raise RuntimeError("lost before the entry")
    monkeypatch.setattr(manifest, "put_entry", stop)
    with pytest.raises(RuntimeError):
        compact(spark, path, df.schema, PARTS, {"batch": F.lit(-1)}, 100)
    assert sorted(r.id for r in read_manifest(spark, path, df.schema, PARTS).collect()) == list(range(200))


def test_sink_with_sized_tables_and_manifests(spark, tmp_root):
    msgs = [f'{{"object_id":"{i}","object_type":"{"TRANSACTION" if i % 2 else "ODD/TYPE"}","sent_dttm":"2022-05-04 10:00:00","payload":{{"operation_id":"{i}"}}}}' for i in range(100)]
    records = spark.createDataFrame([(m,) for m in msgs], "value string").repartition(6)
    paths = TablePaths.under(f"{tmp_root}/t")
    sink = FanOutSink(paths, rows_per_file=20, manifest=True)
    for _ in range(2):  # again: the same files' places, the same rows
        backfill(records, sink, run_id="day")
        raw = read_manifest(spark, paths.raw, RAW_TABLE, RAW_PARTITIONS)
        assert sorted(int(r.object_id) for r in raw.collect()) == list(range(100))
        odd = read_manifest(spark, paths.raw, RAW_TABLE, RAW_PARTITIONS, F.col("object_type") == "odd/type")
        assert odd.count() == 50 and len(odd.inputFiles()) == 3
    with pytest.raises(ValueError):
        FanOutSink(paths, manifest=True)


def test_a_run_is_published_once(spark, tmp_root):
    env = spark.range(50).select(F.col("id").cast("string").alias("value"))
    path = f"{tmp_root}/topic"
    # an attempt that failed half way left rows and no record
    env.limit(20).write.format("text").save(f"{path}/run_id=r1")
    assert [publish_envelopes(env, path, run_id="r1") for _ in range(3)] == [50] * 3
    assert publish_envelopes(env.limit(0), path, run_id="r2") == 0
    assert sorted(int(r.value) for r in spark.read.text(path).collect()) == list(range(50))
    with pytest.raises(ValueError):
        publish_envelopes(env, None, run_id="r1")


def test_file_log_positions_and_loss_policy(spark, tmp_root):
    log = FileLog(spark, f"{tmp_root}/log")
    stamp = F.timestamp_seconds(F.col("id") * 10)
    rows = spark.range(60).select("id", stamp.alias("timestamp"))
    for s in (0, 1, 1, 2):
        log.append(rows.where(F.floor(F.col("id") / 20) == s), f"s{s}", F.col("id") % 2, ["id"])
    def ids(df):
        return {(r.partition, r.offset, r.id) for r in df.collect()}
    everything = {(i % 2, i // 2, i) for i in range(60)}
    assert ids(log.tail()) == everything
    assert ids(log.tail(25)) == {x for x in everything if x[1] >= 25}
    assert ids(log.tail({0: 12})) == {x for x in everything if x[0] == 1 or x[1] >= 12}
    assert ids(log.tail("s@155000")) == {x for x in everything if x[2] >= 16}
    assert ids(log.tail("s@999999999")) == set() and ids(log.tail(1000)) == set()
    # only segments that can hold the offset are opened
    assert not any("segment=s0" in f for f in log.tail(12).inputFiles())
    log.trim("s0")
    with pytest.raises(DataLossError):
        log.tail(3)
    left = {x for x in everything if x[1] >= 10}
    assert ids(log.tail(3, fail_on_data_loss=False)) == left == ids(log.tail())
    # offsets go on after what was trimmed
    log.append(spark.range(60, 62).select("id", stamp.alias("timestamp")), "s3", F.col("id") % 2, ["id"])
    assert ids(log.tail(30)) == {(0, 30, 60), (1, 30, 61)}
