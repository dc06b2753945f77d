"""The registered queries: one function ``(spark, sf_dir) -> DataFrame`` per
operator row of the blueprint, over the driver's tables (see ``standins``).

Timestamps are returned as TIMESTAMP_NTZ (wall-clock UTC) so they compare
equal to the naive timestamps of the SQL oracles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.functions.ids import uuid5_from_parts
from txlake.functions.status import status_rank
from txlake.functions.time import format_event_time, parse_event_time
from txlake.operators.dedup import dedup_exact, late_arrivals
from txlake.operators.envelope import (
    decode_envelopes,
    encode_currencies,
    encode_transactions,
    normalize_messages,
    restamp,
)
from txlake.operators.explore import (
    deep_keys,
    exclude_sentinel,
    exclude_values,
    head_k,
    point_lookup,
    semi_filter,
    sequence_number,
    top_k,
)
from txlake.operators.metrics import distinct_values, shape
from txlake.operators.route import (
    clean_currencies,
    clean_transactions,
    stamp_ingest_metadata,
)
from txlake.plans import standins as S
from txlake.schemas import (
    CLEAN_CURRENCIES,
    CLEAN_TRANSACTIONS,
    CURRENCY,
    DEDUP_KEYS,
    LOOKALIKE_KEYS,
    RAW_TABLE,
    TRANSACTION,
)
from txlake.session import apply_batch_conf, scratch_path, stream_session
from txlake.sources.files import read_in_order, read_parquet, read_partitioned, read_table
from txlake.sources.log import FileLog
from txlake.sources.manifest import commit, compact, live_files, read_manifest
from txlake.sources.stream import record_stream
from txlake.streaming.collector import run_collector
from txlake.streaming.metrics import batch_metrics_table
from txlake.streaming.sinks import FanOutSink, TablePaths, publish_envelopes, write_partitioned
from txlake.streaming.state import state_sizes, unfinalized

Query = Callable[[SparkSession, str], DataFrame]

# Fixed query parameters ---------------------------------------------------
LOOKUP_ID = 1234                      # point lookup: one order key
STANDIN_OUTLIERS = (-1, 42, 77)       # sentinel + two customer keys
SEQ_KEYS = ("account_number_from", "status")
SEQ_ORDER = ("transaction_dt", "operation_id")
DEEP = 4                              # "deep group": row_number > 4
SEQ_MIN = 1                           # rows kept by the semi filters: > 1
PRUNE_DATE = "2024-01-15"
WATERMARK_DELAY = "1 hour"
WATERMARK_DELAY_S = 3600
WATERMARK_LAG = 1                     # one trigger per arrival (see dedup)
REPLAY_TIME = "2026-01-01 00:00:00"
FILES_PER_TRIGGER = 4


def ntz(c: str | Column, name: str | None = None) -> Column:
    """``c`` as TIMESTAMP_NTZ, named ``name`` (default: the column's name)."""
    col = (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")
    name = name or (c if isinstance(c, str) else None)
    return col.alias(name) if name else col


def _t(spark: SparkSession, sf: str, name: str, cpu_heavy: bool = False) -> DataFrame:
    """A test table; ``cpu_heavy`` spreads an under-split file over the cores
    before JSON / hashing work (a no-op for a table with many splits)."""
    apply_batch_conf(spark)
    return read_table(spark, sf, name, balance=cpu_heavy)


def _messages(envelopes: DataFrame, keep_rejects: bool = False) -> DataFrame:
    return normalize_messages(decode_envelopes(envelopes), keep_rejects=keep_rejects)


def _message_cols(df: DataFrame) -> DataFrame:
    return df.select("object_id", "object_type", ntz("sent_dttm"), "payload")


def _tx(spark: SparkSession, sf: str) -> DataFrame:
    return S.orders_as_transactions(_t(spark, sf, "orders"))


def _seq(spark: SparkSession, sf: str) -> DataFrame:
    return sequence_number(_tx(spark, sf), SEQ_KEYS, SEQ_ORDER)


# --- scans ----------------------------------------------------------------

def scan_parquet(spark, sf):
    apply_batch_conf(spark)
    return read_parquet(spark, f"{sf}/orders.parquet",
                        ["o_orderkey", "o_custkey", "o_orderstatus",
                         "o_totalprice", "o_orderdate"])


def partition_pruned_read(spark, sf):
    """Lay ``events`` out by (date, hour) and read one date back; only that
    date's folders are read (``PartitionFilters``)."""
    ev = _t(spark, sf, "events")
    path = scratch_path(spark, "events_by_hour")
    laid = ev.withColumns({"date": F.date_format("ts", "yyyy-MM-dd"),
                           "hour": F.hour("ts")})
    # range layout: a hot hour is cut across tasks, each task writes a few
    # contiguous folders
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (laid.repartitionByRange(n, "date", "hour", "ts").write.mode("overwrite")
     .partitionBy("date", "hour").parquet(path))
    schema = T.StructType(
        [f for f in ev.schema.fields]
        + [T.StructField("date", T.StringType()), T.StructField("hour", T.IntegerType())])
    back = read_partitioned(spark, path, schema, F.col("date") == PRUNE_DATE)
    return back.select("event_id", ntz("ts"), "event_type", "user_id", "value", "hour")


# --- envelopes --------------------------------------------------------------

def envelope_decode(spark, sf):
    return _message_cols(_messages(S.events_envelopes(_t(spark, sf, "events", cpu_heavy=True))))


def envelope_encode_tx(spark, sf):
    return encode_transactions(S.transactions_dump(_t(spark, sf, "orders", cpu_heavy=True)))


def envelope_encode_cur(spark, sf):
    return encode_currencies(S.currency_dump(_t(spark, sf, "lineitem", cpu_heavy=True)))


def envelope_union(spark, sf):
    """Two producers, one topic: a bag union of the two envelope feeds."""
    return envelope_encode_tx(spark, sf).unionByName(envelope_encode_cur(spark, sf))


def replay_restamp(spark, sf):
    """Replay the transactions dump with event time re-stamped to the replay
    time (a parameter; a live replay takes the clock's)."""
    dump = S.transactions_dump(_t(spark, sf, "orders", cpu_heavy=True))
    return encode_transactions(restamp(dump, "transaction_dt", REPLAY_TIME))


def uuid5_id(spark, sf):
    d = S.currency_dump(_t(spark, sf, "lineitem", cpu_heavy=True))
    du = format_event_time(F.col("date_update"))
    return d.select("currency_code", "currency_code_with", du.alias("date_update"),
                    uuid5_from_parts(F.col("currency_code"),
                                     F.col("currency_code_with"), du).alias("object_id"))


# --- normalisation, routing, typed tables -----------------------------------

def normalize_event_time(spark, sf):
    """Event time on the wire in three shapes: ``T`` separated (purchase,
    view), space separated (click, signup), with milliseconds (error, which
    the second-precision format rejects -> null)."""
    ev = _t(spark, sf, "events", cpu_heavy=True)
    et = F.col("event_type")
    text = (F.when(et.isin("purchase", "view"), format_event_time(F.col("ts"), "T"))
            .when(et.isin("click", "signup"), format_event_time(F.col("ts")))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")))
    return ev.select(
        "event_id", F.lower(F.upper(et)).alias("object_type"),
        text.alias("sent_text"), ntz(parse_event_time(text), "sent_dttm"))


def ingest_metadata(spark, sf):
    """Ingest stamp with the event time standing in for the trigger time and
    the arrival slice as batch id."""
    ev = _t(spark, sf, "events")
    out = stamp_ingest_metadata(ev, trigger=F.col("ts").cast("timestamp"),
                                batch_id=S.arrival_batch())
    return out.select("event_id", ntz("trigger_dttm"), "date", "hour", "batch_id")


def route_by_type(spark, sf):
    m = _messages(S.events_envelopes(_t(spark, sf, "events", cpu_heavy=True)))
    route = F.when(F.col("object_type").isin(TRANSACTION, CURRENCY),
                   F.col("object_type")).otherwise(F.lit("raw_only"))
    return (m.withColumn("route", route).groupBy("route", "object_type")
            .agg(F.count(F.lit(1)).alias("messages")))


def _clean_tx_cols(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in CLEAN_TRANSACTIONS.fieldNames()[:8]],
                     ntz("transaction_dt"))


def clean_transactions_q(spark, sf):
    m = _messages(S.events_envelopes(_t(spark, sf, "events", cpu_heavy=True)))
    return _clean_tx_cols(clean_transactions(m))


def clean_currencies_q(spark, sf):
    m = _messages(S.events_envelopes(_t(spark, sf, "events", cpu_heavy=True)))
    c = clean_currencies(m)
    return c.select("object_id", ntz("date_update"), "currency_code",
                    "currency_code_with", "currency_with_div")


# --- dedup ------------------------------------------------------------------

def _feed_with_retries(events: DataFrame) -> DataFrame:
    return S.events_envelopes(S.with_retries(events))


def dedup_exact_q(spark, sf):
    m = _messages(_feed_with_retries(_t(spark, sf, "events", cpu_heavy=True)))
    return _message_cols(dedup_exact(m, DEDUP_KEYS))


def _arrival_messages(spark, sf) -> DataFrame:
    arr = S.events_envelopes(S.event_arrivals(_t(spark, sf, "events", cpu_heavy=True)),
                             keep=("arrival",))
    return normalize_messages(decode_envelopes(arr, keep=("arrival",)),
                              keep_rejects=False)


def late_rows(spark, sf):
    """Batch audit of the rows a watermark-first dedup drops as late."""
    m = _arrival_messages(spark, sf)
    flagged = late_arrivals(m, "arrival", "sent_dttm", WATERMARK_DELAY_S,
                            lag=WATERMARK_LAG)
    return flagged.where("is_late").select(
        "object_id", "object_type", ntz("sent_dttm"), "arrival")


def batch_metrics(spark, sf):
    """Per arrival batch: records in (before dedup) and records out (first
    delivery of a key), the collector's volume metrics."""
    m = _arrival_messages(spark, sf)
    rows_in = m.groupBy("arrival").agg(F.count(F.lit(1)).alias("rows_in"))
    first = m.groupBy(*DEDUP_KEYS).agg(F.min("arrival").alias("arrival"))
    rows_out = first.groupBy("arrival").agg(F.count(F.lit(1)).alias("rows_out"))
    return (rows_in.join(rows_out, "arrival", "left")
            .select("arrival", "rows_in",
                    F.coalesce("rows_out", F.lit(0)).cast("long").alias("rows_out")))


# --- streaming ----------------------------------------------------------------

def _stream_ingest_tables(spark: SparkSession, sf: str, name: str) -> TablePaths:
    """Write the feed (events + retries) as files, stream it through the
    collector (exact dedup, several triggers) into the four tables."""
    root = scratch_path(spark, name)
    _feed_with_retries(_t(spark, sf, "events", cpu_heavy=True)).write.parquet(f"{root}/feed")
    paths = TablePaths.under(f"{root}/tables")
    records = record_stream(stream_session(spark), f"{root}/feed",
                            max_files_per_trigger=FILES_PER_TRIGGER)
    run_collector(records, FanOutSink(paths), f"{root}/checkpoint")
    return paths


def _raw_back(spark: SparkSession, paths: TablePaths) -> DataFrame:
    raw = read_partitioned(spark, paths.raw, RAW_TABLE)
    return raw.select("object_id", "object_type", ntz("sent_dttm"), "payload")


def raw_layer(spark, sf):
    return _raw_back(spark, _stream_ingest_tables(spark, sf, "raw_layer"))


def stream_ingest(spark, sf):
    paths = _stream_ingest_tables(spark, sf, "stream_ingest")
    return _clean_tx_cols(read_partitioned(spark, paths.transactions,
                                           CLEAN_TRANSACTIONS))


def stream_fanout(spark, sf):
    paths = _stream_ingest_tables(spark, sf, "stream_fanout")
    raw = read_partitioned(spark, paths.raw, RAW_TABLE)
    per_type = raw.groupBy(F.concat(F.lit("raw/"), F.col("object_type")).alias("table_name")) \
        .agg(F.count(F.lit(1)).alias("rows"))
    tx = read_partitioned(spark, paths.transactions, CLEAN_TRANSACTIONS) \
        .agg(F.count(F.lit(1)).alias("rows")).select(F.lit("transactions").alias("table_name"), "rows")
    cur = read_partitioned(spark, paths.currencies, CLEAN_CURRENCIES) \
        .agg(F.count(F.lit(1)).alias("rows")).select(F.lit("currencies").alias("table_name"), "rows")
    return per_type.unionByName(tx).unionByName(cur)


def dedup_watermark(spark, sf):
    """Arrival batches delivered one trigger each into a watermark-first
    dedup (delay 1 hour); returns the raw layer: what the stream kept."""
    m_root = scratch_path(spark, "dedup_watermark")
    arr = S.events_envelopes(S.event_arrivals(_t(spark, sf, "events", cpu_heavy=True)),
                             keep=("arrival",))
    staged = f"{m_root}/staged"
    arr.write.partitionBy("arrival").parquet(staged)
    paths = TablePaths.under(f"{m_root}/tables")
    feed = f"{m_root}/feed"
    ss = stream_session(spark)
    for b in range(S.N_ARRIVALS):
        (spark.read.parquet(staged).where(F.col("arrival") == b)
         .select("value").write.mode("append").parquet(feed))
        run_collector(record_stream(ss, feed), FanOutSink(paths),
                      f"{m_root}/checkpoint", watermark_delay=WATERMARK_DELAY)
    return _raw_back(spark, paths)


def dedup_finalized(spark, sf):
    """The feed (events + retries) in one trigger through the finalized
    dedup (a streaming aggregate, delay 1 hour); returns the raw layer: each
    message once, emitted when the watermark passed it. The feed ends there, so
    the newest hour, still in state, is read from the checkpoint."""
    root = scratch_path(spark, "dedup_finalized")
    _feed_with_retries(_t(spark, sf, "events", cpu_heavy=True)).write.parquet(f"{root}/feed")
    paths = TablePaths.under(f"{root}/tables")
    run_collector(record_stream(stream_session(spark), f"{root}/feed"), FanOutSink(paths),
                  f"{root}/checkpoint", watermark_delay=WATERMARK_DELAY,
                  dedup_mode="finalized")
    left = unfinalized(spark, f"{root}/checkpoint")
    return _raw_back(spark, paths).unionByName(
        left.select("object_id", "object_type", ntz("sent_dttm"), "payload"))


WATERMARK_MODES = ("watermark_first", "within_watermark", "finalized")
FAR_FUTURE = "9999-12-31 00:00:00"
FEED_FILES = 2                        # files of one arrival at least: one trigger's
FEED_ROWS = 10_000                    # and no more than one per so many rows


def _arrival_feed(spark, sf, root: str, first: DataFrame | None = None) -> tuple[str, int]:
    """The arrivals as a feed of as many files each, oldest arrival first, so
    that a stream admitting that many files per trigger takes one arrival per
    micro-batch: (folder, files of an arrival). A file is read by one task or a
    few, so large arrivals have as many as there are cores. ``first`` are
    records for the first arrival."""
    arr = S.events_envelopes(S.event_arrivals(_t(spark, sf, "events", cpu_heavy=True)), keep=("arrival",))
    arr.write.partitionBy("arrival").parquet(f"{root}/staged")
    least = min((r["count"] for r in spark.read.parquet(f"{root}/staged").groupBy("arrival").count().collect()), default=0)
    n = max(FEED_FILES, min(spark.sparkContext.defaultParallelism, least // FEED_ROWS))
    for b in range(S.N_ARRIVALS):
        part = spark.read.parquet(f"{root}/staged").where(F.col("arrival") == b).select("value")
        if first is not None and b == 0:
            part = part.unionByName(first)
        part.repartition(n).write.mode("append").parquet(f"{root}/feed")
    return f"{root}/feed", n


def late_table(spark, sf):
    """The rows a watermark drops as late, kept in the late table, in each mode
    that has a watermark; one run, an arrival per micro-batch."""
    root = scratch_path(spark, "late_table")
    (feed, n), ss, out = _arrival_feed(spark, sf, root), stream_session(spark), None
    for mode in WATERMARK_MODES:
        paths = TablePaths.under(f"{root}/{mode}")
        run_collector(record_stream(ss, feed, max_files_per_trigger=n), FanOutSink(paths),
                      f"{root}/checkpoints/{mode}", watermark_delay=WATERMARK_DELAY, dedup_mode=mode)
        one = spark.read.parquet(paths.late).select(
            F.lit(mode).alias("mode"), "batch_id", "object_id", "object_type", ntz("sent_dttm"))
        out = one if out is None else out.unionByName(one)
    return out


def guarded_clock(spark, sf):
    """A message dated 9999 among the first arrival: it is set aside, the
    watermark stays with the others, and every other message is in the raw
    layer or the late table."""
    root = scratch_path(spark, "guarded_clock")
    wild = spark.range(1).select(S.envelope_json(F.lit("wild"), F.lit("TRANSACTION"), F.lit(FAR_FUTURE),
                                                 F.struct(F.lit(1).alias("k"))).alias("value"))
    feed, n = _arrival_feed(spark, sf, root, wild)
    paths = TablePaths.under(f"{root}/tables")
    run_collector(record_stream(stream_session(spark), feed, max_files_per_trigger=n), FanOutSink(paths),
                  f"{root}/checkpoint", watermark_delay=WATERMARK_DELAY)
    cols = ("object_id", ntz("sent_dttm"))
    aside = spark.read.parquet(paths.rejects)
    return (_raw_back(spark, paths).select(F.lit("raw").alias("table_name"), *cols)
            .unionByName(spark.read.parquet(paths.late).select(F.lit("late").alias("table_name"), *cols))
            .unionByName(aside.select(F.col("reject_reason").alias("table_name"),
                                      F.get_json_object("raw_value", "$.object_id").alias("object_id"),
                                      ntz(parse_event_time(F.get_json_object("raw_value", "$.sent_dttm")), "sent_dttm"))))


def dedup_bounded(spark, sf):
    """The feed (events + retries) in several triggers through the exact dedup
    over bounded state: keys leave the state at once, older ones are found in
    the key table. Returns the raw layer."""
    root = scratch_path(spark, "dedup_bounded")
    (_feed_with_retries(_t(spark, sf, "events", cpu_heavy=True)).repartition(FILES_PER_TRIGGER)
     .write.parquet(f"{root}/feed"))
    paths = TablePaths.under(f"{root}/tables")
    run_collector(record_stream(stream_session(spark), f"{root}/feed", max_files_per_trigger=1),
                  FanOutSink(paths, key_hours=24), f"{root}/checkpoint",
                  watermark_delay="0 seconds", dedup_mode="bounded")
    return _raw_back(spark, paths)


def reject_feed(spark, sf):
    """Every event delivered twice, clicks cut short, signups without a value,
    errors without an id: the rejects table keeps each of them with its text."""
    root = scratch_path(spark, "reject_feed")
    ev = S.with_retries(_t(spark, sf, "events", cpu_heavy=True))
    good = S.events_envelopes(ev, keep=("event_type",))
    et = F.col("event_type")
    value = (F.when(et == "click", F.left("value", F.lit(30))).when(et == "signup", F.lit(None).cast("string"))
             .when(et == "error", F.lit("{}")).otherwise(F.col("value")))
    good.select(value.alias("value")).write.parquet(f"{root}/feed")
    paths = TablePaths.under(f"{root}/tables")
    run_collector(record_stream(stream_session(spark), f"{root}/feed"), FanOutSink(paths),
                  f"{root}/checkpoint", watermark_delay=WATERMARK_DELAY)
    return spark.read.parquet(paths.rejects).select("reject_reason", "raw_value")


def observed_metrics(spark, sf):
    """Per arrival, what the collector observed while it ran: records in
    (before the dedup) and out of it. No table is read for it."""
    root = scratch_path(spark, "observed_metrics")
    feed, n = _arrival_feed(spark, sf, root)
    q = run_collector(record_stream(stream_session(spark), feed, max_files_per_trigger=n),
                      FanOutSink(TablePaths.under(f"{root}/tables")), f"{root}/checkpoint")
    return batch_metrics_table(spark, q).select(
        F.col("batch_id").cast("int").alias("arrival"), "rows_in", "rows_out", "rejected")


def state_audit(spark, sf):
    """How many keys the watermarked dedup held after each arrival, read from
    its checkpoint."""
    root = scratch_path(spark, "state_audit")
    feed, n = _arrival_feed(spark, sf, root)
    run_collector(record_stream(stream_session(spark), feed, max_files_per_trigger=n),
                  FanOutSink(TablePaths.under(f"{root}/tables")), f"{root}/checkpoint",
                  watermark_delay=WATERMARK_DELAY)
    return state_sizes(spark, f"{root}/checkpoint", range(S.N_ARRIVALS))


# --- file counts, manifest, log -------------------------------------------------

SMALL_PARTS = ("date", "arrival")     # a folder per day and arrival batch
ROWS_PER_FILE = 100


def _small_files_table(spark, sf) -> tuple[str, T.StructType]:
    """Events by (date, arrival), each arrival written on its own, in many
    small files, and entered in the table's manifest."""
    ev = _t(spark, sf, "events")
    path = scratch_path(spark, "small_files")
    laid = ev.withColumns({"date": F.date_format("ts", "yyyy-MM-dd"), "arrival": F.pmod(F.col("event_id"), F.lit(3)).cast("int")})
    for b in range(3):
        part = laid.where(F.col("arrival") == b).repartition(4)
        write_partitioned(part, path, SMALL_PARTS)
        commit(spark, path, f"arrival-{b}", part.select(*SMALL_PARTS).distinct().collect())
    return path, laid.schema


def compacted_layer(spark, sf):
    """Files per day before and after a compaction, by the manifest: small ones
    of three folders become evenly sized ones of a single folder."""
    path, schema = _small_files_table(spark, sf)

    def files(name: str) -> DataFrame:
        rows = (live_files(spark, path, schema, SMALL_PARTS).groupBy("date")
                .agg(F.countDistinct("arrival").alias(f"folders_{name}"), F.count(F.lit(1)).alias(f"files_{name}")).collect())
        return spark.createDataFrame(rows, f"date string, folders_{name} long, files_{name} long")
    before = files("before").drop("files_before")
    compact(spark, path, schema, SMALL_PARTS, {"arrival": F.lit(-1)}, ROWS_PER_FILE)
    rows = read_manifest(spark, path, schema, SMALL_PARTS).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(before, "date").join(files("after"), "date")


def manifest_read(spark, sf):
    """One day of the compacted table: the files the manifest names for it are
    opened, no folder is listed."""
    path, schema = _small_files_table(spark, sf)
    compact(spark, path, schema, SMALL_PARTS, {"arrival": F.lit(-1)}, ROWS_PER_FILE)
    day = read_manifest(spark, path, schema, SMALL_PARTS, F.col("date") == PRUNE_DATE)
    return day.select("event_id", ntz("ts"), "event_type", "user_id", "value",
                      F.lit(len(day.inputFiles())).cast("long").alias("files_listed"))


def publish_once(spark, sf):
    """The transactions published twice as one run: the second adds nothing.
    Returns what a reader of the folder finds, with the count either reported."""
    path = scratch_path(spark, "published")
    env = encode_transactions(S.transactions_dump(_t(spark, sf, "orders", cpu_heavy=True)))
    sent = [publish_envelopes(env, path, run_id="day-1") for _ in range(2)]
    return spark.read.text(path).select("value", F.lit(sent[0]).cast("long").alias("sent"),
                                        F.lit(sent[1]).cast("long").alias("sent_again"))


LOG_PARTITIONS = 3
LOG_OFFSET = 100
LOG_TIME = "2024-01-20 12:00:00"


def _event_log(spark, sf) -> FileLog:
    """Events appended to a log of three partitions, an arrival at a time; the
    second append is tried twice."""
    ev = S.event_arrivals(_t(spark, sf, "events")).withColumn("timestamp", F.col("ts").cast("timestamp"))
    log = FileLog(spark, scratch_path(spark, "event_log"))
    for b in [0, 1, 1, *range(2, S.N_ARRIVALS)]:
        log.append(ev.where(F.col("arrival") == b).select("event_id", "event_type", "timestamp"),
                   f"{b:03d}", F.pmod(F.col("event_id"), F.lit(LOG_PARTITIONS)), ["timestamp", "event_id"])
    return log


def log_tail(spark, sf):
    """The log read from an offset on every partition, and from a time."""
    log = _event_log(spark, sf)
    ms = int(spark.sql(f"SELECT unix_millis(TIMESTAMP '{LOG_TIME} UTC') AS ms").first().ms)
    out = None
    for name, start in (("offset", LOG_OFFSET), ("time", f"s@{ms}")):
        one = log.tail(start).select(F.lit(name).alias("start"), "partition", "offset", "event_id", "event_type", ntz("timestamp"))
        out = one if out is None else out.unionByName(one)
    return out


# --- numbering in input order ---------------------------------------------------

def lookalike_in_order(spark, sf):
    """Whole rows numbered among their look-alikes (six keys), in the order in
    which the file holds them; no number where a key is null."""
    apply_batch_conf(spark)
    tx = S.lookalike_transactions(read_in_order(spark, f"{sf}/orders.parquet"))
    seq = sequence_number(tx, LOOKALIKE_KEYS, ("_file", "_row"))
    ranked = seq.withColumn("status_rank", status_rank(F.col("status")))
    return ranked.select("operation_id", *LOOKALIKE_KEYS, "status", "status_rank", ntz("transaction_dt"), "row_number")


# --- analysis frame -------------------------------------------------------------

def filter_sentinel(spark, sf):
    return exclude_sentinel(_tx(spark, sf), "account_number_from", -1) \
        .select("operation_id", "account_number_from")


def filter_not_in(spark, sf):
    return exclude_values(_tx(spark, sf), "account_number_from", STANDIN_OUTLIERS) \
        .select("operation_id", "account_number_from")


def point_lookup_q(spark, sf):
    return point_lookup(_tx(spark, sf), "operation_id", LOOKUP_ID) \
        .select("operation_id", "account_number_from", "status",
                "transaction_type", "amount", ntz("transaction_dt"))


def status_rank_q(spark, sf):
    tx = _tx(spark, sf)
    return tx.select("operation_id", "status",
                     status_rank(F.col("status")).alias("status_rank"))


def sequence_number_q(spark, sf):
    return _seq(spark, sf).select("operation_id", *SEQ_KEYS, "row_number")


def deep_groups_q(spark, sf):
    # group sizes tell it: nothing is numbered
    return deep_keys(_tx(spark, sf), SEQ_KEYS, "account_number_from", DEEP)


def _ranked_top(df: DataFrame, k: int) -> DataFrame:
    ranked = df.withColumn("status_rank", status_rank(F.col("status")))
    top = top_k(ranked, ["account_number_from", "status_rank",
                         "transaction_dt", "operation_id"], k)
    return top.select("operation_id", "account_number_from", "status",
                      "status_rank", "row_number", ntz("transaction_dt"))


def semi_filter_topk(spark, sf):
    tx = _tx(spark, sf)
    seq = sequence_number(tx, SEQ_KEYS, SEQ_ORDER)
    # the accounts of rows numbered above DEEP, from group sizes (no second
    # numbering of the whole frame)
    deep = deep_keys(tx, SEQ_KEYS, "account_number_from", DEEP)
    kept = semi_filter(exclude_sentinel(seq, "account_number_from", -1),
                       deep, "account_number_from")
    return _ranked_top(kept.where(F.col("row_number") > SEQ_MIN), 20)


def double_semi_topk(spark, sf):
    tx = _tx(spark, sf)
    # numbered and written once, read for the rows and for the date members
    path = scratch_path(spark, "numbered")
    numbered = sequence_number(tx, SEQ_KEYS, SEQ_ORDER)
    numbered.write.parquet(path)
    seq = spark.read.schema(numbered.schema).parquet(path)
    deep_rows = seq.where(F.col("row_number") > DEEP)
    accounts = exclude_sentinel(deep_keys(tx, SEQ_KEYS, "account_number_from", DEEP),
                                "account_number_from", -1)
    kept = semi_filter(seq, accounts, "account_number_from")
    kept = semi_filter(kept, deep_rows, "transaction_dt")
    return _ranked_top(kept, 100)


def topk_3key(spark, sf):
    tx = exclude_sentinel(_tx(spark, sf), "account_number_from", -1)
    top = top_k(tx, ["account_number_from", "transaction_type", "status",
                     "operation_id"], 20)
    return top.select("operation_id", "account_number_from", "transaction_type",
                      "status")


LINEITEM_7 = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
              "l_quantity", "l_extendedprice", "l_discount")


def topk_7key(spark, sf):
    li = _t(spark, sf, "lineitem")
    rest = [c for c in li.columns if c not in LINEITEM_7]
    top = top_k(li, [*LINEITEM_7, *rest], 80)
    return top.select(*[c for c in li.columns if c != "l_shipdate"], ntz("l_shipdate"))


def head_k_q(spark, sf):
    return head_k(_tx(spark, sf), 10, ["operation_id"]).select(
        "operation_id", "account_number_from", "status", "transaction_type",
        "amount", ntz("transaction_dt"))


def distinct_values_q(spark, sf):
    return distinct_values(_tx(spark, sf), "status")


def shape_q(spark, sf):
    tx = _tx(spark, sf)
    return shape(tx, "all").unionByName(
        shape(exclude_values(tx, "account_number_from", STANDIN_OUTLIERS), "filtered"))


QUERIES: dict[str, Query] = {
    "scan_parquet": scan_parquet,
    "partition_pruned_read": partition_pruned_read,
    "envelope_decode": envelope_decode,
    "envelope_encode_tx": envelope_encode_tx,
    "envelope_encode_cur": envelope_encode_cur,
    "envelope_union": envelope_union,
    "normalize_event_time": normalize_event_time,
    "ingest_metadata": ingest_metadata,
    "route_by_type": route_by_type,
    "clean_transactions": clean_transactions_q,
    "clean_currencies": clean_currencies_q,
    "raw_layer": raw_layer,
    "stream_fanout": stream_fanout,
    "stream_ingest": stream_ingest,
    "dedup_exact": dedup_exact_q,
    "dedup_watermark": dedup_watermark,
    "dedup_finalized": dedup_finalized,
    "late_rows": late_rows,
    "filter_sentinel": filter_sentinel,
    "filter_not_in": filter_not_in,
    "point_lookup": point_lookup_q,
    "sequence_number": sequence_number_q,
    "deep_groups": deep_groups_q,
    "semi_filter_topk": semi_filter_topk,
    "double_semi_topk": double_semi_topk,
    "topk_3key": topk_3key,
    "topk_7key": topk_7key,
    "head_k": head_k_q,
    "distinct_values": distinct_values_q,
    "shape": shape_q,
    "batch_metrics": batch_metrics,
    "status_rank": status_rank_q,
    "uuid5_id": uuid5_id,
    "replay_restamp": replay_restamp,
    "late_table": late_table,
    "guarded_clock": guarded_clock,
    "dedup_bounded": dedup_bounded,
    "reject_feed": reject_feed,
    "observed_metrics": observed_metrics,
    "state_audit": state_audit,
    "compacted_layer": compacted_layer,
    "manifest_read": manifest_read,
    "publish_once": publish_once,
    "log_tail": log_tail,
    "lookalike_in_order": lookalike_in_order,
}
