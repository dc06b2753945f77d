"""Stateful deduplication of messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.schemas import DEDUP_KEYS
from txlake.streaming.keys import DEFAULT_RECENT, recent_dedup


def _first_per_key(keys: list[str]):
    def fn(batches):
        for pdf in batches:
            yield pdf.drop_duplicates(subset=keys, keep="first")
    return fn


def local_predup(messages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop repeated keys inside each Arrow chunk of each input partition.

    The stateful dedup has no map-side partial step: every copy of a key is
    shuffled to the one task that owns the key. When one message is
    delivered many times (a third of a batch, say) that task becomes the
    straggler. Collapsing copies chunk by chunk before the shuffle bounds
    what reaches it to one row per chunk. Narrow (no shuffle), and valid in
    a streaming plan; the first copy in input order survives, as it would in
    the stateful operator.
    """
    return messages.mapInPandas(_first_per_key(list(keys)), messages.schema)


def dedup_stream(messages: DataFrame, keys: Sequence[str] = DEDUP_KEYS,
                 watermark_delay: str | None = None,
                 event_time: str = "sent_dttm",
                 predup: bool = False,
                 mode: str = "watermark_first",
                 late: bool = False) -> DataFrame:
    """Drop repeated messages.

    Without ``watermark_delay`` every key is remembered forever (state grows
    with the number of distinct messages). With it, ``mode`` chooses:

    * ``"watermark_first"`` (default): the watermark is set *before* the
      dedup; keys whose event time falls behind it are evicted, and rows
      arriving behind it are dropped as late and counted in
      ``numRowsDroppedByWatermark``. ``event_time`` must be among ``keys``.
    * ``"within_watermark"``: ``dropDuplicatesWithinWatermark`` on the keys
      other than ``event_time`` -- a copy is dropped while its first
      occurrence is less than the delay behind the watermark, whatever its
      own event time.
    * ``"dedup_first"``: dedup, then the watermark, as the upstream collector
      orders them. The watermark then bounds nothing: state is never evicted
      and late rows pass. For parity checks only.
    * ``"finalized"``: a streaming aggregate, ``min(struct(other columns))``
      per key, in append mode. Unlike the stateful dedup it aggregates
      partially before its shuffle, in the JVM, so copies of a hot message
      collapse map-side without ``predup``, and the survivor is
      deterministic. A message is emitted once the watermark passes its
      event time: output lags by the delay, and the newest messages of a
      finite run wait in state for later data. ``event_time`` must be among
      ``keys``; ``predup`` is not needed and is ignored.

    Rejects (``reject_reason`` not null) never enter the state: each one
    passes, equal ones too. With a watermark that evicts state
    (``watermark_first``, ``within_watermark``, ``finalized``) neither do
    messages without an event time, which no watermark could ever evict or
    release, or dated up to 1970, which every watermark is past: they pass as
    they come, copies included. The price is that the input is read and
    decoded once for either side.
    ``predup`` adds ``local_predup`` ahead of the stateful shuffle.

    With ``late`` (modes that drop late rows) the second reading carries every
    message, and a column ``_side`` marks those that also went to the stateful
    operator. Behind the dedup, where a batch's watermark is known, the marked
    ones at or before it are the late rows, each of them, and the other marked
    ones go (``late.late_split``): the same reading, no second state.

    * ``"bounded"``: exact dedup over bounded state, see
      ``keys.recent_dedup``; ``watermark_delay`` is then how long, by ingest
      time (``trigger_dttm``), a key stays in state.
    """
    ks = list(keys)
    if mode == "bounded":
        return recent_dedup(messages, ks, watermark_delay or DEFAULT_RECENT)
    past = F.lit(False)
    if "reject_reason" in messages.columns:
        past = F.col("reject_reason").isNotNull()
    if watermark_delay is not None and mode != "dedup_first":
        time = F.col(event_time)
        past = past | time.isNull() | (time <= F.timestamp_seconds(F.lit(0)))
    kept = _dedup(messages.where(~past), ks, watermark_delay, event_time, predup, mode)
    if late and watermark_delay is not None and mode != "dedup_first":
        return (kept.withColumn("_side", F.lit(False))
                .unionByName(messages.withColumn("_side", ~past)))
    through = messages.where(past)
    return kept.unionByName(through) if "reject_reason" in messages.columns or watermark_delay else kept


def _dedup(messages: DataFrame, ks: list[str], watermark_delay: str | None,
           event_time: str, predup: bool, mode: str) -> DataFrame:
    if watermark_delay is None:
        src = local_predup(messages, ks) if predup else messages
        return src.dropDuplicates(ks)
    if mode == "dedup_first":
        src = local_predup(messages, ks) if predup else messages
        return src.dropDuplicates(ks).withWatermark(event_time, watermark_delay)
    if mode == "within_watermark":
        ks = [k for k in ks if k != event_time]
        src = messages.withWatermark(event_time, watermark_delay)
        if predup:
            src = local_predup(src, ks)
        return src.dropDuplicatesWithinWatermark(ks)
    if mode not in ("watermark_first", "finalized"):
        raise ValueError(f"unknown dedup mode {mode!r}")
    if event_time not in ks:
        raise ValueError("the event-time column must be part of the key")
    if mode == "finalized":
        others = [c for c in messages.columns if c not in ks]
        if not others:
            return (messages.withWatermark(event_time, watermark_delay)
                    .groupBy(*ks).count().select(*ks))
        agg = (messages.withWatermark(event_time, watermark_delay).groupBy(*ks)
               .agg(F.min(F.struct(*others)).alias("_survivor")))
        return agg.select(*ks, "_survivor.*").select(*messages.columns)
    src = messages.withWatermark(event_time, watermark_delay)
    if predup:
        src = local_predup(src, ks)
    return src.dropDuplicates(ks)
