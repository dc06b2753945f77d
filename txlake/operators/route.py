"""Routing by type tag, ingest metadata and the typed (clean) projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.schemas import (
    CURRENCY,
    CURRENCY_PAYLOAD,
    CURRENCY_PAYLOAD_DATE_ONLY,
    EXACT_RATE,
    TRANSACTION,
    TRANSACTION_PAYLOAD,
)

#: Ingest columns passed through to the clean tables when present.
PASSTHROUGH = ("trigger_dttm", "date", "hour", "stream_id", "batch_id")


def stamp_ingest_metadata(df: DataFrame, trigger: Column | None = None,
                          batch_id: int | Column | None = None) -> DataFrame:
    """Add ``trigger_dttm`` (ingest time), ``date`` (yyyy-MM-dd text),
    ``hour`` and optionally ``batch_id``.

    ``trigger`` defaults to ``current_timestamp()``; in a streaming plan that
    value is fixed per micro-batch, so a retried batch gets the same stamp
    and lands in the same partitions.
    """
    trig = F.current_timestamp() if trigger is None else trigger
    out = df.withColumn("trigger_dttm", trig)
    out = out.withColumns({
        "date": F.date_format(F.col("trigger_dttm"), "yyyy-MM-dd"),
        "hour": F.hour(F.col("trigger_dttm")),
    })
    if batch_id is not None:
        bid = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
        out = out.withColumn("batch_id", bid.cast("long"))
    return out


def route_by_type(df: DataFrame, object_type: str) -> DataFrame:
    """Messages of one (normalised, lower-case) type tag."""
    return df.where(F.col("object_type") == F.lit(object_type))


def _passthrough(df: DataFrame) -> list[str]:
    return [c for c in PASSTHROUGH if c in df.columns]


def clean_transactions(messages: DataFrame, routed: bool = False) -> DataFrame:
    """Transaction messages -> the 9 typed transaction columns (+ ingest
    columns present in the input). Fields that do not parse are null; the
    rest of the row survives."""
    src = messages if routed else route_by_type(messages, TRANSACTION)
    p = F.from_json(F.col("payload"), TRANSACTION_PAYLOAD)
    return src.select(p.alias("_p"), *_passthrough(src)).select(
        "_p.*", *_passthrough(src))


def clean_currencies(messages: DataFrame, routed: bool = False,
                     date_only: bool = False, exact_rate: bool = False) -> DataFrame:
    """Currency messages -> ``object_id`` + the 4 typed rate columns (+ ingest
    columns). ``date_only=True`` reads ``date_update`` as a date (time of day
    dropped, value at midnight), as the upstream collector does.
    ``exact_rate=True`` reads the rate as ``EXACT_RATE`` (decimal) instead of
    the upstream float."""
    src = messages if routed else route_by_type(messages, CURRENCY)
    schema = CURRENCY_PAYLOAD_DATE_ONLY if date_only else CURRENCY_PAYLOAD
    if exact_rate:
        schema = T.StructType([
            T.StructField(f.name, EXACT_RATE) if f.name == "currency_with_div" else f
            for f in schema.fields])
    p = F.from_json(F.col("payload"), schema)
    out = src.select(F.col("object_id"), p.alias("_p"), *_passthrough(src)).select(
        "object_id", "_p.*", *_passthrough(src))
    if date_only:
        out = out.withColumn("date_update", F.col("date_update").cast("timestamp"))
    return out
