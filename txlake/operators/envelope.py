"""Envelope encode / decode / normalise.

Wire format: one JSON object per message,
``{"object_id", "object_type", "sent_dttm", "payload": {...}}``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.functions.ids import uuid5_from_parts
from txlake.functions.json import envelope_json
from txlake.functions.time import format_event_time, parse_event_time
from txlake.schemas import (
    CORRUPT_COLUMN,
    CURRENCY_TAG,
    ENVELOPE_WITH_CORRUPT,
    TRANSACTION_TAG,
    UUID_NAMESPACE,
)


def _as_text(c: Column) -> Column:
    return c.cast("string")


def encode_transactions(dump: DataFrame, sep: str = " ") -> DataFrame:
    """Transactions dump -> envelopes (column ``value``).

    ``object_id`` is the operation id and ``sent_dttm`` the transaction time.
    A timestamp ``transaction_dt`` is written with second precision.
    """
    tdt = F.col("transaction_dt")
    tdt_text = (format_event_time(tdt, sep)
                if dict(dump.dtypes)["transaction_dt"].startswith("timestamp")
                else _as_text(tdt))
    payload = F.struct(
        F.col("operation_id").cast("string").alias("operation_id"),
        F.col("account_number_from").cast("long").alias("account_number_from"),
        F.col("account_number_to").cast("long").alias("account_number_to"),
        F.col("currency_code").cast("int").alias("currency_code"),
        F.col("country").cast("string").alias("country"),
        F.col("status").cast("string").alias("status"),
        F.col("transaction_type").cast("string").alias("transaction_type"),
        F.col("amount").cast("long").alias("amount"),
        tdt_text.alias("transaction_dt"),
    )
    return dump.select(
        envelope_json(F.col("operation_id").cast("string"),
                      F.lit(TRANSACTION_TAG), tdt_text, payload).alias("value")
    )


def encode_currencies(dump: DataFrame, namespace: str = UUID_NAMESPACE,
                      id_sep: str = "", sep: str = " ") -> DataFrame:
    """Currency-rate dump -> envelopes (column ``value``).

    ``object_id`` is the UUIDv5 of (currency_code, currency_code_with,
    date_update text) joined by ``id_sep``.
    """
    du = F.col("date_update")
    du_text = (format_event_time(du, sep)
               if dict(dump.dtypes)["date_update"].startswith("timestamp")
               else _as_text(du))
    payload = F.struct(
        du_text.alias("date_update"),
        F.col("currency_code").cast("int").alias("currency_code"),
        F.col("currency_code_with").cast("int").alias("currency_code_with"),
        F.col("currency_with_div").cast("double").alias("currency_with_div"),
    )
    oid = uuid5_from_parts(F.col("currency_code"), F.col("currency_code_with"),
                           du_text, namespace=namespace, sep=id_sep)
    return dump.select(
        envelope_json(oid, F.lit(CURRENCY_TAG), du_text, payload).alias("value")
    )


def restamp(dump: DataFrame, column: str, at: Column | str | None = None) -> DataFrame:
    """``dump`` with its event time set to the replay's: ``at`` (a time or its
    text), or now, once for the whole job, as a live replay stamps it. The
    encoders send it as both the message's and the payload's time."""
    if isinstance(at, str):
        at = F.lit(at).cast("timestamp")
    return dump.withColumn(column, (F.current_timestamp() if at is None else at).cast("timestamp"))


def decode_envelopes(records: DataFrame, value_col: str = "value",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Record values -> envelope columns, plus ``raw_value`` and the parser's
    ``_corrupt_record`` so malformed input keeps its text.

    Works on a Kafka frame (binary ``value``) and on text / Parquet frames.
    ``keep`` names extra record columns to carry through (e.g. ``timestamp``).
    """
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, ENVELOPE_WITH_CORRUPT,
                         {"columnNameOfCorruptRecord": CORRUPT_COLUMN,
                          "mode": "PERMISSIVE"})
    return records.select(
        *[F.col(k) for k in keep], text.alias("raw_value"), parsed.alias("_env")
    ).select(*keep, "raw_value", "_env.*")


def reject_reason(raw: Column | None = None, corrupt: Column | None = None,
                  object_id: Column | None = None) -> Column:
    """Why a decoded record is unusable, or null when it is fine."""
    raw = F.col("raw_value") if raw is None else raw
    corrupt = F.col(CORRUPT_COLUMN) if corrupt is None else corrupt
    object_id = F.col("object_id") if object_id is None else object_id
    return (F.when(raw.isNull(), F.lit("null_value"))
            .when(corrupt.isNotNull(), F.lit("malformed"))
            .when(object_id.isNull(), F.lit("missing_object_id")))


def normalize_messages(decoded: DataFrame, keep_rejects: bool = True,
                       not_after: Column | None = None) -> DataFrame:
    """Decoded envelopes -> messages ``object_id, object_type (lower),
    sent_dttm (timestamp), payload`` (+ ``reject_reason, raw_value``).

    With ``keep_rejects`` the raw text of a rejected record is carried (null
    for good records), so distinct bad messages stay distinct through a
    dedup instead of collapsing into one all-null key. A message dated after
    ``not_after`` is set aside as ``future_time``: its event time cannot be
    believed, and would move a watermark past everything that follows.
    """
    reason = reject_reason()
    if not_after is not None:
        reason = F.coalesce(reason, F.when(
            parse_event_time(F.col("sent_dttm")) > not_after, F.lit("future_time")))
    cols = [
        F.col("object_id"),
        F.lower(F.col("object_type")).alias("object_type"),
        parse_event_time(F.col("sent_dttm")).alias("sent_dttm"),
        F.col("payload"),
    ]
    extra = [c for c in decoded.columns
             if c not in ("object_id", "object_type", "sent_dttm", "payload",
                          "raw_value", CORRUPT_COLUMN)]
    if keep_rejects:
        cols += [reason.alias("reject_reason"),
                 F.when(reason.isNotNull(), F.col("raw_value")).alias("raw_value")]
    return decoded.select(*cols, *extra)


def split_rejects(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good messages, rejects) of a normalised frame with ``reject_reason``."""
    good = messages.where(F.col("reject_reason").isNull()).drop(
        "reject_reason", "raw_value")
    bad = messages.where(F.col("reject_reason").isNotNull()).select(
        "raw_value", "reject_reason", *[c for c in messages.columns
                                         if c in ("trigger_dttm", "date", "hour",
                                                  "stream_id", "batch_id")])
    return good, bad
