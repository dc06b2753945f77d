"""Schemas, key lists and fixed values of the data model.

Every value under "Fixed values" must stay equal to the upstream data model for
results to match: the wire field names, the status lifecycle, the id namespace.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the upstream data model; do not edit)
# ---------------------------------------------------------------------------

#: Status lifecycle of a transaction, in order: queued=1, in_progress=2,
#: blocked=3, done=4, chargeback=5.
STATUS_RANKS: dict[str, int] = {
    "queued": 1,
    "in_progress": 2,
    "blocked": 3,
    "done": 4,
    "chargeback": 5,
}

#: Namespace of the deterministic UUIDv5 currency ids.
UUID_NAMESPACE = "7f288a2e-0ad0-4039-8e59-6c9838d87307"

#: Type tags on the wire (upper case) and after normalisation (lower case).
TRANSACTION_TAG = "TRANSACTION"
CURRENCY_TAG = "CURRENCY"
TRANSACTION = "transaction"
CURRENCY = "currency"

#: Columns a message is deduplicated on.
DEDUP_KEYS = ("object_id", "object_type", "sent_dttm")

#: Group keys of the look-alike transaction sequence number.
LOOKALIKE_KEYS = (
    "account_number_from",
    "account_number_to",
    "currency_code",
    "country",
    "transaction_type",
    "amount",
)

#: Wire format of event time (a ``T`` separator is accepted and normalised).
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

#: Operational defaults of the collector.
DEFAULT_MAX_OFFSETS_PER_TRIGGER = 10_000
DEFAULT_MIN_PARTITIONS = 8
DEFAULT_TRIGGER = "1 minute"
#: How far ahead of its ingest time a message may be dated under a watermark.
DEFAULT_FUTURE_TOLERANCE = "1 day"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

CORRUPT_COLUMN = "_corrupt_record"

#: Envelope as parsed from the wire; ``payload`` stays raw JSON text.
ENVELOPE = T.StructType(
    [
        T.StructField("object_id", T.StringType()),
        T.StructField("object_type", T.StringType()),
        T.StructField("sent_dttm", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)

ENVELOPE_WITH_CORRUPT = T.StructType(
    ENVELOPE.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())]
)

TRANSACTION_PAYLOAD = T.StructType(
    [
        T.StructField("operation_id", T.StringType()),
        T.StructField("account_number_from", T.LongType()),
        T.StructField("account_number_to", T.LongType()),
        T.StructField("currency_code", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("amount", T.LongType()),
        # from_json parses leniently ('T' or space, optional fraction) and
        # nulls only this field on bad text, also under ANSI mode
        T.StructField("transaction_dt", T.TimestampType()),
    ]
)

CURRENCY_PAYLOAD = T.StructType(
    [
        # a full timestamp: the time of day of a rate update is kept
        T.StructField("date_update", T.TimestampType()),
        T.StructField("currency_code", T.IntegerType()),
        T.StructField("currency_code_with", T.IntegerType()),
        T.StructField("currency_with_div", T.FloatType()),
    ]
)

#: Parity variant: ``date_update`` read as a DATE, so the time of day is lost
#: and the clean value is midnight.
CURRENCY_PAYLOAD_DATE_ONLY = T.StructType(
    [T.StructField("date_update", T.DateType())] + CURRENCY_PAYLOAD.fields[1:]
)

#: Exact rates: the JSON number read as decimal(18, 6), not a 4-byte float
#: (2.36 stays 2.360000 instead of 2.359999895095825).
EXACT_RATE = T.DecimalType(18, 6)

#: Partition layout of the three output tables. ``stream_id`` and
#: ``batch_id`` make a retried micro-batch replace exactly its own files.
RAW_PARTITIONS = ("object_type", "date", "hour", "stream_id", "batch_id")
CLEAN_PARTITIONS = ("date", "hour", "stream_id", "batch_id")

RAW_TABLE = T.StructType(
    [
        T.StructField("object_id", T.StringType()),
        T.StructField("sent_dttm", T.TimestampType()),
        T.StructField("payload", T.StringType()),
        T.StructField("trigger_dttm", T.TimestampType()),
        T.StructField("object_type", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

CLEAN_TRANSACTIONS = T.StructType(
    [
        T.StructField("operation_id", T.StringType()),
        T.StructField("account_number_from", T.LongType()),
        T.StructField("account_number_to", T.LongType()),
        T.StructField("currency_code", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("transaction_dt", T.TimestampType()),
        T.StructField("trigger_dttm", T.TimestampType()),
        T.StructField("date", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

CLEAN_CURRENCIES = T.StructType(
    [
        T.StructField("object_id", T.StringType()),
        T.StructField("date_update", T.TimestampType()),
        T.StructField("currency_code", T.IntegerType()),
        T.StructField("currency_code_with", T.IntegerType()),
        T.StructField("currency_with_div", T.FloatType()),
        T.StructField("trigger_dttm", T.TimestampType()),
        T.StructField("date", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
