"""Stand-ins: the driver's tables playing the roles of the collector's inputs.

* ``events`` is the message stream: a purchase is a transaction message, a
  view a currency-rate message, any other event type an unrouted message
  that reaches the raw layer only.
* ``orders`` is the transactions dump and the analysis frame.
* ``lineitem`` is the currency-rate dump.

Every mapping is a single projection (one pass, no join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.functions.json import envelope_json
from txlake.functions.time import format_event_time

# Fixed stand-in parameters ------------------------------------------------
ARRIVAL_DAYS = 6              # one arrival batch per 6 days of event time
ARRIVAL_START = "2024-01-01"  # first day of the events table
N_ARRIVALS = 5
LATE_EVENT_TYPE = "error"     # these arrive two batches after their time
REPEAT_EVENT_TYPE = "signup"  # these are delivered again one batch later
RESTAMP_EVENT_TYPE = "error"  # the retry feed re-sends these 1 s later


def _k() -> Column:
    return F.from_json(F.col("props"), "k long").getField("k")


def events_envelopes(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``events`` -> envelope text (``value``), one pass.

    The payload struct is the union of the transaction and currency fields
    plus ``k``; fields not meant for a type are null and so left out of the
    JSON text.
    """
    # parse props once; the projection below refers to it three times
    events = events.withColumn("_k", _k())
    et = F.col("event_type")
    is_tx, is_cur = et == "purchase", et == "view"
    other = ~(is_tx | is_cur)
    k = F.col("_k")
    ts_text = format_event_time(F.col("ts"))
    payload = F.struct(
        F.when(is_tx, F.col("event_id").cast("string")).alias("operation_id"),
        F.when(is_tx, F.col("user_id")).alias("account_number_from"),
        F.when(is_tx, k).alias("account_number_to"),
        F.when(is_tx, et).alias("transaction_type"),
        F.when(is_tx, F.round(F.col("value") * 100).cast("long")).alias("amount"),
        F.when(is_tx, ts_text).alias("transaction_dt"),
        F.when(is_cur, ts_text).alias("date_update"),
        F.when(is_cur, F.col("user_id").cast("int")).alias("currency_code"),
        F.when(is_cur, k.cast("int")).alias("currency_code_with"),
        F.when(is_cur, F.col("value")).alias("currency_with_div"),
        F.when(other, k).alias("k"),
    )
    wire_type = (F.when(is_tx, F.lit("TRANSACTION"))
                 .when(is_cur, F.lit("CURRENCY"))
                 .otherwise(F.upper(et)))
    value = envelope_json(F.col("event_id").cast("string"), wire_type,
                          format_event_time(F.col("ts"), "T"), payload)
    return events.select(*keep, value.alias("value"))


def with_retries(events: DataFrame) -> DataFrame:
    """Every event delivered twice, as an at-least-once producer does, from a
    single scan (``explode`` of the two deliveries). The second copy of a
    ``RESTAMP_EVENT_TYPE`` event is one second later: a new message."""
    d = F.explode(F.array(F.lit(0), F.lit(1))).alias("_delivery")
    two = events.select("*", d)
    shifted = F.when((F.col("_delivery") == 1)
                     & (F.col("event_type") == RESTAMP_EVENT_TYPE),
                     F.col("ts") + F.expr("INTERVAL 1 SECOND")).otherwise(F.col("ts"))
    return two.withColumn("ts", shifted).drop("_delivery")


def arrival_batch(ts: Column | None = None) -> Column:
    """Arrival batch of an on-time event: its 6-day slice of event time."""
    ts = F.col("ts") if ts is None else ts
    b = F.floor(F.datediff(ts.cast("date"), F.lit(ARRIVAL_START).cast("date"))
                / ARRIVAL_DAYS)
    return F.least(F.greatest(b, F.lit(0)), F.lit(N_ARRIVALS - 1)).cast("int")


def event_arrivals(events: DataFrame) -> DataFrame:
    """Events with the arrival batch they are delivered in.

    On-time events arrive in their own slice; ``LATE_EVENT_TYPE`` events two
    batches later; ``REPEAT_EVENT_TYPE`` events on time and again one batch
    later. Batches past the last are clamped to the last.
    """
    b = arrival_batch()
    last = F.lit(N_ARRIVALS - 1)
    first = F.when(F.col("event_type") == LATE_EVENT_TYPE, F.least(b + 2, last)) \
        .otherwise(b)
    deliveries = F.when(F.col("event_type") == REPEAT_EVENT_TYPE,
                        F.array(b, F.least(b + 1, last))).otherwise(F.array(first))
    return events.withColumn("arrival", F.explode(deliveries))


def orders_as_transactions(orders: DataFrame) -> DataFrame:
    """``orders`` as the analysis frame of transactions.

    ``account_number_from`` is the customer, except that priority
    ``1-URGENT`` orders carry the sentinel -1 (a hot key: a fifth of all
    rows) and ``5-LOW`` orders a null account. Status letters map to the
    lifecycle names (O queued, P in_progress, F done).
    """
    prio = F.col("o_orderpriority")
    account = (F.when(prio == "5-LOW", F.lit(None).cast("long"))
               .when(prio == "1-URGENT", F.lit(-1).cast("long"))
               .otherwise(F.col("o_custkey")))
    status = (F.when(F.col("o_orderstatus") == "O", "queued")
              .when(F.col("o_orderstatus") == "P", "in_progress")
              .when(F.col("o_orderstatus") == "F", "done"))
    return orders.select(
        F.col("o_orderkey").alias("operation_id"),
        account.alias("account_number_from"),
        status.alias("status"),
        prio.alias("transaction_type"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("transaction_dt"),
    )


def lookalike_transactions(orders: DataFrame) -> DataFrame:
    """``orders`` as transactions with all six look-alike keys, few values each
    so that groups are deep; columns other than the orders' own are kept."""
    own = [c for c in orders.columns if not c.startswith("o_")]
    key = F.col("o_custkey")
    status = (F.when(F.col("o_orderstatus") == "O", "queued").when(F.col("o_orderstatus") == "P", "in_progress")
              .when(F.col("o_orderstatus") == "F", "done"))
    prio = F.col("o_orderpriority")
    return orders.select(
        F.col("o_orderkey").alias("operation_id"),
        F.when(prio == "1-URGENT", F.lit(-1).cast("long")).otherwise(key % 50).alias("account_number_from"),
        F.when(prio != "5-LOW", key % 3).alias("account_number_to"),
        (key % 2 + 840).cast("int").alias("currency_code"),
        F.when(key % 2 == 0, "usa").otherwise("turkey").alias("country"),
        status.alias("status"), prio.alias("transaction_type"),
        F.floor(F.col("o_totalprice") / 200_000).cast("long").alias("amount"),
        F.col("o_orderdate").alias("transaction_dt"), *own)


def transactions_dump(orders: DataFrame) -> DataFrame:
    """``orders`` as the producer's transactions dump (9 payload columns;
    counterpart-less fields are null)."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("operation_id"),
        F.col("o_custkey").alias("account_number_from"),
        F.lit(None).cast("long").alias("account_number_to"),
        F.lit(None).cast("int").alias("currency_code"),
        F.lit(None).cast("string").alias("country"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("transaction_type"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("amount"),
        F.col("o_orderdate").alias("transaction_dt"),
    )


def currency_dump(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as the producer's currency-rate dump."""
    return lineitem.select(
        F.col("l_suppkey").cast("int").alias("currency_code"),
        F.col("l_partkey").cast("int").alias("currency_code_with"),
        F.col("l_shipdate").alias("date_update"),
        F.col("l_discount").alias("currency_with_div"),
    )
