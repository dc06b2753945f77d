"""DuckDB SQL oracles, one per registered query, over the driver's views.

Written independently of the Spark code from the stand-in definitions in
``standins`` (same mapping, stated in SQL).
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S'"

EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""

PAYLOAD = f"""CASE
  WHEN event_type = 'purchase' THEN
    '{{"operation_id":"' || CAST(event_id AS VARCHAR)
    || '","account_number_from":' || CAST(user_id AS VARCHAR)
    || ',"account_number_to":' || CAST(k AS VARCHAR)
    || ',"transaction_type":"purchase","amount":'
    || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)
    || ',"transaction_dt":"' || strftime(ts, {TS}) || '"}}'
  WHEN event_type = 'view' THEN
    '{{"date_update":"' || strftime(ts, {TS})
    || '","currency_code":' || CAST(user_id AS VARCHAR)
    || ',"currency_code_with":' || CAST(k AS VARCHAR)
    || ',"currency_with_div":' || CAST(value AS VARCHAR) || '}}'
  ELSE '{{"k":' || CAST(k AS VARCHAR) || '}}'
END"""

OBJECT_TYPE = """CASE event_type WHEN 'purchase' THEN 'transaction'
  WHEN 'view' THEN 'currency' ELSE lower(event_type) END"""


def msg(src: str, extra: str = "") -> str:
    """Normalised messages of an events-shaped relation ``src``."""
    return f"""SELECT CAST(event_id AS VARCHAR) AS object_id,
  {OBJECT_TYPE} AS object_type,
  date_trunc('second', ts) AS sent_dttm,
  {PAYLOAD} AS payload{extra}
FROM {src}"""


RETRY = """feed AS (
  SELECT event_id, ts, user_id, event_type, value, props, k FROM ev
  UNION ALL
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN ts + INTERVAL 1 SECOND ELSE ts END,
         user_id, event_type, value, props, k FROM ev)"""

DEDUP = f"""WITH {EV}, {RETRY}
SELECT DISTINCT object_id, object_type, sent_dttm, payload FROM ({msg('feed')}) m"""

ARRIVAL0 = ("least(greatest(floor(datediff('day', DATE '2024-01-01', "
            "CAST(ts AS DATE)) / 6), 0), 4)")

ARRIVALS = f"""arr AS (
  SELECT *, CAST({ARRIVAL0} AS INTEGER) AS b0 FROM ev),
deliv AS (
  SELECT *, CASE WHEN event_type = 'error' THEN least(b0 + 2, 4) ELSE b0 END AS arrival
  FROM arr
  UNION ALL
  SELECT *, least(b0 + 1, 4) AS arrival FROM arr WHERE event_type = 'signup'),
m AS ({msg('deliv', ', arrival')}),
bm AS (SELECT arrival, max(sent_dttm) AS bmax FROM m GROUP BY arrival),
wm AS (
  SELECT arrival,
         max(bmax) OVER (ORDER BY arrival
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - INTERVAL 1 HOUR AS watermark
  FROM bm)"""

#: One run, an arrival per micro-batch: rows are late for the watermark of the
#: batch before, which has seen the arrivals before that; state is evicted by
#: the batch's own.
ONE_RUN = f"""{ARRIVALS},
wm2 AS (
  SELECT arrival,
         max(bmax) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
           - INTERVAL 1 HOUR AS late_mark,
         max(bmax) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - INTERVAL 1 HOUR AS evict_mark
  FROM bm),
seen AS (
  SELECT m.*, coalesce(sent_dttm <= late_mark, false) AS is_late
  FROM m JOIN wm2 USING (arrival))"""

CLEAN_TX = f"""WITH {EV}
SELECT CAST(event_id AS VARCHAR) AS operation_id,
       user_id AS account_number_from,
       k AS account_number_to,
       CAST(NULL AS INTEGER) AS currency_code,
       CAST(NULL AS VARCHAR) AS country,
       CAST(NULL AS VARCHAR) AS status,
       'purchase' AS transaction_type,
       CAST(round(value * 100) AS BIGINT) AS amount,
       date_trunc('second', ts) AS transaction_dt
FROM ev WHERE event_type = 'purchase'"""

TX = """tx AS (
  SELECT o_orderkey AS operation_id,
         CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '1-URGENT' THEN -1
              ELSE o_custkey END AS account_number_from,
         CASE o_orderstatus WHEN 'O' THEN 'queued' WHEN 'P' THEN 'in_progress'
              WHEN 'F' THEN 'done' END AS status,
         o_orderpriority AS transaction_type,
         o_totalprice AS amount,
         o_orderdate AS transaction_dt
  FROM orders)"""

RANK = """CAST(CASE status WHEN 'queued' THEN 1 WHEN 'in_progress' THEN 2
  WHEN 'blocked' THEN 3 WHEN 'done' THEN 4 WHEN 'chargeback' THEN 5 END AS INTEGER)"""

SEQ = f"""{TX},
seq AS (
  SELECT *,
    CASE WHEN account_number_from IS NOT NULL AND status IS NOT NULL THEN
      CAST(row_number() OVER (PARTITION BY account_number_from, status
                              ORDER BY transaction_dt, operation_id) - 1 AS BIGINT)
    END AS row_number
  FROM tx)"""

TOP_COLS = ("operation_id, account_number_from, status, status_rank, row_number, "
            "transaction_dt")
TOP_ORDER = ("account_number_from NULLS LAST, status_rank NULLS LAST, "
             "transaction_dt NULLS LAST, operation_id NULLS LAST")

TX_ENV = f"""SELECT
  '{{"object_id":"' || CAST(o_orderkey AS VARCHAR)
  || '","object_type":"TRANSACTION","sent_dttm":"' || @DT@
  || '","payload":{{"operation_id":"' || CAST(o_orderkey AS VARCHAR)
  || '","account_number_from":' || CAST(o_custkey AS VARCHAR)
  || ',"status":"' || o_orderstatus
  || '","transaction_type":"' || o_orderpriority
  || '","amount":' || CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)
  || ',"transaction_dt":"' || @DT@ || '"}}}}' AS value
FROM orders"""

HEX = "'0123456789abcdef'"
UUID = f"""substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3)
  || '-' || substr({HEX}, (((strpos({HEX}, substr(h, 17, 1)) - 1) & 3) | 8) + 1, 1)
  || substr(h, 18, 3) || '-' || substr(h, 21, 12)"""

CUR_BASE = f"""cur AS (
  SELECT CAST(l_suppkey AS INTEGER) AS currency_code,
         CAST(l_partkey AS INTEGER) AS currency_code_with,
         strftime(l_shipdate, {TS}) AS date_update,
         l_discount AS currency_with_div
  FROM lineitem),
hashed AS (
  SELECT *, sha1(unhex('7f288a2e0ad040398e596c9838d87307')
                 || encode(CAST(currency_code AS VARCHAR)
                           || CAST(currency_code_with AS VARCHAR) || date_update)) AS h
  FROM cur)"""

CUR_ENV = f"""WITH {CUR_BASE}
SELECT '{{"object_id":"' || {UUID}
  || '","object_type":"CURRENCY","sent_dttm":"' || date_update
  || '","payload":{{"date_update":"' || date_update
  || '","currency_code":' || CAST(currency_code AS VARCHAR)
  || ',"currency_code_with":' || CAST(currency_code_with AS VARCHAR)
  || ',"currency_with_div":' || CAST(currency_with_div AS VARCHAR) || '}}}}' AS value
FROM hashed"""

ORACLES: dict[str, str] = {
    "scan_parquet": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  o_orderdate FROM orders""",
    "partition_pruned_read": """SELECT event_id, ts, event_type, user_id, value,
  CAST(hour(ts) AS INTEGER) AS hour
FROM events WHERE strftime(ts, '%Y-%m-%d') = '2024-01-15'""",
    "envelope_decode": f"WITH {EV} {msg('ev')}",
    "envelope_encode_tx": TX_ENV.replace("@DT@", f"strftime(o_orderdate, {TS})"),
    "envelope_encode_cur": CUR_ENV,
    "envelope_union": ("SELECT value FROM ("
                       + TX_ENV.replace("@DT@", f"strftime(o_orderdate, {TS})")
                       + ")\nUNION ALL\nSELECT value FROM (" + CUR_ENV + ")"),
    "replay_restamp": TX_ENV.replace("@DT@", "'2026-01-01 00:00:00'"),
    "uuid5_id": f"""WITH {CUR_BASE}
SELECT currency_code, currency_code_with, date_update, {UUID} AS object_id
FROM hashed""",
    "normalize_event_time": """WITH t AS (
  SELECT event_id, lower(upper(event_type)) AS object_type,
    CASE WHEN event_type IN ('purchase', 'view') THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
         WHEN event_type IN ('click', 'signup') THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END AS sent_text
  FROM events)
SELECT event_id, object_type, sent_text,
  try_strptime(replace(sent_text, 'T', ' '), '%Y-%m-%d %H:%M:%S') AS sent_dttm
FROM t""",
    "ingest_metadata": f"""SELECT event_id, ts AS trigger_dttm,
  strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour,
  CAST({ARRIVAL0} AS BIGINT) AS batch_id
FROM events""",
    "route_by_type": f"""WITH {EV}, m AS ({msg('ev')})
SELECT CASE WHEN object_type IN ('transaction', 'currency') THEN object_type
            ELSE 'raw_only' END AS route,
       object_type, count(*) AS messages
FROM m GROUP BY ALL""",
    "clean_transactions": CLEAN_TX,
    "clean_currencies": f"""WITH {EV}
SELECT CAST(event_id AS VARCHAR) AS object_id,
       date_trunc('second', ts) AS date_update,
       CAST(user_id AS INTEGER) AS currency_code,
       CAST(k AS INTEGER) AS currency_code_with,
       CAST(value AS FLOAT) AS currency_with_div
FROM ev WHERE event_type = 'view'""",
    "dedup_exact": DEDUP,
    "raw_layer": DEDUP,
    # emitted once the watermark (max event time - 1 hour, inclusive) passed
    "dedup_finalized": DEDUP,
    "stream_ingest": CLEAN_TX,
    "stream_fanout": f"""WITH {EV}, {RETRY},
d AS (SELECT DISTINCT object_id, object_type, sent_dttm, payload
      FROM ({msg('feed')}) m)
SELECT 'raw/' || object_type AS table_name, count(*) AS rows FROM d GROUP BY 1
UNION ALL SELECT 'transactions', count(*) FROM d WHERE object_type = 'transaction'
UNION ALL SELECT 'currencies', count(*) FROM d WHERE object_type = 'currency'""",
    "late_rows": f"""WITH {EV}, {ARRIVALS}
SELECT m.object_id, m.object_type, m.sent_dttm, m.arrival
FROM m JOIN wm USING (arrival) WHERE m.sent_dttm <= wm.watermark""",
    "dedup_watermark": f"""WITH {EV}, {ARRIVALS}
SELECT DISTINCT m.object_id, m.object_type, m.sent_dttm, m.payload
FROM m JOIN wm USING (arrival)
WHERE NOT coalesce(m.sent_dttm <= wm.watermark, false)""",
    "batch_metrics": f"""WITH {EV}, {ARRIVALS},
rows_in AS (SELECT arrival, count(*) AS rows_in FROM m GROUP BY arrival),
firsts AS (SELECT object_id, object_type, sent_dttm, min(arrival) AS arrival
           FROM m GROUP BY object_id, object_type, sent_dttm),
rows_out AS (SELECT arrival, count(*) AS rows_out FROM firsts GROUP BY arrival)
SELECT i.arrival, i.rows_in, CAST(coalesce(o.rows_out, 0) AS BIGINT) AS rows_out
FROM rows_in i LEFT JOIN rows_out o USING (arrival)""",
    "filter_sentinel": f"""WITH {TX}
SELECT operation_id, account_number_from FROM tx
WHERE account_number_from IS DISTINCT FROM -1""",
    "filter_not_in": f"""WITH {TX}
SELECT operation_id, account_number_from FROM tx
WHERE NOT coalesce(account_number_from IN (-1, 42, 77), false)""",
    "point_lookup": f"""WITH {TX}
SELECT operation_id, account_number_from, status, transaction_type, amount,
  transaction_dt FROM tx WHERE operation_id = 1234""",
    "status_rank": f"""WITH {TX}
SELECT operation_id, status, {RANK} AS status_rank FROM tx""",
    "sequence_number": f"""WITH {SEQ}
SELECT operation_id, account_number_from, status, row_number FROM seq""",
    "deep_groups": f"""WITH {SEQ}
SELECT DISTINCT account_number_from FROM seq WHERE row_number > 4""",
    "semi_filter_topk": f"""WITH {SEQ},
r AS (SELECT *, {RANK} AS status_rank FROM seq)
SELECT {TOP_COLS} FROM r
WHERE account_number_from IS DISTINCT FROM -1
  AND account_number_from IN (SELECT account_number_from FROM seq WHERE row_number > 4)
  AND row_number > 1
ORDER BY {TOP_ORDER} LIMIT 20""",
    "double_semi_topk": f"""WITH {SEQ},
r AS (SELECT *, {RANK} AS status_rank FROM seq)
SELECT {TOP_COLS} FROM r
WHERE account_number_from IS DISTINCT FROM -1
  AND account_number_from IN (SELECT account_number_from FROM seq WHERE row_number > 4)
  AND transaction_dt IN (SELECT transaction_dt FROM seq WHERE row_number > 4)
ORDER BY {TOP_ORDER} LIMIT 100""",
    "topk_3key": f"""WITH {TX}
SELECT operation_id, account_number_from, transaction_type, status FROM tx
WHERE account_number_from IS DISTINCT FROM -1
ORDER BY account_number_from NULLS LAST, transaction_type NULLS LAST,
  status NULLS LAST, operation_id NULLS LAST
LIMIT 20""",
    "topk_7key": """SELECT * FROM lineitem
ORDER BY l_orderkey NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST,
  l_linenumber NULLS LAST, l_quantity NULLS LAST, l_extendedprice NULLS LAST,
  l_discount NULLS LAST, l_tax NULLS LAST, l_returnflag NULLS LAST,
  l_linestatus NULLS LAST, l_shipdate NULLS LAST
LIMIT 80""",
    "head_k": f"""WITH {TX}
SELECT operation_id, account_number_from, status, transaction_type, amount,
  transaction_dt FROM tx ORDER BY operation_id LIMIT 10""",
    "distinct_values": f"WITH {TX} SELECT DISTINCT status FROM tx",
    "shape": f"""WITH {TX}
SELECT 'all' AS frame, count(*) AS rows, CAST(6 AS INTEGER) AS columns FROM tx
UNION ALL
SELECT 'filtered', count(*), CAST(6 AS INTEGER) FROM tx
WHERE NOT coalesce(account_number_from IN (-1, 42, 77), false)""",
    "late_table": f"""WITH {EV}, {ONE_RUN}
SELECT mode, CAST(arrival AS BIGINT) AS batch_id, object_id, object_type, sent_dttm
FROM seen, (VALUES ('watermark_first'), ('within_watermark'), ('finalized')) v(mode) WHERE is_late""",
    "guarded_clock": f"""WITH {EV}, {ONE_RUN}
SELECT DISTINCT 'raw' AS table_name, object_id, sent_dttm FROM seen WHERE NOT is_late
UNION ALL SELECT 'late', object_id, sent_dttm FROM seen WHERE is_late
UNION ALL SELECT 'future_time', 'wild', TIMESTAMP '9999-12-31 00:00:00'""",
    "dedup_bounded": DEDUP,
    "reject_feed": f"""WITH {EV}, {RETRY},
r AS (
  SELECT event_type, {OBJECT_TYPE} AS object_type, event_id FROM feed)
SELECT CASE event_type WHEN 'click' THEN 'malformed' WHEN 'signup' THEN 'null_value' ELSE 'missing_object_id' END AS reject_reason,
       CASE event_type WHEN 'click' THEN left('{{"object_id":"' || CAST(event_id AS VARCHAR) || '","object_type":"CLICK","sent_dttm":', 30)
         WHEN 'error' THEN '{{}}' END AS raw_value
FROM r WHERE event_type IN ('click', 'signup', 'error')""",
    "observed_metrics": f"""WITH {EV}, {ARRIVALS},
o AS (SELECT object_id, object_type, sent_dttm, min(arrival) AS arrival FROM m GROUP BY ALL)
SELECT arrival, count(*) AS rows_in, (SELECT count(*) FROM o WHERE o.arrival = m.arrival) AS rows_out, 0::BIGINT AS rejected
FROM m GROUP BY arrival""",
    "state_audit": f"""WITH {EV}, {ONE_RUN}
SELECT CAST(wm2.arrival AS BIGINT) AS batch_id,
       (SELECT count(*) FROM (SELECT DISTINCT object_id, object_type, sent_dttm FROM seen
        WHERE NOT is_late AND seen.arrival <= wm2.arrival AND (wm2.evict_mark IS NULL OR sent_dttm > wm2.evict_mark))) AS state_rows
FROM wm2""",
    "compacted_layer": """SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS rows, count(DISTINCT event_id % 3) AS folders_before,
       CAST(1 AS BIGINT) AS folders_after, CAST(ceil(count(*) / 100.0) AS BIGINT) AS files_after
FROM events GROUP BY 1""",
    "manifest_read": """SELECT event_id, ts, event_type, user_id, value,
       CAST(ceil(count(*) OVER () / 100.0) AS BIGINT) AS files_listed
FROM events WHERE strftime(ts, '%Y-%m-%d') = '2024-01-15'""",
    "publish_once": f"""SELECT value, count(*) OVER () AS sent, count(*) OVER () AS sent_again
FROM ({TX_ENV.replace("@DT@", f"strftime(o_orderdate, {TS})")})""",
    "log_tail": f"""WITH {EV}, {ARRIVALS},
l AS (SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id, event_type, ts AS timestamp,
             row_number() OVER (PARTITION BY event_id % 3 ORDER BY arrival, ts, event_id) - 1 AS "offset" FROM deliv),
f AS (SELECT partition, min("offset") AS first FROM l WHERE timestamp >= TIMESTAMP '2024-01-20 12:00:00' GROUP BY partition)
SELECT 'offset' AS start, partition, "offset", event_id, event_type, timestamp FROM l WHERE "offset" >= 100
UNION ALL
SELECT 'time', l.partition, "offset", event_id, event_type, timestamp FROM l JOIN f USING (partition) WHERE "offset" >= first""",
    # a frame has no order: the view's scan keeps the file's
    "lookalike_in_order": f"""WITH o AS (SELECT *, row_number() OVER () AS place FROM orders),
t AS (SELECT place, o_orderkey AS operation_id,
        CASE WHEN o_orderpriority = '1-URGENT' THEN -1 ELSE o_custkey % 50 END AS account_number_from,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey % 3 END AS account_number_to,
        CAST(o_custkey % 2 + 840 AS INTEGER) AS currency_code,
        CASE WHEN o_custkey % 2 = 0 THEN 'usa' ELSE 'turkey' END AS country,
        CASE o_orderstatus WHEN 'O' THEN 'queued' WHEN 'P' THEN 'in_progress' WHEN 'F' THEN 'done' END AS status,
        o_orderpriority AS transaction_type, CAST(floor(o_totalprice / 200000) AS BIGINT) AS amount,
        o_orderdate AS transaction_dt FROM o)
SELECT * EXCLUDE (place), {RANK} AS status_rank,
       CASE WHEN account_number_from IS NOT NULL AND account_number_to IS NOT NULL THEN
         CAST(row_number() OVER (PARTITION BY account_number_from, account_number_to, currency_code, country, transaction_type, amount
                                 ORDER BY place) - 1 AS BIGINT) END AS row_number
FROM t""",
}
