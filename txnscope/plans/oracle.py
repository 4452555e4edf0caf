"""DuckDB SQL for every compared query: an independent statement of the same semantics.

Runs against the raw tables (``events`` etc. registered as views). The adapter from
events to transactions is restated in SQL, windows use ``time_bucket``; nothing here
calls Spark. Column names and order match the Spark queries of ``plans.catalog``.
"""

from __future__ import annotations

from txnscope.config import ANOMALY, FRAUD

_A_AMOUNT = ANOMALY.rules[0].threshold
_A_COUNT = ANOMALY.rules[1].threshold
_B_AMOUNT = FRAUD.rules[0].threshold
_B_COUNT = FRAUD.rules[1].threshold
_B_TOTAL = FRAUD.rules[2].threshold
_DAY_S = 86_400

TXN = """txn AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         printf('user_%03d', user_id) AS user_id,
         round(value * 10, 2) AS amount,
         'm_' || CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 15 AS VARCHAR) AS merchant,
         event_type AS merchant_category,
         ts AS arrival_time,
         ts AS event_timestamp
  FROM events
)"""


def _iso_local(c: str) -> str:
    return (
        f"(CASE WHEN epoch_us({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END)"
    )


def _iso_utc(c: str) -> str:
    return f"({_iso_local(c)} || '+00:00')"


def _windows(name: str, interval: str, metrics: str, source: str = "txn") -> str:
    return f"""{name} AS (
  SELECT time_bucket(INTERVAL '{interval}', event_timestamp) AS window_start,
         time_bucket(INTERVAL '{interval}', event_timestamp) + INTERVAL '{interval}' AS window_end,
         user_id, {metrics}
  FROM {source} WHERE event_timestamp IS NOT NULL
  GROUP BY 1, 2, 3
)"""


A_METRICS = "count(*) AS transaction_count, max(amount) AS max_amount"
B_METRICS = (
    "count(*) AS transaction_count, CAST(sum(CAST(amount AS DECIMAL(28,10))) AS DOUBLE) AS total_amount, max(amount) AS max_amount, "
    "min(amount) AS min_amount, count(DISTINCT merchant_category) AS distinct_merchant_categories"
)
A_FLAGS = (
    f"(max_amount > {_A_AMOUNT}) AS is_high_amount, (transaction_count > {_A_COUNT}) AS is_high_frequency, "
    f"((max_amount > {_A_AMOUNT}) OR (transaction_count > {_A_COUNT})) AS is_anomaly"
)
A_FLAG_LIST = (
    f"concat_ws(',', CASE WHEN max_amount > {_A_AMOUNT} THEN 'HIGH_AMOUNT' END, "
    f"CASE WHEN transaction_count > {_A_COUNT} THEN 'HIGH_FREQUENCY' END)"
)
B_FLAG_LIST = (
    f"concat_ws(',', CASE WHEN max_amount > {_B_AMOUNT} THEN 'HIGH_SINGLE_TRANSACTION' END, "
    f"CASE WHEN transaction_count > {_B_COUNT} THEN 'HIGH_FREQUENCY' END, "
    f"CASE WHEN total_amount > {_B_TOTAL} THEN 'HIGH_TOTAL_SPEND' END)"
)
B_FRAUD = (
    f"((max_amount > {_B_AMOUNT}) OR (transaction_count > {_B_COUNT}) OR (total_amount > {_B_TOTAL}))"
)


def _money(c: str) -> str:
    # via text: the shortest decimal form of the double, then half-up to 2 places
    return f"CAST(CAST({c} AS VARCHAR) AS DECIMAL(18,2))"


WIN_A_DAY = _windows("win", "1 day", A_METRICS)
WIN_A_MIN = _windows("win", "1 minute", A_METRICS)
WIN_B_DAY = _windows("win", "1 day", B_METRICS)

RECORDS = f"""rec AS (
  SELECT user_id || '#' || {_iso_local('window_start')} AS transaction_id,
         user_id,
         {_iso_local('window_start')} AS window_start,
         {_iso_local('window_end')} AS window_end,
         transaction_count,
         {_money('max_amount')} AS max_amount,
         {A_FLAG_LIST} AS anomaly_flags,
         true AS is_anomaly,
         {_iso_utc('window_end')} AS detected_at,
         CAST(epoch(window_end) AS BIGINT) + {ANOMALY.record_ttl_days * _DAY_S} AS ttl,
         window_end AS _detected
  FROM win
  WHERE (max_amount > {_A_AMOUNT}) OR (transaction_count > {_A_COUNT})
)"""

RECORD_COLUMNS = (
    "transaction_id, user_id, window_start, window_end, transaction_count, max_amount, "
    "anomaly_flags, is_anomaly, detected_at, ttl"
)

FRAUD_AGGS = f"""agg AS (
  SELECT user_id AS pk,
         {_iso_local('window_start')} AS sk,
         user_id,
         {_iso_local('window_start')} AS window_start,
         {_iso_local('window_end')} AS window_end,
         transaction_count,
         {_money('total_amount')} AS total_amount,
         {_money('max_amount')} AS max_amount,
         {_money('min_amount')} AS min_amount,
         distinct_merchant_categories AS distinct_categories,
         coalesce({B_FRAUD}, false) AS is_fraud,
         {B_FLAG_LIST} AS fraud_flags,
         {_iso_utc('window_end')} AS processed_at,
         CAST(epoch(window_end) AS BIGINT) + {FRAUD.record_ttl_days * _DAY_S} AS ttl
  FROM win
)"""

FEED = """feed AS (
  SELECT * FROM rec ORDER BY _detected DESC, transaction_id LIMIT 50
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


COLD_COLUMNS = (
    "transaction_id, user_id, amount, merchant, merchant_category, arrival_time, event_timestamp, "
    "CAST(year(event_timestamp) AS INTEGER) AS year, CAST(month(event_timestamp) AS INTEGER) AS month, "
    "CAST(day(event_timestamp) AS INTEGER) AS day"
)
MONTH = "year(event_timestamp) = 2024 AND month(event_timestamp) = 1"

# Encoded events as JSON text (timestamps with offset; NULL fields left out like to_json).
ENCODED = f"""enc AS (
  SELECT user_id AS key,
         json_object('transaction_id', transaction_id, 'user_id', user_id, 'amount', amount,
                     'merchant', merchant, 'timestamp', {_iso_utc('event_timestamp')},
                     'merchant_category', merchant_category)::VARCHAR AS raw,
         arrival_time, transaction_id
  FROM txn
)"""

# Some records are damaged, by their number: cut off, without fields, with an amount that does not fit.
DAMAGED = """dmg AS (
  SELECT CASE CAST(transaction_id AS BIGINT) % 17
           WHEN 3 THEN left(raw, 20)
           WHEN 5 THEN '{"transaction_id":"' || transaction_id || '"}'
           WHEN 7 THEN '{"transaction_id":"' || transaction_id || '","user_id":"u","amount":1e20,"timestamp":"2024-01-01T00:00:00Z"}'
           ELSE raw END AS raw,
         arrival_time
  FROM enc
)"""

EDGE_PAYLOADS = """edge(raw, arrival_time) AS (
  SELECT raw, TIMESTAMP '2026-05-28 12:00:05' FROM (VALUES
    ('{"transaction_id":"a","user_id":"u1","amount":12.5,"merchant":"m","timestamp":"2026-05-28T12:00:00.123456+00:00"}'),
    ('not json'),
    ('{"transaction_id":"b","user_id":"u1","amount":"oops","merchant":"m","timestamp":"2026-05-28T12:00:00+00:00"}'),
    ('{"transaction_id":"c","amount":5,"timestamp":"garbage"}'),
    (NULL),
    ('{"transaction_id":"d","user_id":"u1","amount":3,"timestamp":"2026-05-28T12:00:00Z","extra":1}'),
    ('{"transaction_id":"f","user_id":"u1","amount":"7.5","timestamp":"2026-05-28T12:00:00Z"}'),
    ('{}')
  ) AS v(raw)
)"""


def _missing(field: str) -> str:
    return f"CASE WHEN json_extract_string(j, '$.{field}') IS NULL THEN '{field}' END"


CLASSIFIED = f"""payloads AS (
  SELECT raw, arrival_time FROM dmg UNION ALL SELECT raw, arrival_time FROM edge
),
valid_json AS (
  SELECT raw, arrival_time,
         CASE WHEN raw IS NULL OR trim(raw) = '' THEN NULL ELSE json_valid(raw) END AS ok_json,
         CASE WHEN json_valid(raw) THEN raw END AS j
  FROM payloads
),
cls AS (
  SELECT raw, arrival_time, ok_json, j,
         json_type(j, '$.amount') AS amount_type,
         concat_ws(',', {_missing('transaction_id')}, {_missing('user_id')}, {_missing('amount')},
                   {_missing('timestamp')}) AS missing
  FROM valid_json
),
parsed AS (
  SELECT raw, arrival_time,
         json_extract_string(j, '$.transaction_id') AS transaction_id,
         json_extract_string(j, '$.user_id') AS user_id,
         TRY_CAST(json_extract_string(j, '$.amount') AS DOUBLE) AS amount,
         json_extract_string(j, '$.merchant') AS merchant,
         json_extract_string(j, '$.merchant_category') AS merchant_category,
         TRY_CAST(json_extract_string(j, '$.timestamp') AS TIMESTAMP) AS event_timestamp,
         CASE WHEN ok_json IS NULL THEN 'EMPTY_PAYLOAD'
              WHEN NOT ok_json THEN 'MALFORMED_JSON'
              WHEN amount_type IS NOT NULL AND amount_type NOT IN ('DOUBLE', 'BIGINT', 'UBIGINT', 'NULL')
                THEN 'BAD_FIELD_TYPE'
              WHEN missing <> '' THEN 'MISSING_FIELD:' || missing
              WHEN abs(TRY_CAST(json_extract_string(j, '$.amount') AS DOUBLE)) >= 1e16 THEN 'BAD_AMOUNT'
              WHEN TRY_CAST(json_extract_string(j, '$.timestamp') AS TIMESTAMP) IS NULL THEN 'BAD_TIMESTAMP'
         END AS reject_reason
  FROM cls
)"""


def _sliding(metrics: str = "count(*) AS transaction_count, max(amount) AS max_amount") -> str:
    return f"""sw AS (
  SELECT time_bucket(INTERVAL '1 minute', event_timestamp) - k * INTERVAL '1 minute' AS window_start,
         user_id, amount, merchant_category
  FROM txn CROSS JOIN range(0, 5) AS r(k)
  WHERE event_timestamp IS NOT NULL
),
win AS (
  SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, user_id, {metrics}
  FROM sw GROUP BY 1, 2, 3
)"""


# Transactions dealt out over the replay's batches (steps that have rows, numbered), and the rows of windows of a day
# that had ended by the watermark of the batch before theirs.
def _replay(delay: str) -> str:
    return f"""bounds AS (
  SELECT min(epoch_us(event_timestamp)) AS low, max(epoch_us(event_timestamp)) AS high,
         greatest(6, CAST(ceil(count(*) / 1000000.0) AS BIGINT)) AS steps
  FROM txn
),
stepped AS (
  SELECT txn.*, least(steps - 1, coalesce((steps * (epoch_us(event_timestamp) - low)) // (high - low + 1), 0) + {delay}) AS step
  FROM txn, bounds
),
dealt AS (SELECT *, dense_rank() OVER (ORDER BY step) - 1 AS batch FROM stepped),
highs AS (SELECT batch, max(event_timestamp) AS high FROM dealt GROUP BY batch),
marks AS (
  SELECT b.batch, date_trunc('milliseconds', max(h.high)) - INTERVAL '{ANOMALY.watermark}' AS mark
  FROM highs b LEFT JOIN highs h ON h.batch <= b.batch - 2 GROUP BY b.batch
),
placed AS (
  SELECT dealt.*, time_bucket(INTERVAL '1 day', event_timestamp) AS window_start,
         time_bucket(INTERVAL '1 day', event_timestamp) + INTERVAL '1 day' AS window_end, mark
  FROM dealt JOIN marks USING (batch)
),
intime AS (SELECT * FROM placed WHERE mark IS NULL OR window_end > mark)"""


TWO_STEPS_LATE = "CASE CAST(transaction_id AS BIGINT) % 13 WHEN 6 THEN 1 WHEN 5 THEN 2 ELSE 0 END"
SEALED = f"(SELECT max(event_timestamp) FROM txn) - INTERVAL '{ANOMALY.watermark}'"
SCREENED = "screened AS (SELECT * FROM txn WHERE CAST(transaction_id AS BIGINT) % 17 NOT IN (3, 5, 7))"
NO_EDGES = "edge(raw, arrival_time) AS (SELECT CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP) WHERE false)"


FRAUD_ALERTS_SQL = (
    _with(TXN, WIN_B_DAY, FRAUD_AGGS)
    + "SELECT pk || '#' || sk AS alert_id, user_id, window_start, window_end, transaction_count, "
    "total_amount, max_amount, fraud_flags, "
    "CASE WHEN len(string_split(fraud_flags, ',')) > 1 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, "
    "'NEW' AS status, processed_at AS created_at, "
    f"ttl + {(FRAUD.alert_ttl_days - FRAUD.record_ttl_days) * _DAY_S} AS ttl FROM agg WHERE is_fraud"
)
DECODED_SQL = (
    _with(TXN) + "SELECT transaction_id, user_id, amount, merchant, merchant_category, arrival_time, event_timestamp FROM txn"
)

ORACLE: dict[str, str] = {
    "anomaly_windows": _with(TXN, WIN_A_DAY)
    + f"SELECT window_start, window_end, user_id, transaction_count, max_amount, {A_FLAGS} FROM win",
    "anomaly_windows_1min": _with(TXN, _windows("win", "1 minute", A_METRICS))
    + f"SELECT window_start, window_end, user_id, transaction_count, max_amount, {A_FLAGS} FROM win",
    "anomaly_records": _with(TXN, WIN_A_DAY, RECORDS) + f"SELECT {RECORD_COLUMNS} FROM rec",
    "anomaly_records_1min": _with(TXN, WIN_A_MIN, RECORDS) + f"SELECT {RECORD_COLUMNS} FROM rec",
    "fraud_windows": _with(TXN, WIN_B_DAY)
    + "SELECT window_start, window_end, user_id, transaction_count, round(total_amount, 2) AS total_amount, "
    "max_amount, min_amount, distinct_merchant_categories, "
    f"(max_amount > {_B_AMOUNT}) AS is_high_amount, (transaction_count > {_B_COUNT}) AS is_high_frequency, "
    f"(total_amount > {_B_TOTAL}) AS is_high_total_spend, {B_FRAUD} AS is_fraud FROM win",
    "fraud_aggregates": _with(TXN, WIN_B_DAY, FRAUD_AGGS) + "SELECT * FROM agg",
    "fraud_alerts": FRAUD_ALERTS_SQL,
    "fraud_alerts_live": f"SELECT * FROM ({FRAUD_ALERTS_SQL}) WHERE ttl > CAST(epoch(TIMESTAMP '2024-02-15 00:00:00') AS BIGINT)",
    "sliding_windows": _with(TXN, _sliding())
    + f"SELECT window_start, window_end, user_id, transaction_count, max_amount, {A_FLAG_LIST} AS anomaly_flags, "
    f"((max_amount > {_A_AMOUNT}) OR (transaction_count > {_A_COUNT})) AS is_anomaly FROM win",
    "cold_roundtrip": _with(TXN) + f"SELECT {COLD_COLUMNS} FROM txn",
    "cold_partition_counts": _with(TXN)
    + "SELECT CAST(year(event_timestamp) AS INTEGER) AS year, CAST(month(event_timestamp) AS INTEGER) AS month, "
    "CAST(day(event_timestamp) AS INTEGER) AS day, count(*) AS txn_count FROM txn GROUP BY 1, 2, 3",
    "high_value_txns": _with(TXN)
    + f"SELECT transaction_id, user_id, amount, merchant, event_timestamp FROM txn "
    f"WHERE amount > {_A_AMOUNT} AND {MONTH} ORDER BY amount DESC, transaction_id LIMIT 50",
    "top_users": _with(TXN)
    + "SELECT user_id, count(*) AS txn_count, round(sum(amount), 2) AS total_spend, max(amount) AS max_single_txn "
    f"FROM txn WHERE {MONTH} GROUP BY user_id ORDER BY txn_count DESC, user_id LIMIT 10",
    "hourly_volume": _with(TXN)
    + "SELECT date_trunc('hour', event_timestamp) AS hour_bucket, count(*) AS txn_count, "
    f"round(sum(amount), 2) AS total_amount FROM txn WHERE {MONTH} GROUP BY 1 ORDER BY 1",
    "top_merchants": _with(TXN)
    + "SELECT merchant, count(*) AS txn_count, round(avg(amount), 2) AS avg_amount, max(amount) AS max_amount "
    f"FROM txn WHERE year(event_timestamp) = 2024 GROUP BY merchant ORDER BY txn_count DESC, merchant LIMIT 20",
    "fraud_sliding_windows": _with(TXN, _sliding(B_METRICS))
    + "SELECT window_start, window_end, user_id, transaction_count, total_amount, max_amount, min_amount, distinct_merchant_categories, "
    f"(max_amount > {_B_AMOUNT}) AS is_high_amount, (transaction_count > {_B_COUNT}) AS is_high_frequency, "
    f"(total_amount > {_B_TOTAL}) AS is_high_total_spend, {B_FRAUD} AS is_fraud FROM win",
    "cold_catalog_scan": _with(TXN) + f"SELECT {COLD_COLUMNS} FROM txn",
    "stream_anomalies_screened": _with(TXN, SCREENED, _windows("win", "1 day", A_METRICS, "screened"), RECORDS)
    + f"SELECT {RECORD_COLUMNS} FROM rec",
    "stream_screened_rejects": _with(TXN, ENCODED, DAMAGED, NO_EDGES, CLASSIFIED)
    + "SELECT raw, arrival_time, reject_reason FROM parsed WHERE reject_reason IS NOT NULL",
    "stream_anomalies_replayed": _with(TXN, WIN_A_DAY, RECORDS) + f"SELECT {RECORD_COLUMNS} FROM rec",
    "stream_final_replayed": _with(TXN, _replay(TWO_STEPS_LATE), _windows("win", "1 day", A_METRICS, "intime"), RECORDS)
    + f"SELECT {RECORD_COLUMNS} FROM rec WHERE _detected <= {SEALED}",
    "stream_open_windows": _with(TXN, _replay(TWO_STEPS_LATE), _windows("win", "1 day", A_METRICS, "intime"))
    + f"SELECT window_start, window_end, user_id, transaction_count, max_amount, {A_FLAGS} FROM win WHERE window_end > {SEALED}",
    "stream_late_rows": _with(TXN, _replay(TWO_STEPS_LATE))
    + "SELECT transaction_id, user_id, amount, merchant, merchant_category, arrival_time, event_timestamp, window_start, "
    "window_end, mark AS watermark, CAST(batch AS BIGINT) AS batch_id FROM placed WHERE window_end <= mark",
    "stream_batch_flags": _with(TXN, _replay(TWO_STEPS_LATE))
    + """, touched AS (
  SELECT batch, window_start, user_id, count(*) AS n, max(amount) AS m FROM intime GROUP BY ALL
), running AS (
  SELECT batch, sum(n) OVER (PARTITION BY window_start, user_id ORDER BY batch) AS n,
         max(m) OVER (PARTITION BY window_start, user_id ORDER BY batch) AS m
  FROM touched
)
"""
    + "SELECT CAST(batch AS BIGINT) AS batch_id, count(*) AS windows, "
    f"count(*) FILTER (WHERE m > {_A_AMOUNT} OR n > {_A_COUNT}) AS flagged FROM running GROUP BY batch",
    "stream_cold_resumed": _with(TXN) + f"SELECT {COLD_COLUMNS} FROM txn",
    "stream_anomalies_resumed": _with(TXN, WIN_A_DAY, RECORDS) + f"SELECT {RECORD_COLUMNS} FROM rec",
    "stream_sliding": _with(TXN, _sliding())
    + f"SELECT window_start, window_end, user_id, transaction_count, max_amount, {A_FLAG_LIST} AS anomaly_flags, "
    f"((max_amount > {_A_AMOUNT}) OR (transaction_count > {_A_COUNT})) AS is_anomaly FROM win WHERE window_end <= {SEALED}",
    "stream_stats": _with(TXN)
    + f"SELECT count(*) AS total_sent, count(*) FILTER (WHERE amount > {_A_AMOUNT}) AS total_anomalies, "
    f"round(100.0 * count(*) FILTER (WHERE amount > {_A_AMOUNT}) / count(*), 2) AS pct_anomalies FROM txn",
    "serving_feed": _with(TXN, WIN_A_DAY, RECORDS, FEED)
    + "SELECT _detected AS detected_at, user_id, CAST(window_start AS TIMESTAMP) AS window_start, "
    "CAST(window_end AS TIMESTAMP) AS window_end, transaction_count, CAST(max_amount AS DOUBLE) AS max_amount, "
    "anomaly_flags FROM feed",
    "kpi_summary": _with(TXN, WIN_A_DAY, RECORDS, FEED)
    + "SELECT (SELECT count(*) FROM feed) AS shown, (SELECT count(*) FROM rec) AS total, "
    "(SELECT max(_detected) FROM feed) AS latest_detected_at, "
    "(SELECT strftime(max(_detected), '%H:%M:%S') || ' UTC' FROM feed) AS latest_label, "
    "(SELECT user_id FROM feed GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1) AS most_flagged_user",
    "flag_breakdown": _with(TXN, WIN_A_DAY, RECORDS, FEED)
    + "SELECT flag, count(*) AS count FROM (SELECT unnest(string_split(anomaly_flags, ',')) AS flag FROM feed) "
    "GROUP BY flag",
    "flag_breakdown_all": _with(TXN, WIN_A_DAY, RECORDS)
    + "SELECT flag, count(*) AS count FROM (SELECT unnest(string_split(anomaly_flags, ',')) AS flag FROM rec) "
    "GROUP BY flag",
    "amount_by_window": _with(TXN, WIN_A_DAY, RECORDS, FEED)
    + "SELECT strftime(CAST(window_start AS TIMESTAMP), '%H:%M') AS window_start_label, user_id, "
    "CAST(max_amount AS DOUBLE) AS max_amount FROM feed WHERE max_amount IS NOT NULL "
    "ORDER BY _detected DESC, transaction_id LIMIT 20",
    "live_anomalies": _with(TXN, WIN_A_DAY, RECORDS)
    + f"SELECT {RECORD_COLUMNS} FROM rec WHERE ttl > CAST(epoch(TIMESTAMP '2024-02-15 00:00:00') AS BIGINT)",
    "encode_payload": _with(TXN)
    + f"SELECT user_id AS key, transaction_id, user_id, amount, merchant, merchant_category, {_iso_utc('event_timestamp')} AS timestamp "
    "FROM txn",
    "decode_payload": DECODED_SQL,
    "valid_txns": _with(TXN, ENCODED, DAMAGED, EDGE_PAYLOADS, CLASSIFIED)
    + "SELECT transaction_id, user_id, amount, merchant, merchant_category, arrival_time, event_timestamp FROM parsed "
    "WHERE reject_reason IS NULL",
    "quarantine": _with(TXN, ENCODED, DAMAGED, EDGE_PAYLOADS, CLASSIFIED)
    + "SELECT raw, arrival_time, reject_reason FROM parsed WHERE reject_reason IS NOT NULL",
    "stream_cold_path": _with(TXN) + f"SELECT {COLD_COLUMNS} FROM txn",
    "stream_anomalies": _with(TXN, WIN_A_DAY, RECORDS) + f"SELECT {RECORD_COLUMNS} FROM rec",
    "stream_anomalies_final": _with(TXN, WIN_A_DAY, RECORDS)
    + f"SELECT {RECORD_COLUMNS} FROM rec "
    f"WHERE _detected <= (SELECT max(ts) FROM events) - INTERVAL '{ANOMALY.watermark}'",
    "stream_fraud_alerts": FRAUD_ALERTS_SQL,
    "stream_valid_txns": DECODED_SQL + " WHERE CAST(transaction_id AS BIGINT) % 17 NOT IN (3, 5, 7)",
}
ORACLE["txn_stats"] = ORACLE["stream_stats"]
ORACLE["serving_feed_stored"] = ORACLE["serving_feed"]
