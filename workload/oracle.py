"""The SQL each query must match, in DuckDB's dialect.

Written from the definitions, not from the Spark code: literal frames,
DISTINCT counts, joins, EXCEPT and UNION ALL, with no rewrite of any of them.
"""

from __future__ import annotations

_COLUMNS = (
    'transaction_id, user_id, merchant_id, amount, location, device_id, payment_method, '
    '"timestamp", transaction_status'
)
_FEATURES = (
    "transaction_velocity, average_transaction_amount, device_switch_frequency, "
    "location_change_rate, daily_transaction_count"
)
_ROUNDED_FEATURES = _FEATURES.replace(
    "average_transaction_amount",
    "round(average_transaction_amount, 6) AS average_transaction_amount",
)
_CONTEXT = "txn_count_10min, loc_count_1hr, first_seen_device_ts"
_SCORES = "tv_norm, ds_norm, lr_norm, risk_score, risk_level"
_ALERT_COLUMNS = f"{_COLUMNS}, {_ROUNDED_FEATURES}, {_SCORES}, alert_type"

_TX = """
tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id,
         'MRC_' || (k % 20) AS merchant_id, value * 10 AS amount, 'CITY_' || (k % 6) AS location,
         'DEV_' || (k % 4) AS device_id, event_type AS payment_method, ts AS "timestamp",
         CASE event_type WHEN 'error' THEN 'failed' ELSE 'success' END AS transaction_status
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

_BRONZE = _TX + """,
bronze AS (
  SELECT transaction_id, user_id, merchant_id,
         CASE WHEN n % 101 = 0 THEN NULL WHEN n % 103 = 0 THEN -amount / 10
              WHEN n % 107 = 0 THEN 0.0::DOUBLE ELSE amount END AS amount,
         CASE WHEN n % 109 = 0 OR n % 206 = 0 THEN NULL ELSE location END AS location,
         device_id, payment_method,
         CASE WHEN n % 113 = 0 THEN 'not-a-time'
              ELSE strftime("timestamp", '%Y-%m-%d %H:%M:%S') END AS "timestamp",
         transaction_status
  FROM (SELECT *, CAST(transaction_id AS BIGINT) AS n FROM tx
        UNION ALL
        SELECT *, CAST(transaction_id AS BIGINT) AS n FROM tx
        WHERE CAST(transaction_id AS BIGINT) % 50 = 0)
)"""

_UNIQUE = _BRONZE + """,
uniq AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY transaction_id
      ORDER BY user_id DESC NULLS LAST, merchant_id DESC NULLS LAST, amount DESC NULLS LAST,
               location DESC NULLS LAST, device_id DESC NULLS LAST,
               payment_method DESC NULLS LAST, "timestamp" DESC NULLS LAST,
               transaction_status DESC NULLS LAST) AS rn
    FROM bronze)
  WHERE rn = 1
)"""

_CLEAN = _UNIQUE + """,
clean AS (
  SELECT * REPLACE (try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp") FROM uniq
),
valid AS (
  SELECT * FROM clean
  WHERE transaction_id IS NOT NULL AND user_id IS NOT NULL AND merchant_id IS NOT NULL
    AND amount IS NOT NULL AND NOT isnan(amount) AND location IS NOT NULL
    AND device_id IS NOT NULL AND payment_method IS NOT NULL AND "timestamp" IS NOT NULL
    AND transaction_status IS NOT NULL
),
silver AS (SELECT * FROM valid WHERE amount > 0),
quarantine AS (
  (SELECT * FROM clean EXCEPT SELECT * FROM valid)
  UNION ALL
  SELECT * FROM clean WHERE amount <= 0
)"""

_ROUGH = _TX + """,
bronze AS (
  SELECT CASE WHEN n % 37 = 6 THEN NULL WHEN i > 0 THEN n || '-' || i ELSE CAST(n AS VARCHAR) END AS transaction_id,
         CASE WHEN n % 41 = 8 THEN NULL ELSE user_id END AS user_id, 'MRC_' || (n * 7 % 500) AS merchant_id,
         CASE WHEN n % 31 = 5 AND copy = 0 THEN 'nan'::DOUBLE ELSE amount + copy END AS amount,
         'CITY_' || ((n + copy) % 60) AS location,
         CASE WHEN n % 43 = 9 THEN NULL ELSE 'DEV_' || (n % 30) END AS device_id, payment_method,
         strftime("timestamp" + to_seconds(30 * i), '%Y-%m-%d %H:%M:%S') AS "timestamp", transaction_status
  FROM (SELECT *, unnest(generate_series(0, CASE WHEN n % 7 = 3 THEN 1 ELSE 0 END)) AS copy
        FROM (SELECT *, unnest(generate_series(0, CASE WHEN n % 40 = 0 THEN 14 ELSE 0 END)) AS i
              FROM (SELECT *, CAST(transaction_id AS BIGINT) AS n FROM tx)))
)"""
_ROUGH_UNIQUE, _ROUGH_CLEAN = _UNIQUE.replace(_BRONZE, _ROUGH), _CLEAN.replace(_BRONZE, _ROUGH)

_UPLOADED = _TX + """,
uploaded AS (
  SELECT *,
    concat_ws(',', transaction_id, user_id, merchant_id, CAST(CAST(floor(amount) AS BIGINT) AS VARCHAR),
      CASE WHEN n % 83 = 0 THEN '"' || location WHEN n % 79 = 0 THEN '"' || location || ', the ""old"" town"' ELSE location END,
      device_id, payment_method, strftime("timestamp", '%Y-%m-%d %H:%M:%S'))
    || CASE WHEN n % 97 = 0 THEN ',' || transaction_status || ',more'
            WHEN n % 89 = 0 THEN ',' || transaction_status || ',,lost'
            WHEN n % 73 = 0 THEN '' ELSE ',' || transaction_status END AS record,
    n % 97 = 0 OR n % 89 = 0 OR n % 83 = 0 AS malformed
  FROM (SELECT *, CAST(transaction_id AS BIGINT) AS n FROM tx)
)"""


def _features(source: str) -> str:
    """Features and rule context of ``source``."""
    return f"""
timed AS (
  SELECT *, epoch_us("timestamp") // 1000000 AS sec, CAST("timestamp" AS DATE) AS d FROM {source}
),
first_seen AS (
  SELECT user_id, device_id, min("timestamp") AS first_seen_device_ts
  FROM {source} GROUP BY user_id, device_id
),
feats AS (
  SELECT t.*,
    count(transaction_id) OVER hour AS transaction_velocity,
    avg(amount) OVER day AS average_transaction_amount,
    CAST(count(DISTINCT t.device_id) OVER day AS INTEGER) AS device_switch_frequency,
    CAST(count(DISTINCT location) OVER day AS INTEGER) AS location_change_rate,
    count(transaction_id) OVER day AS daily_transaction_count,
    count(transaction_id) OVER burst AS txn_count_10min,
    CAST(count(DISTINCT location) OVER hour AS INTEGER) AS loc_count_1hr,
    first_seen_device_ts
  FROM timed t LEFT JOIN first_seen f ON t.user_id = f.user_id AND t.device_id = f.device_id
  WINDOW
    hour AS (PARTITION BY t.user_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW),
    burst AS (PARTITION BY t.user_id ORDER BY sec RANGE BETWEEN 600 PRECEDING AND CURRENT ROW),
    day AS (PARTITION BY t.user_id, d ORDER BY "timestamp")
)"""


_SCORED = """
bounds AS (
  SELECT min(transaction_velocity) AS min_tv, max(transaction_velocity) AS max_tv,
         min(device_switch_frequency) AS min_ds, max(device_switch_frequency) AS max_ds,
         min(location_change_rate) AS min_lr, max(location_change_rate) AS max_lr
  FROM feats
),
normed AS (
  SELECT f.*,
    (transaction_velocity - min_tv)::DOUBLE / ((max_tv - min_tv)::DOUBLE + 1e-6::DOUBLE) AS tv_norm,
    (device_switch_frequency - min_ds)::DOUBLE / ((max_ds - min_ds)::DOUBLE + 1e-6::DOUBLE) AS ds_norm,
    (location_change_rate - min_lr)::DOUBLE / ((max_lr - min_lr)::DOUBLE + 1e-6::DOUBLE) AS lr_norm
  FROM feats f, bounds
),
scored AS (
  SELECT *, CASE WHEN risk_score < 0.3::DOUBLE THEN 'LOW'
                 WHEN risk_score < 0.7::DOUBLE THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level
  FROM (SELECT *, 0.4::DOUBLE * tv_norm + 0.3::DOUBLE * ds_norm + 0.3::DOUBLE * lr_norm AS risk_score
        FROM normed)
)"""

_RULES = {
    "Risk threshold alert": "risk_level IN ('MEDIUM', 'HIGH')",
    "High transaction velocity (10min)": "txn_count_10min > {burst}",
    "Large transaction from new device": 'amount > 2000 AND "timestamp" = first_seen_device_ts',
    "Multiple locations in 1 hour": "loc_count_1hr > 1",
}


def _rule(name: str, burst: int = 10) -> str:
    return f"SELECT *, '{name}' AS alert_type FROM scored WHERE {_RULES[name].format(burst=burst)}"


def _raised(burst: int = 10) -> str:
    return "alerts AS (\n" + "\nUNION ALL\n".join(_rule(n, burst) for n in _RULES) + "\n)"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_F = _with(_TX, _features("tx"))
_S = _with(_TX, _features("tx"), _SCORED)
_A = _with(_TX, _features("tx"), _SCORED, _raised())
_A1 = _with(_TX, _features("tx"), _SCORED, _raised(burst=1))
_ROUGH_F = _with(_ROUGH_CLEAN, _features("silver"))
_ROUGH_ALERTS = _with(_ROUGH_CLEAN, _features("silver"), _SCORED, _raised())
_SILVER_ALERTS = _with(_CLEAN, _features("silver"), _SCORED, _raised())


def _feature(column: str) -> str:
    return _F + f"SELECT transaction_id, {column} FROM feats"


def _top(source: str, column: str, limit: int | None = None) -> str:
    sql = (
        f"SELECT {column}, count(*) AS count FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY count DESC, {column}"
    )
    return sql if limit is None else f"{sql} LIMIT {limit}"


def _daily(source: str, day: str) -> str:
    return (
        f'SELECT CAST("timestamp" AS DATE) AS {day}, count(transaction_id) AS count FROM {source} '
        f'WHERE "timestamp" IS NOT NULL GROUP BY 1'
    )


def _reason_terms() -> str:
    missing = [
        f"CASE WHEN u.{c.strip()} IS NULL THEN 'missing {c.strip().strip(chr(34))}' END"
        for c in _COLUMNS.split(",")
    ]
    missing.append(
        "CASE WHEN u.\"timestamp\" IS NOT NULL AND c.\"timestamp\" IS NULL THEN 'unreadable timestamp' END"
    )
    missing.append("CASE WHEN u.amount <= 0 THEN 'amount not positive' END")
    return ", ".join(missing)


def all_oracle_sql() -> dict[str, str]:
    scored_ids = _S + "SELECT transaction_id, risk_score, risk_level FROM scored"
    everything = _F + f"SELECT transaction_id, {_ROUNDED_FEATURES}, {_CONTEXT} FROM feats"
    return {
        "parquet_scan": _with(_TX) + f"SELECT {_COLUMNS} FROM tx",
        "bronze_passthrough": _with(_BRONZE) + f"SELECT {_COLUMNS} FROM bronze",
        "preview_500": _with(_TX) + f"SELECT {_COLUMNS} FROM tx ORDER BY transaction_id LIMIT 500",
        "dedup_transactions": _with(_UNIQUE) + f"SELECT {_COLUMNS} FROM uniq",
        "timestamp_normalize": _with(_BRONZE)
        + """SELECT * REPLACE (try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp") FROM bronze""",
        "null_filter": _with(_CLEAN) + f"SELECT {_COLUMNS} FROM valid",
        "positive_amount": _with(_CLEAN) + f"SELECT {_COLUMNS} FROM valid WHERE amount > 0",
        "nonpositive_amount": _with(_CLEAN) + f"SELECT {_COLUMNS} FROM clean WHERE amount <= 0",
        "quarantine_except": _with(_CLEAN)
        + f"SELECT {_COLUMNS} FROM clean EXCEPT SELECT {_COLUMNS} FROM valid",
        "silver": _with(_CLEAN) + f"SELECT {_COLUMNS} FROM silver",
        "quarantine": _with(_CLEAN) + f"SELECT {_COLUMNS} FROM quarantine",
        "quarantine_reasons": _with(_CLEAN)
        + f"SELECT * FROM (SELECT c.*, concat_ws('; ', {_reason_terms()}) AS quarantine_reasons "
        "FROM clean c JOIN uniq u ON c.transaction_id = u.transaction_id) WHERE quarantine_reasons <> ''",
        "dq_counts": _with(_CLEAN)
        + """SELECT (SELECT count(*) FROM bronze) AS bronze_rows,
       (SELECT count(*) FROM clean) AS unique_rows,
       (SELECT count(*) FROM valid) AS complete_rows,
       (SELECT count(*) FROM (SELECT * FROM clean EXCEPT SELECT * FROM valid)) AS incomplete_rows,
       (SELECT count(*) FROM silver) AS silver_rows,
       (SELECT count(*) FROM quarantine) AS quarantine_rows""",
        "quarantine_malformed": _with(_UPLOADED) + "SELECT transaction_id, record FROM uploaded WHERE malformed",
        "upload_roundtrip": _with(_UPLOADED)
        + """SELECT transaction_id, user_id, merchant_id, floor(amount)::DOUBLE AS amount,
       CASE WHEN n % 79 = 0 THEN location || ', the "old" town' ELSE location END AS location,
       device_id, payment_method, date_trunc('second', "timestamp") AS "timestamp", transaction_status
FROM uploaded WHERE NOT malformed AND n % 73 <> 0 AND floor(amount) > 0""",
        "rough_dedup": _with(_ROUGH_UNIQUE) + f"SELECT {_COLUMNS} FROM uniq",
        "rough_silver": _with(_ROUGH_CLEAN) + f"SELECT {_COLUMNS} FROM silver",
        "rough_quarantine": _with(_ROUGH_CLEAN) + f"SELECT {_COLUMNS} FROM quarantine",
        "rough_features": _ROUGH_F + f"SELECT transaction_id, {_ROUNDED_FEATURES}, {_CONTEXT} FROM feats",
        "rough_features_hot_users": _ROUGH_F + f"SELECT transaction_id, {_ROUNDED_FEATURES}, {_CONTEXT} FROM feats",
        "rough_first_seen": _with(_ROUGH_CLEAN)
        + """SELECT c.transaction_id, c.user_id, c.device_id, c."timestamp", f.first_seen_device_ts
FROM clean c LEFT JOIN (SELECT user_id, device_id, min("timestamp") AS first_seen_device_ts FROM clean GROUP BY ALL) f
  ON c.user_id = f.user_id AND c.device_id = f.device_id""",
        "rough_alerts": _ROUGH_ALERTS + f"SELECT {_ALERT_COLUMNS} FROM alerts",
        "rough_alert_types": _ROUGH_ALERTS + _top("alerts", "alert_type"),
        "rough_alerts_by_merchant": _ROUGH_ALERTS + _top("alerts", "merchant_id", 20),
        "rough_alerts_by_location": _ROUGH_ALERTS + _top("alerts", "location", 10),
        "rough_top_devices": _with(_ROUGH_CLEAN) + _top("silver", "device_id", 10),
        "transaction_velocity": _feature("transaction_velocity"),
        "avg_transaction_amount": _feature(
            "round(average_transaction_amount, 6) AS average_transaction_amount"
        ),
        "device_switch_frequency": _feature("device_switch_frequency"),
        "location_change_rate": _feature("location_change_rate"),
        "daily_transaction_count": _feature("daily_transaction_count"),
        "txn_count_10min": _feature("txn_count_10min"),
        "loc_count_1hr": _feature("loc_count_1hr"),
        "first_seen_device_window": _feature("first_seen_device_ts"),
        "fraud_features": _F + f"SELECT {_COLUMNS}, {_ROUNDED_FEATURES} FROM feats",
        "rule_context": _F + f"SELECT transaction_id, {_CONTEXT} FROM feats",
        "fraud_features_hot_users": everything,
        "fraud_features_mixed": everything,
        "first_seen_lookup": _F + "SELECT * FROM first_seen",
        "first_seen_device": _F
        + 'SELECT transaction_id, user_id, device_id, "timestamp", first_seen_device_ts FROM feats',
        "first_seen_two_batches": _F
        + 'SELECT transaction_id, user_id, device_id, "timestamp", first_seen_device_ts FROM feats',
        "feature_days_rerun": everything,
        "day_slice": _with(_TX)
        + f"""SELECT {_COLUMNS} FROM tx WHERE "timestamp" >= '2024-01-10' AND "timestamp" < '2024-01-12'""",
        "stream_silver": _with(_CLEAN) + f"SELECT {_COLUMNS} FROM silver",
        "stream_quarantine": _with(_CLEAN) + f"SELECT {_COLUMNS} FROM quarantine",
        "stream_velocity": _with(_TX)
        + """SELECT user_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS txn_count
FROM (SELECT user_id, unnest(generate_series(
        time_bucket(INTERVAL 10 MINUTE, "timestamp") - INTERVAL 50 MINUTE,
        time_bucket(INTERVAL 10 MINUTE, "timestamp"), INTERVAL 10 MINUTE)) AS window_start FROM tx)
GROUP BY user_id, window_start""",
        "stream_transaction_velocity": _feature("transaction_velocity"),
        "feature_min_max": _S + "SELECT * FROM bounds",
        "normalized_features": _S + "SELECT transaction_id, tv_norm, ds_norm, lr_norm FROM normed",
        "risk_score": _S + "SELECT transaction_id, risk_score FROM scored",
        "risk_level": scored_ids,
        "risk_score_self_bounded": scored_ids,
        "alerts_base": _S + f"SELECT {_ALERT_COLUMNS} FROM ({_rule('Risk threshold alert')})",
        "rule_velocity": _S
        + f"SELECT {_ALERT_COLUMNS} FROM ({_rule('High transaction velocity (10min)', 1)})",
        "rule_new_device": _S
        + f"SELECT {_ALERT_COLUMNS} FROM ({_rule('Large transaction from new device')})",
        "rule_multi_location": _S
        + f"SELECT {_ALERT_COLUMNS} FROM ({_rule('Multiple locations in 1 hour')})",
        "alerts": _A1 + f"SELECT {_ALERT_COLUMNS} FROM alerts",
        "alerts_dedup": _A1
        + f"SELECT DISTINCT ON (transaction_id, alert_type) {_ALERT_COLUMNS} "
        "FROM (SELECT * FROM alerts UNION ALL SELECT * FROM alerts)",
        "flagship": _A + f"SELECT {_ALERT_COLUMNS} FROM alerts",
        "bronze_to_alerts": _SILVER_ALERTS + f"SELECT {_ALERT_COLUMNS} FROM alerts",
        "kpis": _A
        + """SELECT p AS transactions_processed, a AS fraud_alerts,
       round_even(CASE WHEN p > 0 THEN a::DOUBLE / p ELSE 0.0 END, 4) AS fraud_rate,
       round_even(CASE WHEN p > 0 THEN u::DOUBLE / p ELSE 0.0 END, 4) AS fraud_rate_distinct
FROM (SELECT (SELECT count(*) FROM feats) AS p, (SELECT count(*) FROM alerts) AS a,
             (SELECT count(DISTINCT transaction_id) FROM alerts) AS u)""",
        "avg_risk_score": _A + "SELECT round(avg(risk_score), 6) AS avg_risk_score FROM alerts",
        "risk_distribution": _A + _top("alerts", "risk_level"),
        "alerts_by_location": _A + _top("alerts", "location", 10),
        "alerts_by_location_top20": _A + _top("alerts", "location", 20),
        "alerts_by_merchant": _A + _top("alerts", "merchant_id", 20),
        "alert_type_breakdown": _A + _top("alerts", "alert_type"),
        "fraud_trend": _A + _daily("alerts", "alert_date"),
        "alerts_table": _A
        + """SELECT transaction_id, user_id, merchant_id, amount, location, device_id, risk_score,
       risk_level, CASE risk_level WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END AS severity_rank
FROM alerts ORDER BY risk_score DESC, transaction_id, alert_type""",
        "payment_method_distribution": _with(_TX) + _top("tx", "payment_method"),
        "amount_histogram": _with(_TX)
        + """SELECT CAST(least(floor(share * 30), 29) AS INTEGER) AS bin, count(*) AS count
FROM (SELECT CASE WHEN high > low THEN (amount - low) / (high - low) ELSE 0.0 END AS share
      FROM tx, (SELECT min(amount) AS low, max(amount) AS high FROM tx))
GROUP BY 1""",
        "daily_volume": _with(_TX) + _daily("tx", "date"),
        "top_users": _with(_TX) + _top("tx", "user_id", 10),
        "top_devices": _with(_TX) + _top("tx", "device_id", 10),
        "run_metrics": _SILVER_ALERTS
        + """SELECT p AS total_transactions_processed, a AS fraud_alert_count,
       CASE WHEN p > 0 THEN a::DOUBLE / p ELSE 0.0 END AS fraud_rate,
       q AS invalid_records, 12.34::DOUBLE AS pipeline_runtime_seconds
FROM (SELECT (SELECT count(*) FROM silver) AS p, (SELECT count(*) FROM alerts) AS a,
             (SELECT count(*) FROM quarantine) AS q)""",
        "pipeline_metrics": _SILVER_ALERTS
        + """SELECT p AS total_transactions_processed, a AS fraud_alert_count,
       CASE WHEN p > 0 THEN a::DOUBLE / p ELSE 0.0 END AS fraud_rate,
       q AS invalid_records, 12.34::DOUBLE AS pipeline_runtime_seconds
FROM (SELECT (SELECT count(*) FROM silver) AS p, (SELECT count(*) FROM alerts) AS a,
             (SELECT count(*) FROM quarantine) AS q)""",
    }
