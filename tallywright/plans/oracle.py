"""SQL for the same results as the registered queries, run on another engine."""

from __future__ import annotations

RAW = """
raw AS (
  SELECT event_id AS transaction_id, user_id AS customer_id, ts AS "timestamp",
         CASE WHEN event_id % 97 = 0 THEN -99.0::DOUBLE ELSE round(value * 10, 2) END AS amount,
         event_type AS merchant_category,
         (['Visa', 'Mastercard', 'Amex'])[event_id % 3 + 1] AS card_type,
         (['US', 'CA', 'GB', 'IN', 'DE'])[user_id % 5 + 1] AS country
  FROM events)"""

VALID = f"{RAW}, valid AS (SELECT * FROM raw WHERE amount > 0)"

PROFILED = f"""{VALID},
profiled AS (
  SELECT *, avg(amount) OVER (PARTITION BY customer_id) AS cust_avg_amount,
         stddev_samp(amount) OVER (PARTITION BY customer_id) AS cust_std_amount
  FROM valid)"""

FLAGGED = f"""{PROFILED},
reasoned AS (
  SELECT *, CASE
      WHEN amount > cust_avg_amount * 3 THEN 'outlier'
      WHEN amount > 1000 AND strftime("timestamp", '%H') BETWEEN '00' AND '05' THEN 'night'
      WHEN merchant_category = 'purchase' AND amount > 500 THEN 'category' END AS fraud_reason
  FROM profiled),
flagged AS (SELECT *, fraud_reason IS NOT NULL AS is_fraudulent FROM reasoned)"""

ROLLING = f"""{VALID},
rolling AS (
  SELECT *, count(*) OVER w AS rolling_count,
         CAST(sum(CAST(amount AS DECIMAL(18, 6))) OVER w AS DOUBLE) AS rolling_amount
  FROM valid
  WINDOW w AS (PARTITION BY customer_id ORDER BY "timestamp"
               RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW))"""


def _synthetic(batch_id: str = "batch-1") -> str:
    draw = "('0x' || substr(sha256({key}), 1, 8))::BIGINT"
    risk_draw = draw.format(key="'risk' || id::VARCHAR")
    return f"""
ids AS (SELECT event_id AS id, user_id, value FROM events),
parts AS (
  SELECT id, value, 'TX' || lpad(id::VARCHAR, 12, '0') AS transaction_id,
         'ACCT' || lpad((id % 25000)::VARCHAR, 8, '0') AS account_id,
         'CUST' || lpad(user_id::VARCHAR, 7, '0') AS customer_id,
         (DATE '2026-07-01' + (id % 31)::INTEGER) AS event_date,
         (['grocery', 'fuel', 'travel', 'online_services', 'electronics',
           'cash_withdrawal', 'gaming', 'utilities'])[id % 8 + 1] AS merchant_category
  FROM ids),
synthetic AS (
  SELECT transaction_id, account_id, customer_id,
         event_date::TIMESTAMP + to_seconds(id % 86400) AS event_ts, event_date,
         CAST(value AS DECIMAL(12, 2)) AS amount,
         'USD' AS currency, merchant_category,
         (['US', 'IN', 'GB', 'DE', 'SG'])[id % 5 + 1] AS country,
         (['pos', 'mobile', 'web', 'atm'])[id % 4 + 1] AS channel,
         id % 3 <> 0 AS is_card_present,
         round(CASE WHEN merchant_category IN ('gaming', 'cash_withdrawal')
                    THEN 0.42::DOUBLE ELSE 0.12::DOUBLE END
               + ({risk_draw} % 3501)::DOUBLE / 10000, 4) AS risk_score,
         '{batch_id}' AS ingestion_batch_id,
         sha256(transaction_id || customer_id) AS payload_hash,
         TIMESTAMP '2026-08-01 00:00:00' AS created_at, event_date AS processing_date
  FROM parts)"""


SYNTHETIC = _synthetic()
SYNTHETIC_ROWS = f"""
WITH {SYNTHETIC} SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM synthetic"""

MONTHLY = """
prices AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_orderpriority AS sector,
         round(sum(o_totalprice), 2) AS close
  FROM orders GROUP BY 1, 2),
returns AS (
  SELECT *, close / nullif(lag(close) OVER (PARTITION BY sector ORDER BY period), 0) - 1
            AS period_return FROM prices),
volatile AS (
  SELECT *, stddev_samp(period_return) OVER (
      PARTITION BY sector ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS volatility
  FROM returns)"""

DAILY = """
closes AS (
  SELECT CAST(ts AS DATE) AS period, event_type AS symbol,
         arg_max(value, (ts, event_id)) AS close
  FROM events GROUP BY 1, 2),
returns AS (
  SELECT *, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY period), 0) - 1
            AS period_return FROM closes)"""


def _windows(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events,
         round(sum(value), 2) AS total
  FROM {source} GROUP BY 1, 2)"""


def _bursts(condition: str = "TRUE") -> str:
    return f"""
WITH marked AS (
  SELECT *, coalesce(ts > lag(ts) OVER w + INTERVAL 2 HOUR, TRUE) AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (
  SELECT *, sum(opens::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                  ROWS UNBOUNDED PRECEDING) AS burst FROM marked),
found AS (
  SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", count(*) AS events,
         round(sum(value), 2) AS total FROM numbered GROUP BY user_id, burst)
SELECT * FROM found WHERE {condition}"""


def _walked(source: str, key: str, x: str) -> str:
    return f"""
walked AS (
  SELECT period, {key}, close,
         CASE WHEN count(close) OVER w > 1
              THEN regr_intercept(close, {x}) OVER w + regr_slope(close, {x}) OVER w * {x} END AS forecast
  FROM {source}
  WINDOW w AS (PARTITION BY {key} ORDER BY period
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def _expectation(name: str, table: str, failed: str) -> str:
    return f"""
SELECT '{name}' AS expectation, count(*) AS checked_rows,
       count(*) FILTER (WHERE {failed}) AS failed_rows,
       count(*) FILTER (WHERE {failed}) = 0 AS success FROM {table}"""


def _unique(name: str, table: str, keys: str) -> str:
    return f"""
SELECT '{name}' AS expectation, CAST(sum(n) AS BIGINT) AS checked_rows,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS failed_rows,
       count(*) FILTER (WHERE n > 1) = 0 AS success
FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})"""


ORACLE: dict[str, str] = {
    "load_transactions": f"WITH {RAW} SELECT * FROM raw",
    "load_text_feed": f"WITH {RAW} SELECT * FROM raw",
    "dq_valid": f"WITH {VALID} SELECT * FROM valid",
    "dq_rejected": f"WITH {RAW} SELECT * FROM raw WHERE amount <= 0",
    "dq_unclassified": f"""
WITH {RAW} SELECT * REPLACE (CAST(NULL AS DOUBLE) AS amount) FROM raw
WHERE merchant_category = 'error'""",
    "dq_summary": f"""
WITH {RAW}
SELECT count(*) AS input_rows, count(*) FILTER (WHERE amount > 0) AS accepted_rows,
       count(*) FILTER (WHERE amount <= 0) AS rejected_rows,
       count(*) FILTER (WHERE amount IS NULL) AS unclassified_rows,
       count(*) FILTER (WHERE isnan(amount)) AS nan_rows
FROM raw""",
    "dq_balances": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal <= 0",
    "customer_profile": f"""
WITH {PROFILED}
SELECT transaction_id, customer_id, amount, round(cust_avg_amount, 8) AS cust_avg_amount,
       round(cust_std_amount, 4) AS cust_std_amount FROM profiled""",
    "customer_profile_past": f"""
WITH {VALID}
SELECT transaction_id, customer_id, amount,
       round(avg(amount) OVER (PARTITION BY customer_id ORDER BY "timestamp", transaction_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 8) AS past_avg_amount
FROM valid""",
    "customer_zscore": f"""
WITH {PROFILED}
SELECT transaction_id, customer_id, amount,
       round((amount - cust_avg_amount) / nullif(cust_std_amount, 0), 4) + 0.0::DOUBLE AS amount_zscore
FROM profiled""",
    "fraud_flags": f"""
WITH {FLAGGED}
SELECT transaction_id, customer_id, "timestamp", amount, merchant_category, is_fraudulent,
       fraud_reason FROM flagged""",
    "fraud_scored": f"""
WITH {FLAGGED}
SELECT * REPLACE (round(cust_avg_amount, 8) AS cust_avg_amount,
                  round(cust_std_amount, 4) AS cust_std_amount),
       lag(amount, 1) OVER w AS prev_amount_1, lag(amount, 2) OVER w AS prev_amount_2
FROM flagged WINDOW w AS (PARTITION BY customer_id ORDER BY "timestamp", transaction_id)""",
    "fraud_summary": f"""
WITH {FLAGGED}
SELECT is_fraudulent, count(transaction_id) AS tx_count, round(sum(amount), 2) AS total_volume
FROM flagged GROUP BY is_fraudulent""",
    "fraud_by_category": f"""
WITH {FLAGGED}
SELECT merchant_category, count(transaction_id) AS fraud_count,
       round(sum(amount), 2) AS fraud_volume
FROM flagged WHERE is_fraudulent GROUP BY merchant_category
ORDER BY fraud_volume DESC, merchant_category""",
    "fraud_by_card": f"""
WITH {FLAGGED}
SELECT card_type, count(transaction_id) AS total_tx,
       count(*) FILTER (WHERE is_fraudulent) AS fraud_tx_count,
       round(count(*) FILTER (WHERE is_fraudulent) / count(transaction_id) * 100, 2)
         AS fraud_percentage
FROM flagged GROUP BY card_type ORDER BY fraud_percentage DESC, card_type""",
    "fraud_samples": f"""
WITH {FLAGGED}
SELECT transaction_id, customer_id, "timestamp", amount, merchant_category, card_type
FROM flagged WHERE is_fraudulent ORDER BY transaction_id LIMIT 10""",
    "fraud_job": f"""
WITH {FLAGGED},
gate AS (
  SELECT count(*) AS input_rows, count(*) FILTER (WHERE amount > 0) AS accepted_rows,
         count(*) FILTER (WHERE amount <= 0) AS rejected_rows,
         count(*) FILTER (WHERE amount IS NULL) AS unclassified_rows,
         count(*) FILTER (WHERE isnan(amount)) AS nan_rows FROM raw)
SELECT 'gate' AS report, item, transactions, CAST(NULL AS DOUBLE) AS measure
FROM (UNPIVOT gate ON COLUMNS(*) INTO NAME item VALUE transactions)
UNION ALL
SELECT 'summary', CAST(is_fraudulent AS VARCHAR), count(transaction_id), round(sum(amount), 2)
FROM flagged GROUP BY is_fraudulent
UNION ALL
SELECT 'category', merchant_category, count(transaction_id), round(sum(amount), 2)
FROM flagged WHERE is_fraudulent GROUP BY merchant_category
UNION ALL
SELECT 'card', card_type, count(*) FILTER (WHERE is_fraudulent),
       round(count(*) FILTER (WHERE is_fraudulent) / count(transaction_id) * 100, 2)
FROM flagged GROUP BY card_type""",
    "category_share": f"""
WITH {VALID}
SELECT merchant_category, count(transaction_id) AS tx_count, round(sum(amount), 2) AS volume,
       round(count(transaction_id) / sum(count(transaction_id)) OVER () * 100, 4) AS tx_share,
       round(sum(amount) / sum(sum(amount)) OVER () * 100, 4) AS volume_share
FROM valid GROUP BY merchant_category ORDER BY volume DESC, merchant_category""",
    "velocity_lag": f"""
WITH {VALID}
SELECT transaction_id, customer_id, amount,
       lag(amount, 1) OVER w AS prev_amount_1, lag(amount, 2) OVER w AS prev_amount_2
FROM valid WINDOW w AS (PARTITION BY customer_id ORDER BY "timestamp", transaction_id)""",
    "velocity_rolling": f"""
WITH {ROLLING}
SELECT transaction_id, customer_id, amount, rolling_count, rolling_amount FROM rolling""",
    "velocity_flags": f"""
WITH {ROLLING}
SELECT transaction_id, customer_id, rolling_count, rolling_count >= 3 AS is_high_velocity
FROM rolling""",
    "stream_velocity": f"""
WITH {ROLLING}
SELECT transaction_id, customer_id, rolling_count, rolling_count >= 3 AS is_high_velocity
FROM rolling""",
    "synth_transactions": SYNTHETIC_ROWS,
    "synth_risk": f"""
WITH {SYNTHETIC}
SELECT merchant_category, channel, count(*) AS records,
       count(*) FILTER (WHERE is_card_present) AS card_present,
       min(risk_score) AS min_risk, max(risk_score) AS max_risk,
       round(avg(risk_score), 4) AS avg_risk
FROM synthetic GROUP BY merchant_category, channel""",
    "bronze_write": f"""
WITH {SYNTHETIC}
SELECT processing_date, count(*) AS records, CAST(sum(amount) AS DOUBLE) AS amount,
       min(transaction_id) AS first_id, max(transaction_id) AS last_id
FROM synthetic GROUP BY processing_date""",
    "bronze_readback": SYNTHETIC_ROWS,
    "bronze_overwrite": f"""
WITH {SYNTHETIC}
SELECT processing_date,
       CASE WHEN processing_date >= DATE '2026-07-20' THEN 'batch-2' ELSE 'batch-1' END
         AS ingestion_batch_id, count(*) AS records, CAST(sum(amount) AS DOUBLE) AS amount
FROM synthetic GROUP BY 1, 2""",
    "cube_incremental": f"""
WITH {SYNTHETIC}
SELECT merchant_category, channel, count(*) AS records,
       CAST(sum(CASE WHEN processing_date >= DATE '2026-07-20' THEN amount * 2 ELSE amount END) AS DOUBLE)
         AS volume
FROM synthetic GROUP BY merchant_category, channel""",
    "category_counts": f"""
WITH {SYNTHETIC}
SELECT merchant_category, count(*) AS records FROM synthetic GROUP BY merchant_category
ORDER BY records DESC, merchant_category LIMIT 20""",
    "silver_clean": """
WITH cleaned AS (
  SELECT * REPLACE (upper(trim(l_returnflag)) AS l_returnflag,
                    upper(trim(l_linestatus)) AS l_linestatus,
                    CAST(l_shipdate AS DATE) AS l_shipdate)
  FROM lineitem
  WHERE l_quantity > 0 AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)
SELECT * FROM cleaned
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
           l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
           l_discount DESC NULLS LAST, l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST,
           l_linestatus DESC NULLS LAST) = 1""",
    "daily_ohlc": """
SELECT CAST(ts AS DATE) AS period, event_type AS symbol,
       arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, (ts, event_id)) AS close, round(sum(value), 2) AS volume,
       count(*) AS ticks
FROM events GROUP BY 1, 2""",
    "daily_returns": f"""
WITH {DAILY}
SELECT period, symbol, close, round(period_return, 6) AS period_return FROM returns""",
    "daily_volatility": f"""
WITH {DAILY}
SELECT period, symbol, close, round(period_return, 6) AS period_return,
       round(stddev_samp(period_return) OVER (
         PARTITION BY symbol ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6)
         AS volatility FROM returns""",
    "daily_trend": f"""
WITH {DAILY},
points AS (SELECT *, (period - DATE '1970-01-01')::DOUBLE AS x FROM closes),
fits AS (
  SELECT symbol, count(close) AS periods, regr_slope(close, x) AS slope,
         regr_intercept(close, x) AS intercept, max(x) + 1 AS next_x,
         max(period) + 1 AS next_period
  FROM points GROUP BY symbol)
SELECT symbol, periods, round(slope, 2) AS slope, round(intercept, 2) AS intercept, next_period,
       round(slope * next_x + intercept, 2) AS forecast FROM fits""",
    "monthly_returns": f"""
WITH {MONTHLY}
SELECT period, sector, close, round(period_return, 6) AS period_return FROM returns""",
    "silver_refused": """
SELECT event_id, value, CASE WHEN event_type = 'error' THEN 'key' ELSE 'invalid' END AS reason
FROM events WHERE event_type = 'error' OR NOT coalesce(value > 10, FALSE)""",
    "volatility": f"""
WITH {MONTHLY}
SELECT period, sector, close, round(period_return, 6) AS period_return,
       round(volatility, 6) AS volatility FROM volatile""",
    "gold_volatility": f"""
WITH {MONTHLY}
SELECT period, sector, close, round(period_return, 6) AS period_return,
       round(volatility, 6) AS volatility FROM volatile""",
    "asof_snapshot": """
SELECT * FROM events
WHERE ts <= TIMESTAMP '2024-01-15 00:00:00'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "dq_suite": " UNION ALL ".join(
        [
            _expectation("not_null(c_custkey)", "customer", "c_custkey IS NULL"),
            _expectation(
                "in_range(c_acctbal)", "customer", "NOT c_acctbal BETWEEN 0.0 AND 10000.0"
            ),
            _unique("unique(c_custkey)", "customer", "c_custkey"),
            _expectation("not_null(o_custkey)", "orders", "o_custkey IS NULL"),
            _expectation("in_set(o_orderstatus)", "orders", "o_orderstatus NOT IN ('O', 'F')"),
            _unique("unique(o_orderkey)", "orders", "o_orderkey"),
            _expectation(
                "in_range(l_discount)",
                "lineitem",
                "NOT l_discount BETWEEN 0.0::DOUBLE AND 0.1::DOUBLE",
            ),
            _unique("unique(l_orderkey,l_linenumber)", "lineitem", "l_orderkey, l_linenumber"),
        ]
    ),
    "drift_sketches": """
SELECT CAST(ts AS DATE) AS date, count(*) AS rows, count(DISTINCT user_id) AS different,
       TRUE AS different_within, TRUE AS median_within FROM events GROUP BY 1""",
    "trend_forecast": f"""
WITH {MONTHLY},
points AS (
  SELECT sector, period, close,
         ((year(period) - 1970) * 12 + month(period) - 1)::DOUBLE AS x FROM prices),
fits AS (
  SELECT sector, count(close) AS periods, regr_slope(close, x) AS slope,
         regr_intercept(close, x) AS intercept, max(x) + 1 AS next_x,
         CAST(max(period) + INTERVAL 1 MONTH AS DATE) AS next_period
  FROM points GROUP BY sector)
SELECT sector, periods, round(slope, 2) AS slope, round(intercept, 2) AS intercept, next_period,
       round(slope * next_x + intercept, 2) AS forecast FROM fits""",
    "stream_windows": f"WITH {_windows('counted', 'events')} SELECT * FROM counted",
    "stream_ingest": f"""
WITH {VALID} SELECT *, CAST("timestamp" AS DATE) AS processing_date FROM valid""",
    "stream_bronze": f"""
WITH {SYNTHETIC}
SELECT * EXCLUDE (ingestion_batch_id) REPLACE (CAST(amount AS DOUBLE) AS amount) FROM synthetic""",
    "reconcile_bronze": "SELECT 'equal' AS status, count(*) AS keys FROM events",
    "reconcile_windows": f"""
WITH {_windows('counted', 'events')} SELECT 'equal' AS status, count(*) AS keys FROM counted""",
    "reconcile_gate": f"""
WITH kept AS (SELECT * FROM events WHERE event_id % 97 <> 0 AND value > 0),
{_windows('b', 'events')}, {_windows('s', 'kept')}
SELECT b.window_start, b.event_type, b.events AS batch_events, s.events AS stream_events,
       b.total AS batch_total, s.total AS stream_total,
       CASE WHEN s.events IS NULL THEN 'only_batch' ELSE 'different' END AS status
FROM b LEFT JOIN s ON b.window_start = s.window_start AND b.event_type = s.event_type
WHERE b.events IS DISTINCT FROM s.events OR b.total IS DISTINCT FROM s.total""",
    "reconcile_rows": f"""
WITH {RAW} SELECT *, 'only_stream' AS side, 1::BIGINT AS copies FROM raw WHERE amount <= 0""",
    "reconcile_digest": f"""
WITH {RAW} SELECT *, 'only_stream' AS side, 1::BIGINT AS copies FROM raw WHERE amount <= 0""",
    "robust_outliers": f"""
WITH {VALID},
centred AS (SELECT *, median(amount) OVER (PARTITION BY customer_id) AS median FROM valid),
spread AS (
  SELECT *, median(abs(amount - median)) OVER (PARTITION BY customer_id) AS deviation FROM centred),
scored AS (
  SELECT *, (amount - median) / nullif(1.4826::DOUBLE * deviation, 0) AS robust_score FROM spread)
SELECT transaction_id, customer_id, amount, round(median, 6) AS median,
       round(deviation, 6) AS deviation, round(robust_score, 6) AS robust_score,
       coalesce(abs(robust_score) > 3.5, FALSE) AS is_robust_outlier FROM scored""",
    "customer_bursts": _bursts(),
    "stream_bursts": _bursts(
        "\"end\" <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM events)"
    ),
    "silver_incremental": """
WITH cleaned AS (
  SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem
  WHERE l_quantity > 0 AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL),
newest AS (
  SELECT * FROM cleaned
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
             l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
             l_discount DESC NULLS LAST, l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST,
             l_linestatus DESC NULLS LAST) = 1)
SELECT * FROM newest WHERE l_returnflag IS DISTINCT FROM 'R'""",
    "purchase_quotes": """
WITH clicks AS (
  SELECT user_id, ts AS click_ts, event_id AS click_id, value AS click_value FROM events
  WHERE event_type = 'click'
  QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
SELECT p.event_id, p.user_id, p.ts, p.value, c.click_id, c.click_ts, c.click_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN clicks c ON p.user_id = c.user_id AND p.ts >= c.click_ts""",
    "ewma_volatility": f"""
WITH RECURSIVE {DAILY},
steps AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY period) AS n FROM returns),
walk AS (
  SELECT *, period_return * period_return AS variance FROM steps WHERE n = 1
  UNION ALL
  SELECT s.*, CASE WHEN s.period_return IS NULL THEN w.variance
                   WHEN w.variance IS NULL THEN s.period_return * s.period_return
                   ELSE 0.94::DOUBLE * w.variance + (1 - 0.94::DOUBLE) * s.period_return * s.period_return END
  FROM walk w JOIN steps s ON s.symbol = w.symbol AND s.n = w.n + 1)
SELECT period, symbol, close, round(period_return, 6) AS period_return,
       round(sqrt(variance), 6) AS ewma_volatility FROM walk""",
    "walk_forward": f"""
WITH {MONTHLY},
points AS (SELECT *, ((year(period) - 1970) * 12 + month(period) - 1)::DOUBLE AS x FROM prices),
{_walked('points', 'sector', 'x')}
SELECT period, sector, close, round(forecast / nullif(close, 0), 6) AS forecast,
       round((close - forecast) / nullif(close, 0), 6) AS error FROM walked""",
    "forecast_errors": f"""
WITH {DAILY},
points AS (SELECT *, (period - DATE '1970-01-01')::DOUBLE AS x FROM closes),
{_walked('points', 'symbol', 'x')},
errors AS (SELECT symbol, close - forecast AS error FROM walked WHERE close - forecast IS NOT NULL)
SELECT symbol, count(*) AS forecasts, round(avg(error), 4) AS bias,
       round(avg(abs(error)), 4) AS mean_absolute,
       round(sqrt(avg(error * error)), 4) AS root_mean_square FROM errors GROUP BY symbol""",
    "stream_once": f"""
WITH {SYNTHETIC}
SELECT * EXCLUDE (ingestion_batch_id) REPLACE (CAST(amount AS DOUBLE) AS amount) FROM synthetic""",
}
