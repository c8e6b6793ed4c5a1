"""Shared WITH clauses: the fleet tables over the data folder's tables.

Published digits are rounded half up on the decimal value, as Spark's ROUND does; DuckDB rounds a
double in binary, where 260.335 is below the tie, so the oracle rounds a DECIMAL.
"""

READINGS = """readings AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS gpu_id, ts AS "timestamp",
         65 + value % 40 AS temp_celsius, value % 100 AS utilization_pct,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) % 80 AS memory_used_gb,
         200 + value / 2 AS power_watts,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS error_count, event_type
  FROM events)"""

TELEMETRY = """telemetry AS (
  SELECT e.event_id, CAST(user_id AS VARCHAR) AS gpu_id, CAST(c_nationkey AS VARCHAR) AS cluster_id,
         c_mktsegment AS gpu_type, ts AS "timestamp",
         65 + value % 40 AS temp_celsius, value % 100 AS utilization_pct,
         200 + value / 2 AS power_watts,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS error_count
  FROM events e JOIN customer c ON c.c_custkey = e.user_id)"""

CLUSTERS = """clusters AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS cluster_id, n_name AS cluster_name, r_name AS cloud_provider
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

INVENTORY = """inventory AS (
  SELECT c_custkey AS cluster_id, c_name AS cluster_name, r_name AS cloud_provider, n_name AS region,
         c_mktsegment AS gpu_type,
         CAST(CASE c_custkey % 4 WHEN 0 THEN 8 WHEN 1 THEN 16 WHEN 2 THEN 32 ELSE 64 END AS INTEGER) AS gpu_count,
         CASE WHEN c_acctbal < 0 THEN 'maintenance' ELSE 'active' END AS status
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

EVENTS = """health AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS gpu_id, CAST(c_nationkey AS VARCHAR) AS cluster_id, event_type,
         CASE event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'error'
              WHEN 'signup' THEN 'warning' ELSE 'info' END AS severity,
         CASE event_type
           WHEN 'error' THEN 'Uncorrectable ECC memory error on bank ' || k % 8 || ', page retired'
           WHEN 'purchase' THEN 'Thermal throttle engaged. Fan ' || k % 8 || ' below target speed'
           WHEN 'signup' THEN 'Network link flapping on port ' || k % 8
           WHEN 'click' THEN 'Driver crash in kernel module. Exit code ' || k
           ELSE 'Power supply failure reported by module ' || k % 8 END AS description,
         ts AS "timestamp"
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
  JOIN customer ON c_custkey = user_id)"""

JOBS = """jobs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CAST(o_custkey AS VARCHAR) AS cluster_id, o_orderpriority AS framework,
         'm' || o_custkey % 7 AS model_type,
         'Fine-tuning a ' || (o_custkey % 70 + 1) || 'B m' || o_custkey % 7 || ' model with ' || o_orderpriority
           || ' on dataset set-' || o_orderkey % 12 || ' for '
           || CASE o_orderkey % 3 WHEN 0 THEN 'classification' WHEN 1 THEN 'ranking' ELSE 'generation' END AS description,
         o_orderdate AS start_time,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_hours(CAST(o_orderkey % 72 + 1 AS INTEGER)) END AS end_time,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
         o_totalprice AS cost_usd,
         coalesce((SELECT sum(l_quantity) FROM lineitem WHERE l_orderkey = o_orderkey), 0) AS gpu_hours
  FROM orders)"""

LABELS = """labelled AS (
  SELECT CAST(user_id AS VARCHAR) AS gpu_id, ts AS window_start, CASE WHEN value > 150 THEN 1 ELSE 0 END AS is_anomaly
  FROM events WHERE event_type = 'signup')"""

HOUR_LABELS = """hour_labels AS (
  SELECT CAST(user_id AS VARCHAR) AS gpu_id, date_trunc('hour', ts) AS window_start,
         max(CASE WHEN value > 150 THEN 1 ELSE 0 END) AS is_anomaly
  FROM events WHERE event_type = 'signup' GROUP BY 1, 2)"""

TRAINING = """training AS (
  SELECT l.gpu_id, l.window_start, l.is_anomaly, count(t."timestamp") AS reading_count,
         avg(temp_celsius) AS avg_temp_celsius, max(temp_celsius) AS max_temp_celsius,
         min(temp_celsius) AS min_temp_celsius, stddev_samp(temp_celsius) AS std_temp_celsius,
         avg(utilization_pct) AS avg_utilization_pct, max(utilization_pct) AS max_utilization_pct,
         avg(memory_used_gb) AS avg_memory_used_gb, max(memory_used_gb) AS max_memory_used_gb,
         avg(power_watts) AS avg_power_watts, max(power_watts) AS max_power_watts,
         CAST(sum(error_count) AS BIGINT) AS total_error_count, max(error_count) AS max_error_count
  FROM labelled l LEFT JOIN (SELECT * FROM readings WHERE event_type <> 'signup') t
    ON t.gpu_id = l.gpu_id AND t."timestamp" >= l.window_start AND t."timestamp" < l.window_start + INTERVAL 1 HOUR
  GROUP BY ALL)"""


def hourly(name: str = "hourly", where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT gpu_id, date_trunc('hour', "timestamp") AS window_start,
         avg(temp_celsius) AS avg_temp, max(temp_celsius) AS max_temp, min(temp_celsius) AS min_temp,
         avg(utilization_pct) AS avg_utilization, avg(memory_used_gb / 80.0::DOUBLE * 100) AS avg_memory_pct,
         avg(power_watts) AS avg_power, CAST(sum(error_count) AS BIGINT) AS error_count_1h,
         stddev_samp(temp_celsius) AS temp_stddev, var_samp(temp_celsius) AS temp_variance,
         count(*) FILTER (temp_celsius > 80) / count(temp_celsius)::DOUBLE AS high_temp_pct,
         max(temp_celsius) - min(temp_celsius) AS temp_range
  FROM readings WHERE {where} GROUP BY 1, 2)"""


HOURLY_COLUMNS = [
    "avg_temp", "max_temp", "min_temp", "avg_utilization", "avg_memory_pct", "avg_power",
    "error_count_1h", "temp_stddev", "temp_variance", "high_temp_pct", "temp_range",
]

PREDICTIONS = """predictions AS (
  SELECT ts AS prediction_timestamp, CAST(c_nationkey AS VARCHAR) AS cluster_id, c_mktsegment AS gpu_type,
         65 + value % 40 AS avg_temp, value % 100 AS avg_utilization,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS prediction, value / 500 AS score
  FROM events JOIN customer ON c_custkey = user_id)"""

WIDE = """wide AS (
  SELECT event_id, ts AS "timestamp", CAST(user_id AS VARCHAR) AS gpu_id, CAST(c_nationkey AS VARCHAR) AS cluster_id,
         c_mktsegment AS gpu_model, 65 + value % 40 AS temperature_celsius, value % 100 AS gpu_utilization_pct,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) % 80 / 80 * 100 AS memory_utilization_pct,
         200 + value / 2 AS power_draw_watts, 40 + value % 60 AS fan_speed_pct,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS ecc1,
         CASE WHEN event_type = 'error' AND value > 150 THEN 1 ELSE 0 END AS ecc2,
         20 + value % 5 AS pcie_throughput_gbps
  FROM events JOIN customer ON c_custkey = user_id)"""

STATISTICS = """count(*) AS reading_count,
         CAST(round(CAST(round(avg(temperature_celsius), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_temperature,
         CAST(round(CAST(round(max(temperature_celsius), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS max_temperature,
         CAST(round(CAST(round(stddev_samp(temperature_celsius), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS stddev_temperature,
         CAST(round(CAST(round(avg(gpu_utilization_pct), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_utilization,
         CAST(round(CAST(round(max(gpu_utilization_pct), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS max_utilization,
         CAST(round(CAST(round(avg(memory_utilization_pct), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_memory_utilization,
         CAST(round(CAST(round(avg(power_draw_watts), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_power_draw,
         CAST(round(CAST(round(max(power_draw_watts), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS max_power_draw,
         CAST(sum(ecc1) AS BIGINT) AS total_ecc_single_bit, CAST(sum(ecc2) AS BIGINT) AS total_ecc_double_bit,
         CAST(round(CAST(round(avg(fan_speed_pct), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_fan_speed,
         CAST(round(CAST(round(avg(pcie_throughput_gbps), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_pcie_throughput"""


def snapshot(span: str) -> str:
    return f"""snapshot AS (
  SELECT gpu_id, cluster_id, gpu_model, {STATISTICS},
         min("timestamp") AS window_start, max("timestamp") AS window_end
  FROM wide WHERE "timestamp" >= (SELECT max(ts) FROM events) - INTERVAL {span}
  GROUP BY 1, 2, 3)"""


def r8(*columns: str) -> str:
    return ", ".join(f"round({c}, 8) AS {c}" for c in columns)


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
