"""Exploration, dashboard, feature, table-change and scoring queries."""

from oracle.parts import (
    CLUSTERS, EVENTS, HOUR_LABELS, HOURLY_COLUMNS, INVENTORY, JOBS, LABELS, PREDICTIONS, READINGS,
    STATISTICS, TELEMETRY, TRAINING, WIDE, hourly, r8, snapshot, with_,
)

_DAYS = """"timestamp" >= TIMESTAMP '2024-01-08' AND "timestamp" < TIMESTAMP '2024-01-22'"""
_DOUBLES = [c for c in HOURLY_COLUMNS if c != "error_count_1h"]
_HOURLY = f"gpu_id, window_start, error_count_1h, {r8(*_DOUBLES)}"
_BOTH = f"""{with_(READINGS, hourly("old_h"), hourly("new_h", "event_type <> 'error'"))}"""

FLEET = {
    "q01_inventory_listing": with_(INVENTORY) + "SELECT * FROM inventory ORDER BY cluster_id",
    "q02_clouds": with_(INVENTORY)
    + """SELECT cloud_provider, count(*) AS cluster_count, CAST(sum(gpu_count) AS BIGINT) AS total_gpus,
       string_agg(DISTINCT gpu_type, ',' ORDER BY gpu_type) AS gpu_types
FROM inventory GROUP BY 1""",
    "q03_telemetry_summary": with_(TELEMETRY)
    + """SELECT count(*) AS total_readings, count(DISTINCT gpu_id) AS unique_gpus,
       count(DISTINCT cluster_id) AS unique_clusters,
       CAST(round(CAST(round(avg(temp_celsius), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_temp, CAST(round(CAST(round(max(temp_celsius), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS max_temp,
       CAST(round(CAST(round(avg(utilization_pct), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_utilization,
       CAST(round(CAST(round(avg(power_watts), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_power, CAST(sum(error_count) AS BIGINT) AS total_errors
FROM telemetry""",
    "q04_reading_types": with_(READINGS)
    + """SELECT CASE WHEN temp_celsius > 90 THEN 'anomalous' ELSE 'normal' END AS reading_type, count(*) AS count,
       CAST(round(CAST(round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM readings), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS pct
FROM readings GROUP BY 1""",
    "q05_resolution_rates": """SELECT l_returnflag AS event_type, count(*) AS event_count,
       CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS resolved_count,
       CAST(round(CAST(round(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS resolution_rate_pct
FROM lineitem GROUP BY 1""",
    "q06_top_descriptions": """SELECT l_returnflag AS event_type, p_type AS description, count(*) AS occurrences
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2
ORDER BY occurrences DESC, event_type, description LIMIT 5""",
    "q07_jobs_by_framework": with_(JOBS)
    + """SELECT framework, model_type, count(*) AS job_count,
       CAST(sum(CASE WHEN status = 'completed' THEN 1 ELSE 0 END) AS BIGINT) AS completed,
       CAST(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       CAST(sum(CASE WHEN status = 'running' THEN 1 ELSE 0 END) AS BIGINT) AS running,
       CAST(round(CAST(round(sum(gpu_hours), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS total_gpu_hours, CAST(round(CAST(round(sum(cost_usd), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS total_cost_usd
FROM jobs GROUP BY 1, 2""",
    "q08_costly_jobs": with_(JOBS)
    + """SELECT job_id, cluster_id, framework, model_type, gpu_hours, cost_usd, status
FROM jobs ORDER BY cost_usd DESC, job_id LIMIT 5""",
    "q09_label_balance": """SELECT toxic AS is_anomaly, count(*) AS label_count,
       CAST(round(CAST(round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM labels), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS pct
FROM labels GROUP BY 1""",
    "q10_training_summary": with_(READINGS, LABELS, TRAINING)
    + """SELECT count(*) AS total_windows,
       CAST(sum(CASE WHEN is_anomaly = 1 THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_windows,
       CAST(round(CAST(round(avg(reading_count), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_readings_per_window,
       CAST(round(CAST(round(avg(avg_temp_celsius), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS overall_avg_temp,
       CAST(round(CAST(round(avg(total_error_count), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_total_errors FROM training""",
    "q11_training_by_label": with_(READINGS, LABELS, TRAINING)
    + """SELECT is_anomaly, count(*) AS window_count, CAST(round(CAST(round(avg(avg_temp_celsius), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_temp,
       CAST(round(CAST(round(avg(max_temp_celsius), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_max_temp,
       CAST(round(CAST(round(avg(avg_utilization_pct), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_util,
       CAST(round(CAST(round(avg(avg_power_watts), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_power,
       CAST(round(CAST(round(avg(total_error_count), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_errors
FROM training WHERE reading_count > 0 GROUP BY 1""",
    "q12_table_counts": """SELECT 'cluster_inventory' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'gpu_telemetry', count(*) FROM events
UNION ALL SELECT 'gpu_health_events', count(*) FROM lineitem
UNION ALL SELECT 'ml_job_runs', count(*) FROM orders
UNION ALL SELECT 'gpu_anomaly_labels', count(*) FROM labels
UNION ALL SELECT 'gpu_runbook_documents', count(*) FROM documents""",
    "q13_training_set": with_(READINGS, LABELS, TRAINING)
    + "SELECT gpu_id, window_start, is_anomaly, reading_count, total_error_count, max_error_count, "
    + r8(
        "avg_temp_celsius", "max_temp_celsius", "min_temp_celsius", "std_temp_celsius", "avg_utilization_pct",
        "max_utilization_pct", "avg_memory_used_gb", "max_memory_used_gb", "avg_power_watts", "max_power_watts",
    )
    + " FROM training",
    "q14_event_preview": with_(EVENTS)
    + """SELECT event_id, cluster_id, gpu_id, description, severity, "timestamp" FROM health ORDER BY event_id LIMIT 10""",
    "q15_job_preview": with_(JOBS)
    + "SELECT job_id, description, status, cluster_id, start_time FROM jobs ORDER BY job_id LIMIT 10",
    "q20_hottest_clusters": with_(TELEMETRY)
    + """SELECT cluster_id, round(avg(temp_celsius), 8) AS avg_temp FROM telemetry
WHERE "timestamp" >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS
GROUP BY 1 ORDER BY avg_temp DESC, cluster_id LIMIT 10""",
    "q21_most_errors": with_(TELEMETRY)
    + """SELECT cluster_id, CAST(sum(error_count) AS BIGINT) AS total_errors FROM telemetry
WHERE "timestamp" >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS
GROUP BY 1 ORDER BY total_errors DESC, cluster_id LIMIT 1""",
    "q22_provider_utilization": with_(TELEMETRY, CLUSTERS)
    + """SELECT round(avg(utilization_pct), 8) AS avg_utilization, count(*) AS readings
FROM telemetry JOIN clusters USING (cluster_id) WHERE cloud_provider = 'AMERICA'""",
    "q23_longest_jobs": with_(JOBS)
    + "SELECT job_id, framework, gpu_hours, cost_usd FROM jobs ORDER BY gpu_hours DESC, job_id LIMIT 10",
    "q27_cluster_options": "SELECT DISTINCT c_custkey AS cluster_id, c_name AS cluster_name FROM customer",
    "q28_provider_options": with_(INVENTORY) + "SELECT DISTINCT cloud_provider FROM inventory",
    "q29_tiles": with_(TELEMETRY, CLUSTERS, EVENTS)
    + f"""SELECT count(DISTINCT gpu_id) AS total_gpus, CAST(round(CAST(round(avg(utilization_pct), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_utilization,
       CAST(round(CAST(round(avg(temp_celsius), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_temperature,
       (SELECT count(*) FROM health JOIN clusters USING (cluster_id)
        WHERE {_DAYS} AND cloud_provider = 'ASIA' AND severity IN ('critical', 'warning')) AS active_alerts
FROM telemetry JOIN clusters USING (cluster_id) WHERE {_DAYS} AND cloud_provider = 'ASIA'""",
    "q30_active_alerts": with_(EVENTS)
    + f"SELECT count(*) AS active_alerts FROM health WHERE {_DAYS} AND severity IN ('critical', 'warning')",
    "q31_heatmap": with_(TELEMETRY, CLUSTERS)
    + f"""SELECT cluster_name, gpu_id, CAST(round(CAST(round(avg(utilization_pct), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_util,
       CAST(round(CAST(round(avg(temp_celsius), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_temp
FROM telemetry JOIN clusters USING (cluster_id) WHERE {_DAYS} GROUP BY 1, 2""",
    "q31_heatmap_matrix": with_(TELEMETRY, CLUSTERS)
    + f""", heat AS (SELECT cluster_name, gpu_id, gpu_type, CAST(round(CAST(round(avg(utilization_pct), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_util
  FROM telemetry JOIN clusters USING (cluster_id) WHERE {_DAYS} GROUP BY 1, 2, 3)
SELECT cluster_name, round(avg(avg_util) FILTER (gpu_type = 'AUTOMOBILE'), 8) AS "AUTOMOBILE",
       round(avg(avg_util) FILTER (gpu_type = 'BUILDING'), 8) AS "BUILDING",
       round(avg(avg_util) FILTER (gpu_type = 'FURNITURE'), 8) AS "FURNITURE",
       round(avg(avg_util) FILTER (gpu_type = 'HOUSEHOLD'), 8) AS "HOUSEHOLD",
       round(avg(avg_util) FILTER (gpu_type = 'MACHINERY'), 8) AS "MACHINERY"
FROM heat GROUP BY 1""",
    "q31_gpu_matrix": with_(TELEMETRY)
    + """, means AS (SELECT cluster_id, gpu_id, avg((temp_celsius > 90)::DOUBLE) AS hot FROM telemetry GROUP BY 1, 2)
SELECT cluster_id, CAST(count(*) AS INTEGER) AS gpus, CAST(count(*) FILTER (hot > 0.5) AS INTEGER) AS mostly_hot FROM means GROUP BY 1""",
    "q32_temperature_series": with_(TELEMETRY, CLUSTERS)
    + f"""SELECT date_trunc('hour', "timestamp") AS time_bucket, cluster_name,
       CAST(round(CAST(round(avg(temp_celsius), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS avg_temp, CAST(round(CAST(round(max(temp_celsius), 8) AS DECIMAL(38, 8)), 1) AS DOUBLE) AS max_temp
FROM telemetry JOIN clusters USING (cluster_id) WHERE {_DAYS} GROUP BY 1, 2""",
    "q33_recent_alerts": with_(EVENTS, CLUSTERS)
    + f"""SELECT "timestamp", cluster_name, gpu_id, severity, event_type, description, event_id
FROM health JOIN clusters USING (cluster_id) WHERE {_DAYS} ORDER BY "timestamp" DESC, event_id LIMIT 50""",
    "q44_anomalous_gpus": with_(TELEMETRY)
    + """SELECT count(DISTINCT gpu_id) AS anomalous_gpus, round(avg(temp_celsius), 8) AS avg_temp,
       round(avg(utilization_pct), 8) AS avg_utilization
FROM telemetry WHERE cluster_id = '3' AND temp_celsius > 90""",
    "q47_thermal_warnings": with_(READINGS)
    + """SELECT count(DISTINCT gpu_id) AS gpus_in_warning,
       count(DISTINCT CASE WHEN utilization_pct > 80 THEN gpu_id END) AS gpus_in_warning_and_busy,
       count(*) AS readings_in_warning FROM readings WHERE temp_celsius > 83""",
    "q34_hourly_features": with_(READINGS, hourly()) + f"SELECT {_HOURLY} FROM hourly",
    "q34_rolling_features": with_(READINGS, hourly())
    + """, framed AS (SELECT gpu_id, window_start,
  CAST(sum(error_count_1h) OVER f AS BIGINT) AS error_count_24h,
  regr_slope(avg_utilization, epoch(window_start) / 3600) OVER f AS slope
  FROM hourly WINDOW f AS (PARTITION BY gpu_id ORDER BY window_start RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW))
SELECT gpu_id, window_start, error_count_24h, CASE WHEN isnan(slope) THEN NULL ELSE round(slope, 8) END AS util_trend FROM framed""",
    "q34_feature_table": with_(READINGS, hourly())
    + f""", framed AS (SELECT gpu_id, window_start, CAST(sum(error_count_1h) OVER f AS BIGINT) AS error_count_24h,
  regr_slope(avg_utilization, epoch(window_start) / 3600) OVER f AS slope
  FROM hourly WINDOW f AS (PARTITION BY gpu_id ORDER BY window_start RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW))
SELECT {_HOURLY}, error_count_24h, CASE WHEN isnan(slope) THEN NULL ELSE round(slope, 8) END AS util_trend
FROM hourly JOIN framed USING (gpu_id, window_start)""",
    "declared_jobs": with_(JOBS)
    + """SELECT job_id, cluster_id, framework, model_type, description, start_time, end_time, gpu_hours, status, cost_usd FROM jobs""",
    "q41_recent_snapshot": with_(WIDE, snapshot("15 MINUTES"))
    + "SELECT *, (SELECT max(ts) FROM events) AS computed_at FROM snapshot",
    "q35_upsert": with_(READINGS, hourly())
    + """SELECT gpu_id, window_start,
       CASE WHEN window_start < TIMESTAMP '2024-01-19' THEN 0.0::DOUBLE ELSE round(avg_temp, 8) END AS avg_temp, error_count_1h
FROM hourly""",
    "q36_labelled_features": with_(READINGS, hourly(), HOUR_LABELS)
    + "SELECT gpu_id, window_start, is_anomaly, error_count_1h, "
    + ", ".join(f"round(coalesce({c}, 0), 8) AS {c}" for c in _DOUBLES)
    + " FROM hourly JOIN hour_labels USING (gpu_id, window_start)",
    "q41_snapshot_features": with_(WIDE, snapshot("6 HOURS")) + "SELECT * FROM snapshot",
    "q42_cluster_snapshot": with_(WIDE, snapshot("7 DAYS"))
    + """SELECT gpu_id, cluster_id, avg_temperature, max_temperature, avg_utilization, max_utilization,
       avg_power_draw, reading_count FROM snapshot WHERE cluster_id = '3'""",
    "range_join_pairs": with_(READINGS, LABELS)
    + """SELECT l.gpu_id, l.window_start, l.is_anomaly, l.window_start + INTERVAL 1 HOUR AS window_end,
       t."timestamp", t.event_id, t.temp_celsius
FROM labelled l LEFT JOIN (SELECT * FROM readings WHERE event_type <> 'signup') t
  ON t.gpu_id = l.gpu_id AND t."timestamp" >= l.window_start AND t."timestamp" < l.window_start + INTERVAL 1 HOUR""",
    "asof_features": with_(READINGS, LABELS, hourly(where="event_type <> 'signup'"))
    + """, known AS (SELECT gpu_id, window_start + INTERVAL 1 HOUR AS known_at, avg_temp, error_count_1h FROM hourly)
SELECT l.gpu_id, l.window_start, l.is_anomaly, k.known_at, round(k.avg_temp, 8) AS avg_temp, k.error_count_1h
FROM labelled l ASOF LEFT JOIN known k ON l.gpu_id = k.gpu_id AND l.window_start >= k.known_at""",
    "event_clusters": with_(EVENTS, CLUSTERS)
    + "SELECT event_id, severity, cluster_name, cloud_provider FROM health JOIN clusters USING (cluster_id)",
    "snapshot_diff": _BOTH
    + """SELECT gpu_id, window_start, round(coalesce(n.max_temp, o.max_temp), 8) AS max_temp,
       coalesce(n.error_count_1h, o.error_count_1h) AS error_count_1h,
       CASE WHEN o.max_temp IS NULL THEN 'insert' WHEN n.max_temp IS NULL THEN 'delete' ELSE 'update' END AS _change
FROM old_h o FULL JOIN new_h n USING (gpu_id, window_start)
WHERE o.max_temp IS DISTINCT FROM n.max_temp OR o.error_count_1h IS DISTINCT FROM n.error_count_1h""",
    "applied_changes": with_(READINGS, hourly(where="event_type <> 'error'"))
    + "SELECT gpu_id, window_start, round(max_temp, 8) AS max_temp, error_count_1h FROM hourly",
    "table_contract": with_(EVENTS)
    + """SELECT * FROM (
  SELECT 'null_value' AS rule, 'description' AS column_name, count(*) AS violations
  FROM health WHERE description = 'Network link flapping on port 0'
  UNION ALL
  SELECT 'duplicate_key', 'gpu_id,event_type', count(*)
  FROM (SELECT 1 FROM health GROUP BY gpu_id, event_type HAVING count(*) > 1)) WHERE violations > 0""",
    "written_and_evolved": """SELECT place, brand, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum FROM (
  SELECT s_suppkey AS id, s_nationkey AS place, NULL AS brand FROM supplier
  UNION ALL SELECT c_custkey, c_nationkey, NULL FROM customer
  UNION ALL SELECT p_partkey, NULL, p_brand FROM part) GROUP BY 1, 2""",
    "published_versions": """SELECT c_nationkey, coalesce(s.n, c.n) AS n
FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c
FULL JOIN (SELECT s_nationkey AS c_nationkey, count(*) AS n FROM supplier GROUP BY 1) s USING (c_nationkey)""",
    "upserted_partitions": with_(READINGS, hourly())
    + """SELECT CAST(window_start AS DATE) AS day, count(*) AS n,
       CAST(sum(error_count_1h + CASE WHEN window_start >= TIMESTAMP '2024-01-25' THEN 100 ELSE 0 END) AS BIGINT) AS errors
FROM hourly GROUP BY 1""",
    "missing_entities": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
    "latest_versions": "SELECT o_orderpriority, max(o_orderkey) AS latest_version FROM orders GROUP BY 1",
    "formatted_rows": """SELECT s_suppkey, 'suppli-' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(3, len(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS padded_id,
       '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","s_nationkey":' || s_nationkey || '}' AS payload,
       format('{:,.2f}%', round(s_suppkey / 1000 * 100, 2)) AS share
FROM supplier""",
    "q43_score_flags": with_(PREDICTIONS)
    + """SELECT prediction_timestamp, cluster_id, round(score, 8) AS score, score > 0.7 AS is_anomaly_predicted,
       CASE WHEN score > 0.7 THEN 'ANOMALY DETECTED' ELSE 'Normal' END AS status FROM predictions""",
    "q46_cohorts": with_(WIDE, snapshot("7 DAYS"))
    + """SELECT 'baseline' AS period, CAST(round(CAST(round(avg(avg_temperature), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS mean_temp,
       CAST(round(CAST(round(stddev_samp(avg_temperature), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS stddev_temp,
       CAST(round(CAST(round(max(max_temperature), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS peak_temp, count(*) AS gpu_count FROM snapshot WHERE cluster_id <> '3'
UNION ALL
SELECT 'current', CAST(round(CAST(round(avg(avg_temperature), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE), CAST(round(CAST(round(stddev_samp(avg_temperature), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE),
       CAST(round(CAST(round(max(max_temperature), 8) AS DECIMAL(38, 8)), 2) AS DOUBLE), count(*) FROM snapshot WHERE cluster_id = '3'""",
    "q49_split": with_(HOUR_LABELS)
    + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY is_anomaly
    ORDER BY md5(gpu_id || '|' || strftime(window_start, '%Y-%m-%d %H:%M:%S')), gpu_id, window_start) AS r,
  count(*) OVER (PARTITION BY is_anomaly) AS n FROM hour_labels)
SELECT gpu_id, window_start, is_anomaly, r <= round(n * 0.2::DOUBLE) AS is_test FROM ranked""",
    "q49_class_weights": with_(HOUR_LABELS)
    + """SELECT is_anomaly, count(*) AS n,
       round((SELECT count(*) FROM hour_labels) / ((SELECT count(DISTINCT is_anomaly) FROM hour_labels) * count(*))::DOUBLE, 8) AS weight
FROM hour_labels GROUP BY 1""",
    "q49_class_balance": with_(HOUR_LABELS) + "SELECT round(avg(is_anomaly), 8) AS positive_rate FROM hour_labels",
    "q49_metrics": with_(PREDICTIONS)
    + """, c AS (SELECT count(*) FILTER (prediction = 1 AND score > 0.7) AS tp,
  count(*) FILTER (prediction = 0 AND score > 0.7) AS fp,
  count(*) FILTER (prediction = 1 AND NOT score > 0.7) AS fn FROM predictions)
SELECT tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 8) AS "precision",
       round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 8) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 8) AS f1 FROM c""",
    "q49_promotion": with_(PREDICTIONS)
    + """, said AS (SELECT 'score_rule' AS model, prediction, score > 0.7 AS yes FROM predictions
  UNION ALL SELECT 'heat_rule', prediction, avg_temp > 90 FROM predictions),
c AS (SELECT model, count(*) FILTER (prediction = 1 AND yes) AS tp, count(*) FILTER (prediction = 0 AND yes) AS fp,
  count(*) FILTER (prediction = 1 AND NOT yes) AS fn FROM said GROUP BY 1),
m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS "precision", coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1 FROM c)
SELECT model, tp, fp, fn, round("precision", 8) AS "precision", round(recall, 8) AS recall, round(f1, 8) AS f1,
       row_number() OVER (ORDER BY f1 DESC, model) = 1 AS promote FROM m""",
    "stream_hourly_features": with_(READINGS, hourly()) + f"SELECT {_HOURLY} FROM hourly",
    "stream_snapshot_features": with_(WIDE)
    + f"""SELECT gpu_id, time_bucket(INTERVAL 15 MINUTES, "timestamp") AS window_start,
       time_bucket(INTERVAL 15 MINUTES, "timestamp") + INTERVAL 15 MINUTES AS window_end, {STATISTICS},
       min("timestamp") AS first_reading, max("timestamp") AS last_reading
FROM wide GROUP BY 1, 2, 3""",
    "stream_scored_events": """SELECT event_id, round(value / 500, 8) AS score, value / 500 > 0.7 AS is_anomaly_predicted,
       CASE WHEN value / 500 > 0.7 THEN 'ANOMALY DETECTED' ELSE 'Normal' END AS status FROM events""",
    "stream_model_scores": with_(READINGS, hourly(), HOUR_LABELS) + """SELECT f.gpu_id, f.window_start, true AS as_in_batch
FROM hourly f JOIN hour_labels l USING (gpu_id, window_start)""",
}
for _name in ("hourly", "snapshot"):
    FLEET[f"stream_{_name}_corrected"] = FLEET[f"stream_{_name}_features"]
