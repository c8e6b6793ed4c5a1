"""Profile, drift and alert queries."""

from oracle.parts import PREDICTIONS, STATISTICS, WIDE, with_

_UNIT = {"1 hour": "hour", "1 day": "day"}


def _profile(numeric: list[str], categorical: list[str], granularities: list[str], slices: list[str]) -> str:
    parts = []
    for grain in granularities:
        for column in [*numeric, *categorical]:
            for s in [None, *slices]:
                is_number = column in numeric
                kind = "int" if column == "prediction" else ("double" if is_number else "string")
                x = f"CAST({column} AS DOUBLE)"
                stats = (
                    f"avg({x}) AS mean, stddev_samp({x}) AS stddev, min({x}) AS min, max({x}) AS max"
                    if is_number
                    else "NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev, NULL::DOUBLE AS min, NULL::DOUBLE AS max"
                )
                key = "CAST(NULL AS VARCHAR)" if s is None else f"'{s}'"
                value = "CAST(NULL AS VARCHAR)" if s is None else f"CAST({s} AS VARCHAR)"
                group = "" if s is None else f", {s}"
                parts.append(
                    f"""SELECT date_trunc('{_UNIT[grain]}', prediction_timestamp) AS window_start, '{grain}' AS granularity,
  {key} AS slice_key, {value} AS slice_value, '{column}' AS column_name, '{kind}' AS data_type, count(*) AS count,
  count(*) - count({column}) AS num_nulls, (count(*) - count({column})) * 100.0::DOUBLE / count(*) AS percent_null,
  count(DISTINCT {column}) * 100.0::DOUBLE / nullif(count({column}), 0) AS percent_distinct, {stats}
FROM predictions GROUP BY date_trunc('{_UNIT[grain]}', prediction_timestamp){group}"""
                )
    return "profiled AS (" + "\nUNION ALL\n".join(parts) + ")"


_PROFILE_COLUMNS = """window_start, window_start + (CASE granularity WHEN '1 hour' THEN INTERVAL 1 HOUR ELSE INTERVAL 1 DAY END) AS window_end,
  granularity, slice_key, slice_value, column_name, data_type, count, num_nulls, round(percent_null, 8) AS percent_null,
  round(percent_distinct, 8) AS percent_distinct, round(mean, 8) AS mean, round(stddev, 8) AS stddev, round(min, 8) AS min, round(max, 8) AS max"""

_DRIFTING = ["avg_temperature", "max_temperature", "avg_utilization", "avg_power_draw"]


def _cent(x: str) -> str:
    return f"CAST(round(CAST(round({x}, 8) AS DECIMAL(38, 8)), 2) AS DOUBLE)"


_NUMERIC = ["avg_temp", "avg_utilization", "prediction"]
_SLICES = ["cluster_id", "gpu_type"]


def _samples(slices: list[str], columns: list[str], cast: str, day: str, source: str) -> str:
    parts = []
    for s in [None, *slices]:
        for c in columns:
            key = "CAST(NULL AS VARCHAR)" if s is None else f"'{s}'"
            value = "CAST(NULL AS VARCHAR)" if s is None else f"CAST({s} AS VARCHAR)"
            parts.append(
                f"SELECT {day} AS day, {key} AS slice_key, {value} AS slice_value, '{c}' AS column_name, CAST({c} AS {cast}) AS v FROM {source}"
            )
    return "\nUNION ALL\n".join(parts)


def _drift(slices: list[str], baseline: bool) -> str:
    """Every test's two samples side by side, then cumulative shares and cell sums."""
    day = "date_trunc('day', prediction_timestamp)"
    parts = []
    for kind, columns, cast in (("num", ["avg_temp", "avg_utilization"], "DOUBLE"), ("cat", ["prediction", "gpu_type"], "VARCHAR")):
        parts.append(f"{kind} AS ({_samples(slices, columns, cast, day, 'predictions')})")
        if baseline:
            parts.append(f"{kind}_fixed AS ({_samples(slices, columns, cast, 'NULL', 'week')})")
            reference = f"""SELECT d.day, f.slice_key, f.slice_value, f.column_name, f.v, 1 AS r, 0 AS c
  FROM {kind}_fixed f JOIN (SELECT DISTINCT day, slice_key, slice_value, column_name FROM {kind}) d
  ON d.slice_key IS NOT DISTINCT FROM f.slice_key AND d.slice_value IS NOT DISTINCT FROM f.slice_value AND d.column_name = f.column_name"""
        else:
            reference = f"SELECT day + INTERVAL 1 DAY AS day, slice_key, slice_value, column_name, v, 1 AS r, 0 AS c FROM {kind}"
        parts.append(
            f"""{kind}_pair AS (SELECT day, slice_key, slice_value, column_name, v, sum(r) AS r, sum(c) AS c FROM (
  SELECT day, slice_key, slice_value, column_name, v, 0 AS r, 1 AS c FROM {kind} UNION ALL {reference}) GROUP BY ALL)"""
        )
        parts.append(
            f"""{kind}_all AS (SELECT *, sum(r) OVER t AS n_ref, sum(c) OVER t AS n_cur FROM {kind}_pair
  WINDOW t AS (PARTITION BY day, slice_key, slice_value, column_name) QUALIFY n_ref > 0 AND n_cur > 0)"""
        )
    parts.append(
        """ks AS (SELECT day, slice_key, slice_value, column_name, n_ref, n_cur, max(gap) AS ks_stat FROM (
  SELECT *, abs(sum(r) OVER o / n_ref::DOUBLE - sum(c) OVER o / n_cur::DOUBLE) AS gap FROM num_all
  WINDOW o AS (PARTITION BY day, slice_key, slice_value, column_name ORDER BY v)) GROUP BY ALL)"""
    )
    parts.append(
        """chi AS (SELECT day, slice_key, slice_value, column_name, n_ref, n_cur,
  sum(pow(r - er, 2) / er + pow(c - ec, 2) / ec) AS chi2_stat, count(*) - 1 AS degrees FROM (
  SELECT *, (r + c) * n_ref / (n_ref + n_cur)::DOUBLE AS er, (r + c) * n_cur / (n_ref + n_cur)::DOUBLE AS ec FROM cat_all) GROUP BY ALL)"""
    )
    parts.append(
        """tests AS (SELECT day, slice_key, slice_value, column_name, n_ref, n_cur, ks_stat, NULL::DOUBLE AS chi2_stat,
  NULL::BIGINT AS degrees, sqrt(n_ref * n_cur / (n_ref + n_cur)::DOUBLE) AS root FROM ks
  UNION ALL SELECT day, slice_key, slice_value, column_name, n_ref, n_cur, NULL, chi2_stat, degrees, NULL FROM chi),
lams AS (SELECT *, (root + 0.12 + 0.11 / root) * ks_stat AS lam FROM tests),
tails AS (SELECT *, CASE WHEN lam IS NULL THEN NULL WHEN lam < 0.2 THEN 1.0::DOUBLE ELSE
  least(greatest(2 * list_sum(list_transform(range(1, 101), lambda j: (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * j * j * lam * lam))), 0), 1) END AS ks_pvalue
  FROM lams)"""
    )
    return ",\n".join(parts)


# Upper chi-squared tail for whole degrees: a finite sum, for odd ones plus erfc by the series of erf.
_CHI2_TAIL = """CASE WHEN chi2_stat IS NULL OR degrees < 1 THEN NULL WHEN chi2_stat <= 0 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE,
  CASE WHEN degrees % 2 = 0 THEN 0 ELSE 1 - 2 / sqrt(pi()) * exp(-chi2_stat / 2) * list_sum(list_transform(range(0, 400), lambda n:
    exp((n + 0.5::DOUBLE) * ln(chi2_stat / 2) + 2 * n * ln(2) + lgamma(n + 1.0::DOUBLE) - lgamma(2 * n + 2.0::DOUBLE)))) END
  + coalesce(list_sum(list_transform(range(0, degrees // 2), lambda j: exp((j + degrees % 2 * 0.5::DOUBLE) * ln(chi2_stat / 2)
    - chi2_stat / 2 - lgamma(j + 1 + degrees % 2 * 0.5::DOUBLE)))), 0)) END"""

_WEEK = """week AS (SELECT * FROM predictions WHERE prediction_timestamp < (SELECT min(ts) FROM events) + INTERVAL 7 DAYS)"""
_TEST_COLUMNS = """SELECT day AS window_start, slice_key, slice_value, column_name, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur,
  round(ks_stat, 8) AS ks_stat, round(ks_pvalue, 8) AS ks_pvalue, round(chi2_stat, 8) AS chi2_stat FROM tails"""

def _quantiles(numeric: list[str], slices: list[str]) -> str:
    """Edges of cells of 2**-8: exponent and eight more bits of the value of each rank."""
    parts = [
        f"""SELECT date_trunc('day', prediction_timestamp) AS day, {"NULL::VARCHAR" if s is None else f"'{s}'"} AS slice_key,
  {"NULL::VARCHAR" if s is None else f"CAST({s} AS VARCHAR)"} AS slice_value, '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM predictions WHERE {c} IS NOT NULL"""
        for c in numeric
        for s in [None, *slices]
    ]
    return (
        "longs AS (" + " UNION ALL ".join(parts) + """), edged AS (SELECT *, CASE WHEN x = 0 THEN 0 ELSE
  sign(x) * floor(abs(x) * pow(2.0::DOUBLE, 8 - floor(log2(abs(x))))) * pow(2.0::DOUBLE, floor(log2(abs(x))) - 8) END AS edge FROM longs),
placed AS (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY day, slice_key, slice_value, column_name) AS n FROM edged
  WINDOW w AS (PARTITION BY day, slice_key, slice_value, column_name ORDER BY x))"""
    )


_RANKS = ", ".join(f"max(edge) FILTER (r = ceil({p}::DOUBLE * n)) AS {name}" for name, p in [("p05", 0.05), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95)])

MONITORING = {
    "profile_quantiles": with_(PREDICTIONS, _quantiles(_NUMERIC, _SLICES))
    + f"""SELECT day AS window_start, day + INTERVAL 1 DAY AS window_end, slice_key, slice_value, column_name, any_value(n) AS n, {_RANKS}
FROM placed GROUP BY day, slice_key, slice_value, column_name""",
    "profile_metrics": with_(PREDICTIONS, _profile(_NUMERIC, ["gpu_type"], ["1 day"], _SLICES))
    + f"SELECT {_PROFILE_COLUMNS} FROM profiled",
    "profile_metrics_hourly": with_(PREDICTIONS, _profile(_NUMERIC, [], ["1 hour", "1 day"], _SLICES))
    + f"SELECT {_PROFILE_COLUMNS} FROM profiled",
    "q38_profile_report": with_(PREDICTIONS, _profile(_NUMERIC, [], ["1 hour", "1 day"], _SLICES))
    + f"""SELECT {_PROFILE_COLUMNS} FROM profiled
ORDER BY window_start DESC, column_name, granularity, slice_key NULLS FIRST, slice_value NULLS FIRST LIMIT 20""",
    "drift_consecutive": with_(PREDICTIONS, _drift(_SLICES, False)) + _TEST_COLUMNS,
    "drift_from_baseline": with_(PREDICTIONS, _WEEK, _drift(["gpu_type"], True)) + _TEST_COLUMNS,
    "q39_drift_report": with_(PREDICTIONS, _drift(_SLICES, False))
    + f"""SELECT day AS window_start, day + INTERVAL 1 DAY AS window_end, slice_key, slice_value, column_name, round(chi2_stat, 8) AS chi2_stat,
  round({_CHI2_TAIL}, 8) AS chi2_pvalue, round(ks_stat, 8) AS ks_stat, round(ks_pvalue, 8) AS ks_pvalue FROM tails
ORDER BY day DESC, column_name, slice_key NULLS FIRST, slice_value NULLS FIRST LIMIT 20""",
    "retrain_triggers": with_(PREDICTIONS, _drift(_SLICES, False))
    + """SELECT day AS window_start, slice_key, slice_value, column_name,
  round(coalesce(ks_stat, sqrt(chi2_stat / (n_ref + n_cur))), 8) AS drift_score,
  coalesce(ks_stat, sqrt(chi2_stat / (n_ref + n_cur))) > 0.15 AS retrain FROM tails""",
    "q40_anomaly_alerts": with_(PREDICTIONS)
    + """, grains AS (SELECT *, '1 hour' AS granularity, date_trunc('hour', prediction_timestamp) AS window_start,
  date_trunc('hour', prediction_timestamp) + INTERVAL 1 HOUR AS window_end FROM predictions
  UNION ALL SELECT *, '1 day', date_trunc('day', prediction_timestamp), date_trunc('day', prediction_timestamp) + INTERVAL 1 DAY FROM predictions),
rates AS (
  SELECT window_start, window_end, granularity, NULL::VARCHAR AS slice_key, NULL::VARCHAR AS slice_value, avg(prediction) AS rate FROM grains GROUP BY 1, 2, 3
  UNION ALL SELECT window_start, window_end, granularity, 'cluster_id', cluster_id, avg(prediction) FROM grains GROUP BY 1, 2, 3, cluster_id
  UNION ALL SELECT window_start, window_end, granularity, 'gpu_type', gpu_type, avg(prediction) FROM grains GROUP BY 1, 2, 3, gpu_type)
SELECT window_start, window_end, granularity, slice_key, slice_value, round(rate, 8) AS anomaly_rate,
  CASE WHEN rate > 0.05 THEN 'ALERT: Anomaly rate exceeds 5%!' ELSE 'OK' END AS alert_status FROM rates""",
    "profile_change_previous": with_(PREDICTIONS, _profile(["avg_temp", "avg_utilization"], [], ["1 day"], ["gpu_type"]))
    + """, lagged AS (SELECT *, lag(mean) OVER (PARTITION BY slice_key, slice_value, column_name ORDER BY window_start) AS p FROM profiled)
SELECT window_start, slice_key, slice_value, column_name, round(mean, 8) AS mean, round(p, 8) AS previous_mean,
  round((mean - p) * 100 / p, 8) AS percent_change FROM lagged""",
    "q45_profile_change": with_(WIDE)
    + f""", features AS (SELECT gpu_id, time_bucket(INTERVAL 15 MINUTES, "timestamp") AS window_start, {STATISTICS} FROM wide GROUP BY 1, 2),
profiled AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, date_trunc('day', window_start) AS day, avg({c}) AS mean, stddev_samp({c}) AS stddev, min({c}) AS low, max({c}) AS high FROM features GROUP BY 2" for c in _DRIFTING)}),
base AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, avg({c}) AS b FROM features WHERE window_start < (SELECT min(window_start) FROM features) + INTERVAL 7 DAYS" for c in _DRIFTING)})
SELECT column_name, day AS window_start, day + INTERVAL 1 DAY AS window_end, {_cent("mean")} AS mean_value, {_cent("stddev")} AS stddev_value,
  {_cent("low")} AS min_value, {_cent("high")} AS max_value, {_cent("(mean - b) / b * 100")} AS pct_change_from_baseline
FROM profiled JOIN base USING (column_name) ORDER BY window_end DESC, column_name LIMIT 20""",
}
