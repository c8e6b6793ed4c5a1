from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import features as FE
from fleetlake.operators import joins as J

START = datetime(2024, 1, 1, 10, 20)
READING = "gpu_id string, timestamp timestamp_ntz, temp_celsius double, utilization_pct double, memory_used_gb double, power_watts double, error_count int"
LABEL = "gpu_id string, window_start timestamp_ntz, is_anomaly int"


def reading(gpu, at, temp, errors=0):
    return (gpu, at, temp, temp / 2, 40.0, 300.0, errors)


def naive(labels, telemetry):
    """The same features as SQL over two views."""
    labels.createOrReplaceTempView("asked_windows")
    telemetry.createOrReplaceTempView("all_readings")
    return labels.sparkSession.sql("""
        SELECT w.gpu_id, w.window_start, w.is_anomaly, count(r.gpu_id) AS n, round(mean(r.temp_celsius), 8) AS m,
            round(stddev_samp(r.temp_celsius), 8) AS s, min(r.temp_celsius) AS low, max(r.power_watts) AS high,
            sum(r.error_count) AS errors, max(r.error_count) AS most
        FROM asked_windows AS w LEFT JOIN all_readings AS r
        ON r.gpu_id = w.gpu_id AND timestampdiff(MICROSECOND, w.window_start, r.timestamp) BETWEEN 0 AND 3599999999
        GROUP BY ALL
    """)


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def windowed(labels, telemetry, **options):
    out = FE.label_window_features(labels, telemetry, **options)
    return out.select(
        "gpu_id", "window_start", "is_anomaly", "reading_count",
        F.round("avg_temp_celsius", 8), F.round("std_temp_celsius", 8), "min_temp_celsius",
        "max_power_watts", "total_error_count", "max_error_count",
    )


def edge_frames(spark):
    end = START + timedelta(hours=1)
    readings = [
        reading("a", START, 70.0, 1),
        reading("a", end - timedelta(microseconds=1), 80.0),
        reading("a", end, 99.0, 5),
        reading("a", START - timedelta(microseconds=1), 99.0, 5),
        reading("b", START, 75.0),
    ]
    labels = [
        ("a", START, 1),
        ("a", START, 1),  # a repeated label counts its readings twice, as the join does
        ("b", START, 0),
        ("c", START, 0),  # no readings
        ("a", datetime(2024, 1, 1, 10), 0),  # aligned with a slot
    ]
    return spark.createDataFrame(labels, LABEL), spark.createDataFrame(readings, READING)


@pytest.mark.parametrize("rows_per_task", [10_000_000, 1])
@pytest.mark.parametrize("prefilter", [True, False])
def test_label_windows_equal_the_join(spark, rows_per_task, prefilter):
    labels, telemetry = edge_frames(spark)
    mine = windowed(labels, telemetry, rows_per_task=rows_per_task, prefilter=prefilter)
    assert as_rows(mine) == as_rows(naive(labels, telemetry))


def test_label_window_edges(spark):
    labels, telemetry = edge_frames(spark)
    rows = {(r.gpu_id, r.window_start): r for r in FE.label_window_features(labels, telemetry).collect()}
    doubled, alone, empty = rows["a", START], rows["b", START], rows["c", START]
    assert (doubled.reading_count, doubled.min_temp_celsius, doubled.max_temp_celsius) == (4, 70.0, 80.0)
    assert doubled.total_error_count == 2
    assert (alone.reading_count, alone.std_temp_celsius) == (1, None)
    assert (empty.reading_count, empty.avg_temp_celsius, empty.total_error_count) == (0, None, None)


def test_a_nan_reading_spoils_only_its_own_windows(spark):
    telemetry = [reading("a", START + timedelta(minutes=m), t) for m, t in ((0, 70.0), (5, 74.0), (30, float("nan")))]
    labels = [("a", START - timedelta(minutes=35), 0), ("a", START + timedelta(minutes=6), 0)]
    frames = spark.createDataFrame(labels, LABEL), spark.createDataFrame(telemetry, READING)
    assert repr(as_rows(windowed(*frames))) == repr(as_rows(naive(*frames)))


def test_label_windows_on_a_hot_machine(spark):
    """Overlapping windows and many readings on one machine, with identical instants."""
    base = datetime(2024, 1, 1)
    telemetry = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("gpu_id"),
        (F.lit(base) + F.make_dt_interval(secs=(F.col("id") % 500) * 37)).cast("timestamp_ntz").alias("timestamp"),
        (65 + F.col("id") % 41).cast("double").alias("temp_celsius"),
        (F.col("id") % 100).cast("double").alias("utilization_pct"),
        F.lit(1.0).alias("memory_used_gb"),
        (F.col("id") % 7).cast("double").alias("power_watts"),
        (F.col("id") % 2).cast("int").alias("error_count"),
    )
    labels = spark.range(300).select(
        F.lit("hot").alias("gpu_id"),
        (F.lit(base) + F.make_dt_interval(secs=F.col("id") * 61)).cast("timestamp_ntz").alias("window_start"),
        (F.col("id") % 2).cast("int").alias("is_anomaly"),
    )
    for rows_per_task in (10_000_000, 100):
        assert as_rows(windowed(labels, telemetry, rows_per_task=rows_per_task)) == as_rows(naive(labels, telemetry))


@pytest.mark.parametrize("rows_per_task", [10_000_000, 1])
def test_range_join_edges(spark, rows_per_task):
    labels, telemetry = edge_frames(spark)
    windows = labels.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 HOUR"))
    right = telemetry.select("gpu_id", "timestamp", "temp_celsius")
    rows = J.range_join(windows, right, "gpu_id", "window_start", "window_end", "timestamp", rows_per_task=rows_per_task).collect()
    hits = sorted((r.gpu_id, r.window_start, r.temp_celsius) for r in rows if r.temp_celsius is not None)
    ten = datetime(2024, 1, 1, 10)
    assert hits == sorted(
        [("a", START, 70.0), ("a", START, 80.0)] * 2
        + [("b", START, 75.0)]
        + [("a", ten, 70.0), ("a", ten, 99.0)]
    )
    assert [r.gpu_id for r in rows if r.temp_celsius is None] == ["c"]


def test_range_join_long_windows_cross_many_slots(spark):
    windows = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), datetime(2024, 1, 3, 0, 30))], "gpu_id string, lo timestamp_ntz, hi timestamp_ntz"
    )
    ticks = spark.range(100).select(
        F.lit("a").alias("gpu_id"),
        (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz").alias("ts"),
    )
    assert J.range_join(windows, ticks, "gpu_id", "lo", "hi", "ts", how="inner").count() == 49


def test_asof_in_shorter_slots(spark):
    base = datetime(2024, 1, 1)

    def at(n, step):
        return (F.lit(base) + F.make_dt_interval(secs=n * step)).cast("timestamp_ntz")

    left = spark.range(400).select(F.lit("hot").alias("k"), at(F.col("id"), 23).alias("at"), "id")
    right = spark.range(100).select(F.lit("hot").alias("k"), at(F.col("id") + 3, 71).alias("since"), F.col("id").alias("v"))
    whole = as_rows(J.asof_join(left, right, "k", "at", "since"))
    assert as_rows(J.asof_join(left, right, "k", "at", "since", rows_per_task=7)) == whole
    want = [(i * 23) // 71 - 3 for i in range(400)]
    assert {r[2]: r[4] for r in whole} == {i: (min(v, 99) if v >= 0 else None) for i, v in enumerate(want)}


def test_asof(spark):
    left = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 0, 0), 1), ("a", datetime(2024, 1, 2, 5), 2), ("a", datetime(2024, 1, 1, 3), 3),
         ("b", datetime(2024, 1, 1), 4), (None, datetime(2024, 1, 1), 5)],
        "k string, at timestamp_ntz, n int",
    )
    right = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 3), "x"), ("a", datetime(2024, 1, 1, 7), "y"), ("c", datetime(2024, 1, 1), "z")],
        "k string, since timestamp_ntz, v string",
    )
    found = {r.n: r.v for r in J.asof_join(left, right, "k", "at", "since").collect()}
    assert found == {1: None, 2: "y", 3: "x", 4: None, 5: None}
    near = {r.n: r.v for r in J.asof_join(left, right, "k", "at", "since", tolerance="2 hours").collect()}
    assert near == {1: None, 2: None, 3: "x", 4: None, 5: None}


def test_rolling_counts_hours_not_rows(spark):
    hours = [0, 1, 23, 24, 47]
    hourly = spark.createDataFrame(
        [("a", datetime(2024, 1, 1) + timedelta(hours=h), 1, float(h)) for h in hours],
        "gpu_id string, window_start timestamp_ntz, error_count_1h int, avg_utilization double",
    )
    rows = FE.rolling_features(hourly).orderBy("window_start").collect()
    assert [r.error_count_24h for r in rows] == [1, 2, 3, 3, 2]
    assert rows[0].util_trend is None
    assert rows[1].util_trend == pytest.approx(1.0)


def test_hourly_single_reading_has_no_deviation(spark):
    one = spark.createDataFrame([reading("a", START, 81.0)], READING)
    row = FE.hourly_features(one).first()
    assert (row.temp_stddev, row.temp_range, row.high_temp_pct) == (None, 0.0, 1.0)
    assert row.window_start == datetime(2024, 1, 1, 10)


def test_features_do_not_depend_on_the_session_zone(spark):
    labels, telemetry = edge_frames(spark)
    want = as_rows(windowed(labels, telemetry)), as_rows(FE.hourly_features(telemetry))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert (as_rows(windowed(labels, telemetry)), as_rows(FE.hourly_features(telemetry))) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
