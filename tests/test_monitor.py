import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlake.functions import stats as S
from fleetlake.operators import aggregates as AG
from fleetlake.operators import monitor as MON
from fleetlake.operators.summaries import value_cell

DAY = datetime(2024, 1, 1)


def sample(spark, days):
    rows = [(DAY + timedelta(days=d, minutes=i), float(v), "x" if v < 5 else "y", "A") for d, vs in days.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, v double, c string, s string")


def ks(df, **options):
    rows = MON.drift(df, "ts", ["v"], **options).where("slice_key is null").collect()
    return {r.window.start: r.ks_test for r in rows}


@pytest.mark.parametrize("bins", [2, 64])
def test_ks_known_values(spark, bins):
    df = sample(spark, {0: [1, 2, 3, 4], 1: [1, 2, 3, 4], 2: [11, 12, 13], 4: [11, 12], 5: [11, 13]})
    got = ks(df, bins=bins)
    assert set(got) == {DAY + timedelta(days=d) for d in (1, 2, 5)}  # day 0 and day 4 have no day before
    assert got[DAY + timedelta(days=1)].statistic == 0.0 and got[DAY + timedelta(days=1)].pvalue == 1.0
    assert got[DAY + timedelta(days=2)].statistic == 1.0
    assert got[DAY + timedelta(days=5)].statistic == 0.5


@pytest.mark.parametrize("bins", [2, 64])
def test_ks_against_a_baseline(spark, bins):
    df = sample(spark, {0: [1, 2, 3, 4], 1: [11, 12], 2: [2, 3, 9], 3: [0, 0, 0]})
    base = sample(spark, {0: [1, 2, 3, 4]})
    got = ks(df, baseline=base, bins=bins)
    values = [got[DAY + timedelta(days=d)].statistic for d in range(4)]
    assert values == pytest.approx([0.0, 1.0, 1 / 3, 1.0])


def test_ks_hot_value(spark):
    df = sample(spark, {0: [5] * 500 + [1], 1: [5] * 250 + [1] * 250})
    assert ks(df)[DAY + timedelta(days=1)].statistic == pytest.approx(0.5 - 1 / 501)


def test_shifted_rows_spread_over_bins(spark):
    """Values beyond the baseline's range must not fall into one bin, nor change the statistic."""
    base = spark.range(2000).select(F.lit(DAY).cast("timestamp_ntz").alias("ts"), (F.col("id") / 2000).alias("x"))
    moved = spark.range(20_000).select(F.lit(DAY).cast("timestamp_ntz").alias("ts"), (F.col("id") / 1000 + 0.5).alias("x"))
    binned = moved.groupBy(value_cell(F.col("x"), 6)).count().collect()
    assert max(r["count"] for r in binned) < 3 * 20_000 / 64
    row = MON.drift(moved, "ts", ["x"], baseline=base).first()
    assert row.ks_test.statistic == pytest.approx(0.975, abs=0.002)


def test_chi_squared(spark):
    df = sample(spark, {0: [1] * 30 + [9] * 10, 1: [1] * 20 + [9] * 20})
    row = MON.drift(df, "ts", [], ["c"]).first()
    assert row.chi_squared_test.statistic == pytest.approx(5.33333333, abs=1e-8)
    assert row.chi_squared_test.pvalue == pytest.approx(0.0209213, abs=1e-6)
    assert row.ks_test is None and (row.n_ref, row.n_cur) == (40, 40)


def test_pvalues(spark):
    df = spark.createDataFrame([(3.841458820694124, 1), (5.991464547107979, 2), (18.307038053275146, 10), (19.675137572682491, 11), (0.0, 3)], "x double, k int")
    tails = [r[0] for r in df.select(S.chi2_pvalue(F.col("x"), F.col("k"))).collect()]
    assert tails == pytest.approx([0.05, 0.05, 0.05, 0.05, 1.0], abs=1e-9)
    d = spark.createDataFrame([(0.3, 50, 50), (0.0, 5, 5), (1.0, 400, 400)], "d double, a int, b int")
    got = [r[0] for r in d.select(S.ks_pvalue(F.col("d"), F.col("a"), F.col("b"))).collect()]
    root = math.sqrt(25)
    lam = (root + 0.12 + 0.11 / root) * 0.3
    want = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, 101))
    assert got == pytest.approx([want, 1.0, 0.0], abs=1e-12)


def test_profile_merges_windows_and_slices(spark):
    df = sample(spark, {0: [1, 2, 3, None or 4], 1: [7]}).unionByName(
        spark.createDataFrame([(DAY + timedelta(hours=5), None, None, "B")], "ts timestamp_ntz, v double, c string, s string")
    )
    rows = MON.profile(df, "ts", ["v"], ["c"], ("1 hour", "1 day"), ["s"]).collect()
    by = {(r.window.start, r.granularity, r.slice_key, r.slice_value, r.column_name): r for r in rows}
    whole = by[DAY, "1 day", None, None, "v"]
    assert (whole["count"], whole.num_nulls, whole.mean, whole.min, whole.max) == (5, 1, 2.5, 1.0, 4.0)
    assert whole.stddev == pytest.approx(1.2909944487) and whole.percent_null == 20.0 and whole.percent_distinct == 100.0
    empty = by[DAY, "1 day", "s", "B", "v"]
    assert (empty["count"], empty.mean, empty.stddev, empty.percent_distinct) == (1, None, None, None)
    text = by[DAY, "1 day", None, None, "c"]
    assert (text.percent_distinct, text.mean, text.data_type) == (25.0, None, "string")
    for start, grain in {(r.window.start, r.granularity) for r in rows}:
        parts = sum(r["count"] for k, r in by.items() if k[:3] == (start, grain, "s") and k[4] == "v")
        assert parts == by[start, grain, None, None, "v"]["count"]


def test_profile_constant_column_has_no_spread(spark):
    df = sample(spark, {0: [0.1] * 50})
    row = MON.profile(df, "ts", ["v"], granularities=("1 hour", "1 day")).where("granularity = '1 day'").first()
    assert row.stddev == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("bins", [1, 4])
def test_empty_constant_and_nan_columns(spark, bins):
    rows = [(DAY + timedelta(days=i % 2), 7.0, None, math.nan if i == 4 else float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, same double, none double, odd double")
    for baseline in (None, df):
        found = {r.column_name for r in MON.drift(df, "ts", ["same", "none", "odd"], bins=bins, baseline=baseline).collect()}
        assert found == {"same", "odd"}
    means = {
        (r.window.start.day, r.column_name): r.mean
        for r in MON.profile(df, "ts", ["same", "none", "odd"], granularities=("1 day",)).collect()
    }
    assert math.isnan(means[1, "odd"]) and means[2, "odd"] == 10.0 and means[1, "same"] == 7.0 and means[2, "none"] is None


def test_profile_sketch_is_close(spark):
    df = spark.range(5000).select(F.lit(DAY).cast("timestamp_ntz").alias("ts"), (F.col("id") % 1000).cast("double").alias("v"))
    row = MON.profile(df, "ts", ["v"], granularities=("1 day",), distinct="approx").first()
    assert row.percent_distinct == pytest.approx(20.0, rel=0.05)


def test_alerts_and_custom_metrics(spark):
    df = sample(spark, {0: [9] + [1] * 9, 1: [1] * 20})
    metrics = MON.windowed_metrics(df, "ts", ["s"], {"rate": "avg(CASE WHEN v > 5 THEN 1.0D ELSE 0.0D END)"}, ("1 day",))
    rows = {(r.window.start, r.slice_key): (r.rate, r.alert_status) for r in MON.alerts(metrics, "rate", 0.05).collect()}
    assert rows[DAY, None] == (0.1, "ALERT: Anomaly rate exceeds 5%!") and rows[DAY + timedelta(days=1), "s"] == (0.0, "OK")
    with pytest.raises(Exception, match="nope"):
        MON.windowed_metrics(df, "ts", [], {"m": "avg(nope)"}).schema


def test_slices_tell_null_values_from_totals(spark):
    df = spark.createDataFrame([(1, None), (1, "a")], "k int, s string")
    rows = {(r.slice_key, r.slice_value): r.n for r in AG.slice_rows(df, ["s"], ["k"], F.count(F.lit(1)).alias("n")).collect()}
    assert rows == {(None, None): 2, ("s", None): 1, ("s", "a"): 1}


def test_retrain_and_reports(spark):
    df = sample(spark, {0: [1, 2, 3, 4], 1: [1, 2, 3, 4], 2: [11, 12, 13]})
    metrics = MON.drift(df, "ts", ["v"], ["c"])
    flags = {(r.window.start.day, r.column_name): r.retrain for r in MON.retrain_triggers(metrics).collect()}
    assert flags == {(2, "v"): False, (3, "v"): True, (2, "c"): False, (3, "c"): True}
    report = MON.drift_report(metrics, 2).collect()
    assert [r.window.start.day for r in report] == [3, 3]


def test_cohorts_always_give_two_rows(spark):
    df = spark.createDataFrame([("a", 70.0, 75.0), ("a", 72.0, 80.0), (None, 1.0, 1.0)], "cluster_id string, avg_temperature double, max_temperature double")
    rows = {r.period: tuple(r)[1:] for r in MON.compare_cohorts(df, F.col("cluster_id") == "zz").collect()}
    assert rows == {"baseline": (71.0, 1.41, 80.0, 2), "current": (None, None, None, 0)}


def test_share_and_pivot(spark):
    df = spark.createDataFrame([("r", "a", 1.0), ("r", "b", 3.0), ("s", "a", 5.0)], "i string, c string, v double")
    shares = {r.c: r.pct for r in AG.share_of_total(df, F.col("c")).collect()}
    assert shares == {"a": 66.67, "b": 33.33}
    wide = {r.i: (r.a, r.b) for r in AG.pivot_mean(df, "i", "c", "v", ["a", "b"]).collect()}
    assert wide == {"r": (1.0, 3.0), "s": (5.0, None)}
    more = df.union(spark.createDataFrame([("s", "new", 9.0)], df.schema))
    assert AG.pivot_mean(more, "i", "c", "v").columns == ["i", "a", "b", "new"]
    assert {r.i: r.cells for r in AG.pivot_map(more, "i", "c", "v").collect()} == {"r": {"a": 1.0, "b": 3.0}, "s": {"a": 5.0, "new": 9.0}}
    assert AG.positive_rate(df.withColumn("y", (F.col("v") > 2).cast("int")), "y").first().positive_rate == pytest.approx(2 / 3)

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_bins_left_open_are_merged_not_broadcast(spark):
    """Their file is small, their table in memory is not: it must not be built in the driver."""
    rows = spark.range(400).selectExpr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 72 as int)) AS ts", "id % 3 AS s", "sqrt(id * 37 % 101) AS x")
    day = MON.interval_us("1 day")
    for found in (MON._ks_consecutive(rows, "ts", ["x"], ["s"], day, 256), MON._ks_baseline(rows, rows, "ts", ["x"], ["s"], day, 256)):
        assert found.count() > 0
        assert "SortMergeJoin" in plan_of(found) and "BroadcastHashJoin" not in plan_of(found)
