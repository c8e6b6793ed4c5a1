"""Dashboard queries: pickers, tiles, heatmap, time series, alerts, and the analysts' questions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.numeric import settle
from fleetlake.functions.timing import all_of, between_dates, chosen, hour_of, trailing
from fleetlake.operators.aggregates import pivot_mean
from fleetlake.operators.joins import with_dimension
from fleetlake.operators.ranking import top_rows


@dataclass(frozen=True)
class Filters:
    """Sidebar choices. None or 'All' leaves a filter out; values are literals, never SQL text."""

    start: str | None = None
    end: str | None = None
    cluster: str | None = None
    provider: str | None = None

    def condition(self, ts: str) -> Column:
        dates = between_dates(ts, self.start, self.end) if self.start and self.end else None
        return all_of(dates, chosen("cluster_name", self.cluster), chosen("cloud_provider", self.provider))


def cluster_options(inventory: DataFrame) -> DataFrame:
    return inventory.select("cluster_id", "cluster_name").distinct().orderBy("cluster_name")


def provider_options(inventory: DataFrame) -> DataFrame:
    return inventory.select("cloud_provider").distinct().orderBy("cloud_provider")


def _filtered(facts: DataFrame, clusters: DataFrame, filters: Filters) -> DataFrame:
    return with_dimension(facts, clusters).where(filters.condition("timestamp"))


def tiles(telemetry: DataFrame, events: DataFrame, clusters: DataFrame, filters: Filters) -> DataFrame:
    """One row: GPUs, mean utilization and temperature, and active alerts."""
    kpi = _filtered(telemetry, clusters, filters).agg(
        F.count_distinct("gpu_id").alias("total_gpus"),
        settle(F.avg("utilization_pct"), 1).alias("avg_utilization"),
        settle(F.avg("temp_celsius"), 1).alias("avg_temperature"),
    )
    return kpi.withColumn("active_alerts", active_alerts(events, clusters, filters).scalar())


def active_alerts(events: DataFrame, clusters: DataFrame, filters: Filters) -> DataFrame:
    urgent = F.col("severity").isin("critical", "warning")
    return _filtered(events.where(urgent), clusters, filters).agg(F.count(F.lit(1)).alias("active_alerts"))


def heatmap(telemetry: DataFrame, clusters: DataFrame, filters: Filters, *also: str) -> DataFrame:
    """Mean utilization and temperature per cluster and GPU (and further columns of the GPU)."""
    return (
        _filtered(telemetry, clusters, filters)
        .groupBy("cluster_name", "gpu_id", *also)
        .agg(settle(F.avg("utilization_pct"), 1).alias("avg_util"), settle(F.avg("temp_celsius"), 1).alias("avg_temp"))
        .orderBy("cluster_name", "gpu_id")
    )


def heatmap_matrix(rows: DataFrame, columns: str, names: list | None = None) -> DataFrame:
    """Clusters down, `columns` across, mean of the heatmap's avg_util in the cells."""
    return pivot_mean(rows, "cluster_name", columns, "avg_util", names)


def temperature_series(telemetry: DataFrame, clusters: DataFrame, filters: Filters) -> DataFrame:
    return (
        _filtered(telemetry, clusters, filters)
        .groupBy(hour_of(F.col("timestamp")).alias("time_bucket"), "cluster_name")
        .agg(settle(F.avg("temp_celsius"), 1).alias("avg_temp"), settle(F.max("temp_celsius"), 1).alias("max_temp"))
        .orderBy("time_bucket", "cluster_name")
    )


def recent_alerts(events: DataFrame, clusters: DataFrame, filters: Filters, k: int = 50) -> DataFrame:
    columns = ["timestamp", "cluster_name", "gpu_id", "severity", "event_type", "description", "event_id"]
    return top_rows(
        _filtered(events, clusters, filters).select(*columns), k, F.col("timestamp").desc(), "event_id"
    )


def hottest_clusters(telemetry: DataFrame, clock: DataFrame, as_of: Column | None = None, span: str = "24 hours", k: int = 10) -> DataFrame:
    recent = telemetry.where(trailing("timestamp", span, clock, as_of))
    means = recent.groupBy("cluster_id").agg(settle(F.avg("temp_celsius"), 8).alias("avg_temp"))
    return top_rows(means, k, F.col("avg_temp").desc(), "cluster_id")


def most_errors(telemetry: DataFrame, clock: DataFrame, as_of: Column | None = None, span: str = "7 days", k: int = 1) -> DataFrame:
    recent = telemetry.where(trailing("timestamp", span, clock, as_of))
    sums = recent.groupBy("cluster_id").agg(F.sum("error_count").alias("total_errors"))
    return top_rows(sums, k, F.col("total_errors").desc(), "cluster_id")


def provider_utilization(telemetry: DataFrame, clusters: DataFrame, provider: str) -> DataFrame:
    chosen_clusters = clusters.where(F.col("cloud_provider") == provider)
    return with_dimension(telemetry, chosen_clusters).agg(
        settle(F.avg("utilization_pct"), 8).alias("avg_utilization"), F.count(F.lit(1)).alias("readings")
    )


def longest_jobs(jobs: DataFrame, k: int = 10) -> DataFrame:
    return top_rows(jobs.select("job_id", "framework", "gpu_hours", "cost_usd"), k, F.col("gpu_hours").desc(), "job_id")


def anomalous_gpus(telemetry: DataFrame, cluster: str, limit: float = 90.0) -> DataFrame:
    """GPUs of one cluster with readings above the limit, and the means of those readings."""
    hot = telemetry.where((F.col("cluster_id") == cluster) & (F.col("temp_celsius") > limit))
    return hot.agg(
        F.count_distinct("gpu_id").alias("anomalous_gpus"),
        settle(F.avg("temp_celsius"), 8).alias("avg_temp"),
        settle(F.avg("utilization_pct"), 8).alias("avg_utilization"),
    )


def thermal_warnings(telemetry: DataFrame, limit: float = 83.0, busy: float = 80.0) -> DataFrame:
    """GPUs with a reading above the throttling limit, and those that were also highly utilized then."""
    warm = telemetry.where(F.col("temp_celsius") > limit)
    return warm.agg(
        F.count_distinct("gpu_id").alias("gpus_in_warning"),
        F.count_distinct(F.when(F.col("utilization_pct") > busy, F.col("gpu_id"))).alias("gpus_in_warning_and_busy"),
        F.count(F.lit(1)).alias("readings_in_warning"),
    )
