"""Exploration queries over the fleet tables. Inputs are canonical DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.numeric import percent, settle
from fleetlake.operators.aggregates import share_of_total, text_set
from fleetlake.operators.ranking import top_rows


def inventory_listing(inventory: DataFrame) -> DataFrame:
    return inventory.select("*").orderBy("cluster_id")


def clouds(inventory: DataFrame) -> DataFrame:
    """Clusters, GPUs and GPU types per cloud provider."""
    return (
        inventory.groupBy("cloud_provider")
        .agg(
            F.count(F.lit(1)).alias("cluster_count"),
            F.sum("gpu_count").alias("total_gpus"),
            text_set("gpu_type").alias("gpu_types"),
        )
        .orderBy(F.col("cluster_count").desc(), "cloud_provider")
    )


def telemetry_summary(telemetry: DataFrame) -> DataFrame:
    return telemetry.agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.count_distinct("gpu_id").alias("unique_gpus"),
        F.count_distinct("cluster_id").alias("unique_clusters"),
        settle(F.avg("temp_celsius"), 1).alias("avg_temp"),
        settle(F.max("temp_celsius"), 1).alias("max_temp"),
        settle(F.avg("utilization_pct"), 1).alias("avg_utilization"),
        settle(F.avg("power_watts"), 1).alias("avg_power"),
        F.sum("error_count").alias("total_errors"),
    )


def reading_types(telemetry: DataFrame, limit: float = 90.0) -> DataFrame:
    """Share of anomalous readings: strictly above the limit."""
    kind = F.when(F.col("temp_celsius") > limit, "anomalous").otherwise("normal").alias("reading_type")
    return share_of_total(telemetry, kind)


def resolution_rates(events: DataFrame) -> DataFrame:
    resolved = F.sum(F.when(F.col("resolved"), 1).otherwise(0))
    return (
        events.groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            resolved.alias("resolved_count"),
            settle(percent(resolved, F.count(F.lit(1))), 1).alias("resolution_rate_pct"),
        )
        .orderBy(F.col("event_count").desc(), "event_type")
    )


def top_descriptions(events: DataFrame, k: int = 5, weight: str | None = None) -> DataFrame:
    """Most frequent (type, description); `weight` names a count column of already counted rows."""
    hits = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = events.groupBy("event_type", "description").agg(hits.alias("occurrences"))
    return top_rows(counts, k, F.col("occurrences").desc(), "event_type", "description")


def jobs_by_framework(jobs: DataFrame) -> DataFrame:
    def in_state(state):
        return F.sum(F.when(F.col("status") == state, 1).otherwise(0)).alias(state)

    return (
        jobs.groupBy("framework", "model_type")
        .agg(
            F.count(F.lit(1)).alias("job_count"),
            in_state("completed"),
            in_state("failed"),
            in_state("running"),
            settle(F.sum("gpu_hours"), 1).alias("total_gpu_hours"),
            settle(F.sum("cost_usd"), 2).alias("total_cost_usd"),
        )
        .orderBy(F.col("total_cost_usd").desc(), "framework", "model_type")
    )


def costly_jobs(jobs: DataFrame, k: int = 5) -> DataFrame:
    columns = ["job_id", "cluster_id", "framework", "model_type", "gpu_hours", "cost_usd", "status"]
    return top_rows(jobs.select(*columns), k, F.col("cost_usd").desc(), "job_id")


def label_balance(labels: DataFrame, label: str = "is_anomaly") -> DataFrame:
    return share_of_total(labels, F.col(label), count="label_count").orderBy(label)


def training_summary(training: DataFrame) -> DataFrame:
    return training.agg(
        F.count(F.lit(1)).alias("total_windows"),
        F.sum(F.when(F.col("is_anomaly") == 1, 1).otherwise(0)).alias("anomaly_windows"),
        settle(F.avg("reading_count"), 1).alias("avg_readings_per_window"),
        settle(F.avg("avg_temp_celsius"), 1).alias("overall_avg_temp"),
        settle(F.avg("total_error_count"), 2).alias("avg_total_errors"),
    )


def training_by_label(training: DataFrame) -> DataFrame:
    """Feature means per label over windows that have readings."""
    return (
        training.where(F.col("reading_count") > 0)
        .groupBy("is_anomaly")
        .agg(
            F.count(F.lit(1)).alias("window_count"),
            settle(F.avg("avg_temp_celsius"), 1).alias("avg_temp"),
            settle(F.avg("max_temp_celsius"), 1).alias("avg_max_temp"),
            settle(F.avg("avg_utilization_pct"), 1).alias("avg_util"),
            settle(F.avg("avg_power_watts"), 1).alias("avg_power"),
            settle(F.avg("total_error_count"), 2).alias("avg_errors"),
        )
        .orderBy("is_anomaly")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per table; Parquet answers counts from its footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def event_preview(events: DataFrame, k: int = 10) -> DataFrame:
    columns = ["event_id", "cluster_id", "gpu_id", "description", "severity", "timestamp"]
    return top_rows(events.select(*columns), k, "event_id")


def job_preview(jobs: DataFrame, k: int = 10) -> DataFrame:
    return top_rows(jobs.select("job_id", "description", "status", "cluster_id", "start_time"), k, "job_id")
