"""Windowed features of a stream that any later row corrects.

No watermark and no state: each batch is reduced to moments per key and window (count, sum, extremes, mean and
squares around it), which are appended to a log, and moments of one window add up whatever their order
and delay. The table is the log's sum, so it equals the batch table over all rows that have arrived. A batch
costs its own rows; `compact` folds a long log into one batch, from which it goes on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.functions.numeric import settle

Sink = Callable[[DataFrame, int], None]

HOURLY = {
    "temp": "temp_celsius",
    "util": "utilization_pct",
    "memory": "memory_used_gb / 80.0D * 100",
    "power": "power_watts",
    "errors": "error_count",
    "hot": "CASE WHEN temp_celsius > 80 THEN 1 END",
}
SNAPSHOT = {
    "temp": "temperature_celsius",
    "util": "gpu_utilization_pct",
    "memory": "memory_utilization_pct",
    "power": "power_draw_watts",
    "single": "ecc_errors_single_bit",
    "double": "ecc_errors_double_bit",
    "fan": "fan_speed_pct",
    "pcie": "pcie_throughput_gbps",
}


def moments(measures: dict[str, str], ts: str) -> list[Column]:
    """Mergeable aggregates of every measure, the number of rows and the bounds of their times."""
    found = [F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first"), F.max(ts).alias("last")]
    for name, text in measures.items():
        x = F.expr(text)
        found += [F.count(x).alias(f"{name}_n"), F.sum(x).alias(f"{name}_sum"), F.min(x).alias(f"{name}_min"), F.max(x).alias(f"{name}_max")]
        found += [F.avg(x).alias(f"{name}_mean"), (F.var_pop(x) * F.count(x)).alias(f"{name}_m2")]
    return found


def merged_moments(log: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One row of moments per key; squares are moved to the common mean before they are added."""
    own = Window.partitionBy(*keys)
    centred = {}
    for name in names:
        n, mean = F.col(f"{name}_n"), F.col(f"{name}_mean")
        centre = F.try_divide(F.sum(n * mean).over(own), F.sum(n).over(own))
        centred[f"{name}_centre"] = centre
        centred[f"{name}_m2"] = F.col(f"{name}_m2") + n * (mean - centre) * (mean - centre)
    out = [F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last")]
    for name in names:
        out += [F.sum(f"{name}_n").alias(f"{name}_n"), F.sum(f"{name}_sum").alias(f"{name}_sum"), F.min(f"{name}_min").alias(f"{name}_min")]
        out += [F.max(f"{name}_max").alias(f"{name}_max"), F.max(f"{name}_centre").alias(f"{name}_mean"), F.sum(f"{name}_m2").alias(f"{name}_m2")]
    return log.withColumns(centred).groupBy(*keys).agg(*out)


def correcting_sink(base: str, measures: dict[str, str], ts: str = "timestamp", window: str = "1 hour", keys: tuple[str, ...] = ("gpu_id",)) -> Sink:
    """foreachBatch function: add the moments of each batch of raw rows to the log at `base`.

    A batch writes its own folder, so a replayed batch replaces what it wrote before.
    """

    def write(batch: DataFrame, number: int) -> None:
        found = batch.groupBy(*keys, F.window(ts, window).alias("_window")).agg(*moments(measures, ts))
        rows = found.withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}).drop("_window")
        rows.write.mode("overwrite").parquet(f"{base}/batch={number}")

    return write


def corrected_windows(spark: SparkSession, base: str, measures: dict[str, str], keys: tuple[str, ...] = ("gpu_id",)) -> DataFrame:
    """The moments of every key and window over all rows so far."""
    log = spark.read.parquet(base).drop("batch")
    return merged_moments(log, [*keys, "window_start", "window_end"], list(measures))


def compact(spark: SparkSession, base: str, measures: dict[str, str], to: str, keys: tuple[str, ...] = ("gpu_id",)) -> None:
    """Write the log's sum as batch -1 of a new log at `to`; a sink goes on there with its numbered batches."""
    corrected_windows(spark, base, measures, keys).write.mode("overwrite").parquet(f"{to}/batch=-1")


def _mean(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum").cast("double"), F.col(f"{name}_n"))


def _variance(name: str) -> Column:
    n = F.col(f"{name}_n")
    return F.when(n > 1, F.col(f"{name}_m2") / (n - 1))


def hourly_table(windows: DataFrame) -> DataFrame:
    """The hourly feature table from moments of HOURLY."""
    return windows.select(
        "gpu_id",
        "window_start",
        _mean("temp").alias("avg_temp"),
        F.col("temp_max").alias("max_temp"),
        F.col("temp_min").alias("min_temp"),
        _mean("util").alias("avg_utilization"),
        _mean("memory").alias("avg_memory_pct"),
        _mean("power").alias("avg_power"),
        F.col("errors_sum").alias("error_count_1h"),
        F.sqrt(_variance("temp")).alias("temp_stddev"),
        _variance("temp").alias("temp_variance"),
        F.try_divide(F.col("hot_n").cast("double"), F.col("temp_n")).alias("high_temp_pct"),
        (F.col("temp_max") - F.col("temp_min")).alias("temp_range"),
    )


def snapshot_table(windows: DataFrame) -> DataFrame:
    """The 15-minute feature table from moments of SNAPSHOT."""
    return windows.select(
        "gpu_id",
        "window_start",
        "window_end",
        F.col("rows").alias("reading_count"),
        settle(_mean("temp"), 2).alias("avg_temperature"),
        settle(F.col("temp_max"), 2).alias("max_temperature"),
        settle(F.sqrt(_variance("temp")), 2).alias("stddev_temperature"),
        settle(_mean("util"), 2).alias("avg_utilization"),
        settle(F.col("util_max"), 2).alias("max_utilization"),
        settle(_mean("memory"), 2).alias("avg_memory_utilization"),
        settle(_mean("power"), 2).alias("avg_power_draw"),
        settle(F.col("power_max"), 2).alias("max_power_draw"),
        F.col("single_sum").alias("total_ecc_single_bit"),
        F.col("double_sum").alias("total_ecc_double_bit"),
        settle(_mean("fan"), 2).alias("avg_fan_speed"),
        settle(_mean("pcie"), 2).alias("avg_pcie_throughput"),
        F.col("first").alias("first_reading"),
        F.col("last").alias("last_reading"),
    )
