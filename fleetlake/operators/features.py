"""Feature tables: label windows, hourly, rolling and trailing snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.numeric import finite, interval_us, micros, settle, slot_start
from fleetlake.functions.timing import hour_of, trailing
from fleetlake.operators.joins import divided, hot_groups, repeated

# The metric columns of a reading.
METRICS = ("temp_celsius", "utilization_pct", "memory_used_gb", "power_watts")


def merged_spread(parts: Column) -> Column:
    """Sum of squared deviations of a union from (n, mean, m2) of its parts, pairwise and stable."""
    empty = F.struct(F.lit(0).cast("double").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(total, part):
        n = total["n"] + part["n"]
        gap = part["mean"] - total["mean"]
        share = F.try_divide(part["n"], n)
        return F.when(part["n"] > 0, F.struct(
            n.alias("n"),
            (total["mean"] + gap * share).alias("mean"),
            (total["m2"] + part["m2"] + gap * gap * total["n"] * share).alias("m2"),
        )).otherwise(total)

    return F.aggregate(parts, empty, add)


def label_window_features(
    labels: DataFrame,
    telemetry: DataFrame,
    window: str = "1 hour",
    prefilter: bool = True,
    rows_per_task: int = 10_000_000,
) -> DataFrame:
    """13 aggregates of the readings in [window_start, window_start + window) per labelled window.

    Windows without readings stay, with count 0 and null aggregates. Equal to the range join
    followed by a group-by, but no (label, reading) pair is ever built:

    A window of the slot width covers the tail of one slot and the head of the next. Labels enter
    the slots of their machine as marker rows, one at the window start and one at its end. The
    markers cut a slot into segments; one sorted pass tells each reading its segment, readings are
    aggregated per segment, and running totals over the segments, from both ends, give each start
    marker its tail and each end marker its head. The two parts of a window then merge. Cost is
    linear in readings plus markers, also when one machine holds a large share of both. The
    readings of a slot with more than `rows_per_task` of them are divided over several tasks, each
    with all the markers of the slot, and a window then merges two parts per task.

    `prefilter` drops readings of slots no label touches before they are shuffled, which pays
    while labels cover a part of the fleet; Spark turns it into a map-side lookup when the distinct
    label slots are small enough to broadcast.
    """
    width = interval_us(window)
    grouped = labels.groupBy("gpu_id", "window_start", "is_anomaly").agg(F.count(F.lit(1)).alias("_copies"))
    starts = grouped.select("gpu_id", micros(F.col("window_start")).alias("_start")).distinct()
    tail_slot = slot_start(F.col("_start"), width)
    aligned = F.col("_start") == tail_slot
    ends = F.array(
        F.struct(F.lit(1).alias("mark"), F.col("_start").alias("at"), tail_slot.alias("slot")),
        F.struct(F.lit(2).alias("mark"), (F.col("_start") + width).alias("at"), (tail_slot + width).alias("slot")),
    )
    # An aligned window is exactly one slot; its end marker would open an empty head.
    markers = starts.select(
        "gpu_id",
        "_start",
        F.explode(F.when(aligned, F.slice(ends, 1, 1)).otherwise(ends)).alias("e"),
    ).select("gpu_id", "_start", "e.mark", "e.at", "e.slot")

    rows = telemetry.select("gpu_id", "timestamp", *METRICS, "error_count").where(F.col("timestamp").isNotNull())
    rows = rows.withColumn("at", micros(F.col("timestamp"))).withColumn("slot", slot_start(F.col("at"), width))
    if prefilter:
        rows = rows.join(markers.select("gpu_id", "slot").distinct(), ["gpu_id", "slot"], "left_semi")
    hot = hot_groups(rows.select("gpu_id", "slot"), ["gpu_id", "slot"], rows_per_task)
    stream = (
        divided(rows.drop("timestamp"), hot, ["gpu_id", "slot"], "at")
        .withColumn("mark", F.lit(0))
        .unionByName(repeated(markers, hot, ["gpu_id", "slot"]), allowMissingColumns=True)
    )

    # Markers come before the readings of their instant: a reading at the window start belongs to
    # the window, one at its end does not.
    place = ["gpu_id", "slot", "_salt"]
    in_time = Window.partitionBy(*place).orderBy(F.col("at"), F.col("mark") == 0)
    segment = F.count(F.when(F.col("mark") > 0, 1)).over(in_time.rowsBetween(Window.unboundedPreceding, 0))
    totals = {"n": F.count(F.when(F.col("mark") == 0, 1))}
    for metric in METRICS:
        totals[f"{metric}_n"] = F.count(metric)
        totals[f"{metric}_sum"] = F.sum(metric)
        totals[f"{metric}_max"] = F.max(metric)
    totals["temp_min"] = F.min("temp_celsius")
    totals["err_sum"] = F.sum("error_count")
    totals["err_max"] = F.max("error_count")
    segments = (
        stream.withColumn("segment", segment)
        .groupBy(*place, "segment")
        .agg(
            F.max("mark").alias("mark"),
            F.max("_start").alias("_start"),
            *[total.alias(name) for name, total in totals.items()],
            F.avg("temp_celsius").alias("temp_mean"),
            (F.var_pop("temp_celsius") * F.count("temp_celsius")).alias("temp_m2"),
        )
    )

    # Squares are summed around the mean of the slot, which keeps the spread of close values. A NaN
    # or infinite reading stays out of that mean, so that it spoils no window but its own.
    whole = Window.partitionBy(*place)
    n = F.col("temp_celsius_n")
    usual = finite(F.col("temp_celsius_sum"))
    centre = F.try_divide(F.sum(usual).over(whole), F.sum(F.when(usual.isNotNull(), n)).over(whole))
    off = F.col("temp_mean") - F.coalesce(centre, F.lit(0.0))
    segments = segments.withColumn("temp_off", n * off).withColumn("temp_sq", F.col("temp_m2") + n * off * off)
    head = whole.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    tail = whole.orderBy(F.col("segment").desc()).rowsBetween(Window.unboundedPreceding, 0)

    def part(name: str) -> Column:
        combine = F.max if name.endswith("_max") else F.min if name.endswith("_min") else F.sum
        over = F.when(F.col("mark") == 1, combine(name).over(tail)).when(F.col("mark") == 2, combine(name).over(head))
        return over.alias(name)

    seen = segments.select("gpu_id", "_start", "mark", *[part(name) for name in [*totals, "temp_off", "temp_sq"]]).where(
        F.col("mark") > 0
    )
    spread = F.col("temp_sq") - F.col("temp_off") * F.try_divide("temp_off", "temp_celsius_n")
    temp_part = F.struct(
        F.coalesce(n, F.lit(0)).cast("double").alias("n"),
        F.try_divide("temp_celsius_sum", n).alias("mean"),
        F.when(F.col("temp_min") == F.col("temp_celsius_max"), 0.0).otherwise(F.greatest(spread, F.lit(0.0))).alias("m2"),
    )
    merged = seen.groupBy("gpu_id", "_start").agg(
        F.sum("n").alias("n"),
        *[F.sum(f"{m}_n").alias(f"{m}_n") for m in METRICS],
        *[F.sum(f"{m}_sum").alias(f"{m}_sum") for m in METRICS],
        *[F.max(f"{m}_max").alias(f"{m}_max") for m in METRICS],
        F.min("temp_min").alias("temp_min"),
        F.sum("err_sum").alias("err_sum"),
        F.max("err_max").alias("err_max"),
        merged_spread(F.collect_list(temp_part)).alias("temp"),  # two parts per task of the slot
    )

    found = grouped.withColumn("_start", micros(F.col("window_start"))).join(merged, ["gpu_id", "_start"], "left")
    copies = F.col("_copies")
    n = F.col("temp.n") * copies
    # A label repeated m times meets each reading m times, as in the join it stands for.
    return found.select(
        "gpu_id",
        "window_start",
        "is_anomaly",
        (F.coalesce("n", F.lit(0)) * copies).alias("reading_count"),
        F.try_divide("temp_celsius_sum", "temp_celsius_n").alias("avg_temp_celsius"),
        F.col("temp_celsius_max").alias("max_temp_celsius"),
        F.col("temp_min").alias("min_temp_celsius"),
        F.when(n > 1, F.sqrt(F.col("temp.m2") * copies / (n - 1))).alias("std_temp_celsius"),
        F.try_divide("utilization_pct_sum", "utilization_pct_n").alias("avg_utilization_pct"),
        F.col("utilization_pct_max").alias("max_utilization_pct"),
        F.try_divide("memory_used_gb_sum", "memory_used_gb_n").alias("avg_memory_used_gb"),
        F.col("memory_used_gb_max").alias("max_memory_used_gb"),
        F.try_divide("power_watts_sum", "power_watts_n").alias("avg_power_watts"),
        F.col("power_watts_max").alias("max_power_watts"),
        (F.col("err_sum") * copies).alias("total_error_count"),
        F.col("err_max").alias("max_error_count"),
    )


def hourly_aggregates(memory_gb: float = 80.0, hot: float = 80.0) -> list[Column]:
    """Aggregates of one hour of readings; the batch and the stream table share them."""
    temp = F.col("temp_celsius")
    return [
        F.avg(temp).alias("avg_temp"),
        F.max(temp).alias("max_temp"),
        F.min(temp).alias("min_temp"),
        F.avg("utilization_pct").alias("avg_utilization"),
        F.avg(F.col("memory_used_gb") / memory_gb * 100).alias("avg_memory_pct"),
        F.avg("power_watts").alias("avg_power"),
        F.sum("error_count").alias("error_count_1h"),
        F.stddev_samp(temp).alias("temp_stddev"),
        F.var_samp(temp).alias("temp_variance"),
        F.try_divide(F.count_if(temp > hot).cast("double"), F.count(temp)).alias("high_temp_pct"),
        (F.max(temp) - F.min(temp)).alias("temp_range"),
    ]


def hourly_features(telemetry: DataFrame, memory_gb: float = 80.0, hot: float = 80.0) -> DataFrame:
    """One row per GPU and hour with readings: one scan, one shuffle of combined groups."""
    hour = hour_of(F.col("timestamp")).alias("window_start")
    return telemetry.groupBy("gpu_id", hour).agg(*hourly_aggregates(memory_gb, hot))


def rolling_features(hourly: DataFrame, hours: int = 24) -> DataFrame:
    """Add error_count_24h and util_trend over the current hour and the `hours` - 1 before it.

    The frame is in time, not rows, since hours without readings have no row. util_trend is the
    regression slope of utilization per hour, null until two hours are present. A GPU contributes
    one row per hour of history, so its partition is bounded by the calendar, not by its readings.
    """
    us = micros(F.col("window_start"))
    frame = Window.partitionBy("gpu_id").orderBy(us).rangeBetween(-(hours * 3_600_000_000 - 1), 0)
    return hourly.withColumn("error_count_24h", F.sum("error_count_1h").over(frame)).withColumn(
        "util_trend", F.regr_slope(F.col("avg_utilization"), us / 3_600_000_000).over(frame)
    )


def snapshot_statistics() -> list[Column]:
    """Statistics of a short wide-telemetry window, rounded to two digits as published."""
    temp, util = F.col("temperature_celsius"), F.col("gpu_utilization_pct")
    return [
        F.count(F.lit(1)).alias("reading_count"),
        settle(F.avg(temp), 2).alias("avg_temperature"),
        settle(F.max(temp), 2).alias("max_temperature"),
        settle(F.stddev_samp(temp), 2).alias("stddev_temperature"),
        settle(F.avg(util), 2).alias("avg_utilization"),
        settle(F.max(util), 2).alias("max_utilization"),
        settle(F.avg("memory_utilization_pct"), 2).alias("avg_memory_utilization"),
        settle(F.avg("power_draw_watts"), 2).alias("avg_power_draw"),
        settle(F.max("power_draw_watts"), 2).alias("max_power_draw"),
        F.sum("ecc_errors_single_bit").alias("total_ecc_single_bit"),
        F.sum("ecc_errors_double_bit").alias("total_ecc_double_bit"),
        settle(F.avg("fan_speed_pct"), 2).alias("avg_fan_speed"),
        settle(F.avg("pcie_throughput_gbps"), 2).alias("avg_pcie_throughput"),
    ]


def trailing_snapshot(
    wide: DataFrame, as_of: Column | None = None, window: str = "15 minutes", clock: DataFrame | None = None
) -> DataFrame:
    """Features per (gpu, cluster, model) over the last `window` up to `as_of`.

    `as_of` defaults to the newest timestamp of `clock` (a narrow table such as the raw readings;
    else `wide` itself). Only GPUs with readings in the window appear.
    """
    recent = trailing("timestamp", window, wide if clock is None else clock, as_of)
    bounds = [F.min("timestamp").alias("window_start"), F.max("timestamp").alias("window_end")]
    return wide.where(recent).groupBy("gpu_id", "cluster_id", "gpu_model").agg(*snapshot_statistics(), *bounds)


def stamped(snapshot: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add computed_at: the run's instant, or the wall clock when none is given."""
    return snapshot.withColumn("computed_at", F.current_timestamp() if as_of is None else as_of)
