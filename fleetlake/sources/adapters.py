"""Canonical fleet tables expressed over the star-schema and event tables of a data folder.

Each function is a projection (and at most a key join) over Parquet, so a query that reads two
columns of a fleet table scans only the columns behind those two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.sources.tables import read_table


def reading_columns(ts: str = "ts") -> list[Column]:
    """Telemetry columns over `events`; shared by the batch and the stream form."""
    value = F.col("value")
    return [
        F.col("event_id"),
        F.col("user_id").cast("string").alias("gpu_id"),
        F.col(ts).alias("timestamp"),
        (value % 40 + 65).alias("temp_celsius"),
        (value % 100).alias("utilization_pct"),
        (F.get_json_object("props", "$.k").cast("double") % 80).alias("memory_used_gb"),
        (value / 2 + 200).alias("power_watts"),
        (F.col("event_type") == "error").cast("int").alias("error_count"),
        F.col("event_type"),
    ]


def readings(spark: SparkSession, root: str) -> DataFrame:
    """GPU telemetry without the cluster; needs no join."""
    return read_table(spark, root, "events").select(*reading_columns())


def _place(df: DataFrame, spark: SparkSession, root: str) -> DataFrame:
    """Add cluster_id and gpu_type to rows with a user_id.

    The entity table grows with the fleet, so it is not hinted: Spark broadcasts it while it is
    small and otherwise merges on the key, where adaptive execution splits a hot entity.
    """
    entity = read_table(spark, root, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_nationkey").cast("string").alias("cluster_id"),
        F.col("c_mktsegment").alias("gpu_type"),
    )
    return df.join(entity, "user_id")


def telemetry(spark: SparkSession, root: str) -> DataFrame:
    """gpu_telemetry with cluster_id and gpu_type."""
    placed = _place(read_table(spark, root, "events"), spark, root)
    return placed.select(*reading_columns(), "cluster_id", "gpu_type")


def clusters(spark: SparkSession, root: str) -> DataFrame:
    """Cluster dimension, one row per cluster: id, name and cloud provider."""
    nation = read_table(spark, root, "nation")
    region = read_table(spark, root, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("cluster_id"),
        F.col("n_name").alias("cluster_name"),
        F.col("r_name").alias("cloud_provider"),
    )


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """cluster_inventory with one row per customer, for the listing and the cloud roll-up."""
    customer = read_table(spark, root, "customer")
    nation = read_table(spark, root, "nation")
    region = read_table(spark, root, "region")
    key = F.col("c_custkey")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            key.alias("cluster_id"),
            F.col("c_name").alias("cluster_name"),
            F.col("r_name").alias("cloud_provider"),
            F.col("n_name").alias("region"),
            F.col("c_mktsegment").alias("gpu_type"),
            F.element_at(F.array(F.lit(8), F.lit(16), F.lit(32), F.lit(64)), (key % 4 + 1).cast("int")).alias(
                "gpu_count"
            ),
            F.when(F.col("c_acctbal") < 0, "maintenance").otherwise("active").alias("status"),
        )
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def severity() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "error", "critical")
        .when(kind == "purchase", "error")
        .when(kind == "signup", "warning")
        .otherwise("info")
    )


def _event_text() -> Column:
    """Free text of a health event, written from its type and its counter."""
    kind, k = F.col("event_type"), _k()
    bank = (k % 8).cast("string")
    return (
        F.when(kind == "error", F.concat(F.lit("Uncorrectable ECC memory error on bank "), bank, F.lit(", page retired")))
        .when(kind == "purchase", F.concat(F.lit("Thermal throttle engaged. Fan "), bank, F.lit(" below target speed")))
        .when(kind == "signup", F.concat(F.lit("Network link flapping on port "), bank))
        .when(kind == "click", F.concat(F.lit("Driver crash in kernel module. Exit code "), k.cast("string")))
        .otherwise(F.concat(F.lit("Power supply failure reported by module "), bank))
    )


def health_events(spark: SparkSession, root: str, located: bool = False) -> DataFrame:
    """gpu_health_events as they arrive, knowing only their GPU; `located` adds cluster_id."""
    events = read_table(spark, root, "events")
    if located:
        events = _place(events, spark, root)
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("gpu_id"),
        *(["cluster_id"] if located else []),
        "event_type",
        severity().alias("severity"),
        _event_text().alias("description"),
        F.col("ts").alias("timestamp"),
        (_k() % 2 == 0).alias("resolved"),
    )


def part_event_counts(spark: SparkSession, root: str) -> DataFrame:
    """Health events in their line-item form, counted: (event_type, description, n).

    Lines are counted per (flag, part) before the join, so a part with very many lines reaches
    the join as a few rows.
    """
    counts = (
        read_table(spark, root, "lineitem")
        .groupBy(F.col("l_returnflag").alias("event_type"), "l_partkey")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    part = read_table(spark, root, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("description"))
    return counts.join(part, "l_partkey").select("event_type", "description", "n")


def line_events(spark: SparkSession, root: str) -> DataFrame:
    """Type and resolution flag only; no join."""
    return read_table(spark, root, "lineitem").select(
        F.col("l_returnflag").alias("event_type"), (F.col("l_linestatus") == "F").alias("resolved")
    )


def jobs(spark: SparkSession, root: str, rows: DataFrame | None = None) -> DataFrame:
    """ml_job_runs over orders; gpu_hours is the summed quantity of the order's lines.

    The lines are summed per order before the join, so a job with very many lines reaches the
    join as one row. Given a few `rows` of jobs, only their lines are summed.
    """
    lines = read_table(spark, root, "lineitem").select(F.col("l_orderkey").cast("string").alias("job_id"), "l_quantity")
    if rows is not None:
        lines = lines.join(rows.select("job_id"), "job_id", "left_semi")
    hours = lines.groupBy("job_id").agg(F.sum("l_quantity").alias("gpu_hours"))
    runs = job_rows(spark, root) if rows is None else rows
    return runs.join(hours, "job_id", "left").withColumn("gpu_hours", F.coalesce("gpu_hours", F.lit(0.0)))


def job_rows(spark: SparkSession, root: str) -> DataFrame:
    """ml_job_runs without gpu_hours; no join."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    model = F.concat(F.lit("m"), (customer % 7).cast("string"))
    framework = F.col("o_orderpriority")
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "running").otherwise("failed")
    )
    objective = F.element_at(
        F.array(F.lit("classification"), F.lit("ranking"), F.lit("generation")), (order % 3 + 1).cast("int")
    )
    hours = F.make_interval(hours=(order % 72 + 1).cast("int"))
    return read_table(spark, root, "orders").select(
        order.cast("string").alias("job_id"),
        customer.cast("string").alias("cluster_id"),
        framework.alias("framework"),
        model.alias("model_type"),
        F.concat(
            F.lit("Fine-tuning a "),
            (customer % 70 + 1).cast("string"),
            F.lit("B "),
            model,
            F.lit(" model with "),
            framework,
            F.lit(" on dataset set-"),
            (order % 12).cast("string"),
            F.lit(" for "),
            objective,
        ).alias("description"),
        F.col("o_orderdate").alias("start_time"),
        F.when(status != "running", F.col("o_orderdate") + hours).alias("end_time"),
        status.alias("status"),
        F.col("o_totalprice").alias("cost_usd"),
    )


def labels(spark: SparkSession, root: str) -> DataFrame:
    """gpu_anomaly_labels: each sign-up opens a labelled window at its own instant."""
    return (
        read_table(spark, root, "events")
        .where(F.col("event_type") == "signup")
        .select(
            F.col("user_id").cast("string").alias("gpu_id"),
            F.col("ts").alias("window_start"),
            (F.col("value") > 150).cast("int").alias("is_anomaly"),
        )
    )


def label_readings(spark: SparkSession, root: str) -> DataFrame:
    """Readings to join to the labels: everything that is not itself a label."""
    return readings(spark, root).where(F.col("event_type") != "signup")


def hour_labels(spark: SparkSession, root: str) -> DataFrame:
    """Labels aligned to the hour, one per GPU and hour (anomalous if any label in it is)."""
    from fleetlake.functions.timing import hour_of

    return (
        labels(spark, root)
        .groupBy("gpu_id", hour_of(F.col("window_start")).alias("window_start"))
        .agg(F.max("is_anomaly").alias("is_anomaly"))
    )


def predictions(spark: SparkSession, root: str) -> DataFrame:
    """model_predictions: an event is a scored reading, positive when it is an error."""
    placed = _place(read_table(spark, root, "events"), spark, root)
    return placed.select(
        F.col("ts").alias("prediction_timestamp"),
        "cluster_id",
        "gpu_type",
        (F.col("value") % 40 + 65).alias("avg_temp"),
        (F.col("value") % 100).alias("avg_utilization"),
        (F.col("event_type") == "error").cast("int").alias("prediction"),
        (F.col("value") / 500).alias("score"),
    )


def wide_telemetry(spark: SparkSession, root: str) -> DataFrame:
    """Telemetry in its wide spelling, with fan, link and memory-error counters."""
    placed = _place(read_table(spark, root, "events"), spark, root)
    return placed.select(*wide_columns(), "cluster_id", F.col("gpu_type").alias("gpu_model"))


def wide_columns(ts: str = "ts") -> list[Column]:
    value = F.col("value")
    return [
        F.col("event_id").cast("string").alias("event_id"),
        F.col(ts).alias("timestamp"),
        F.col("user_id").cast("string").alias("gpu_id"),
        (value % 40 + 65).alias("temperature_celsius"),
        (value % 100).alias("gpu_utilization_pct"),
        (_k().cast("double") % 80 / 80 * 100).alias("memory_utilization_pct"),
        (value / 2 + 200).alias("power_draw_watts"),
        (value % 60 + 40).alias("fan_speed_pct"),
        (F.col("event_type") == "error").cast("int").alias("ecc_errors_single_bit"),
        ((F.col("event_type") == "error") & (value > 150)).cast("int").alias("ecc_errors_double_bit"),
        (value % 5 + 20).alias("pcie_throughput_gbps"),
    ]


def questions(spark: SparkSession, root: str) -> DataFrame:
    """User turns of the conversations."""
    return read_table(spark, root, "conversations").where(F.col("role") == "user").select("conv_id", "turn", "text")
