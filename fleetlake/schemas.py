"""Canonical table schemas, column aliases and the table contract check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
}


def _table(**columns: str) -> T.StructType:
    """`name='type'` is required, `name='type?'` is nullable."""
    return T.StructType(
        [
            T.StructField(name, _TYPES[spec.rstrip("?")], spec.endswith("?"))
            for name, spec in columns.items()
        ]
    )


# The column names and types of the fleet tables.
def table_schemas() -> dict[str, T.StructType]:
    return {
        "cluster_inventory": _table(
            cluster_id="string",
            cloud_provider="string",
            region="string",
            gpu_type="string",
            gpu_count="int",
            status="string",
        ),
        "gpu_telemetry": _table(
            gpu_id="string",
            cluster_id="string",
            timestamp="timestamp",
            temp_celsius="double",
            utilization_pct="double",
            memory_used_gb="double",
            power_watts="double",
            error_count="int",
        ),
        "gpu_health_events": _table(
            event_id="string",
            gpu_id="string",
            event_type="string",
            description="string",
            timestamp="timestamp",
            resolved="boolean",
        ),
        "ml_job_runs": _table(
            job_id="string",
            cluster_id="string",
            framework="string",
            model_type="string",
            description="string",
            start_time="timestamp",
            end_time="timestamp?",
            gpu_hours="double",
            status="string",
            cost_usd="double",
        ),
        "gpu_anomaly_labels": _table(gpu_id="string", window_start="timestamp", is_anomaly="int"),
        "gpu_runbook_chunks": _table(
            chunk_id="bigint", doc_name="string", chunk_index="int", content="string"
        ),
        "gpu_health_features": _table(
            gpu_id="string",
            window_start="timestamp",
            avg_temp="double?",
            max_temp="double?",
            min_temp="double?",
            avg_utilization="double?",
            avg_memory_pct="double?",
            avg_power="double?",
            error_count_1h="bigint?",
            error_count_24h="bigint?",
            temp_stddev="double?",
            temp_variance="double?",
            temp_range="double?",
            high_temp_pct="double?",
            util_trend="double?",
        ),
        "model_monitoring_baseline": _table(
            prediction_timestamp="timestamp?",
            cluster_id="string?",
            gpu_type="string?",
            avg_temp="double?",
            avg_utilization="double?",
            prediction="int?",
        ),
        "wide_telemetry": _table(
            event_id="string",
            timestamp="timestamp",
            cluster_id="string",
            gpu_id="string",
            gpu_model="string",
            temperature_celsius="double",
            gpu_utilization_pct="double",
            memory_utilization_pct="double",
            power_draw_watts="double",
            fan_speed_pct="double",
            ecc_errors_single_bit="int",
            ecc_errors_double_bit="int",
            pcie_throughput_gbps="double",
        ),
    }


# Other spellings of the canonical columns.
COLUMN_ALIASES = {
    "temperature_celsius": "temp_celsius",
    "temperature_c": "temp_celsius",
    "gpu_utilization_pct": "utilization_pct",
    "power_draw_watts": "power_watts",
    "ecc_errors": "error_count",
    "ecc_errors_single_bit": "error_count",
    "event_description": "description",
    "event_timestamp": "timestamp",
    "event_time": "timestamp",
    "gpu_model": "gpu_type",
    "gpu_hours_consumed": "gpu_hours",
}


def canonicalise(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Rename aliased columns to the canonical spelling, unless that column is there already."""
    aliases = COLUMN_ALIASES if aliases is None else aliases
    present = set(df.columns)
    renames = {}
    for name in df.columns:
        target = aliases.get(name)
        if target and target not in present and target not in renames.values():
            renames[name] = target
    return df.withColumnsRenamed(renames)


def check_contract(df: DataFrame, schema: T.StructType, keys: list[str] | None = None) -> DataFrame:
    """Violations of a declared table as rows (rule, column_name, violations); empty when sound.

    Null counts of all required columns come from one aggregate over one scan; key uniqueness is
    a count per key, which combines on the map side, so one repeated key is not a hot task.
    """
    actual = {field.name: field.dataType for field in df.schema}
    zone_types = (T.TimestampType(), T.TimestampNTZType())

    def type_matches(want, have):
        return want == have or (want in zone_types and have in zone_types)

    found = []
    for field in schema:
        if field.name not in actual:
            found.append(("missing_column", field.name, 1))
        elif not type_matches(field.dataType, actual[field.name]):
            found.append(("type_mismatch", field.name, 1))
    spark = df.sparkSession
    report = spark.createDataFrame(found, "rule string, column_name string, violations bigint")

    required = [f.name for f in schema if not f.nullable and f.name in actual]
    if required:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        pairs = F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in required]
            )
        )
        nulls = nulls.select(pairs.alias("p")).select(
            F.lit("null_value").alias("rule"), "p.column_name", "p.violations"
        )
        report = report.unionByName(nulls)
    if keys:
        repeated = (
            df.groupBy(*keys)
            .agg(F.count("*").alias("copies"))
            .where(F.col("copies") > 1)
            .agg(F.count("*").alias("violations"))
            .select(
                F.lit("duplicate_key").alias("rule"),
                F.lit(",".join(keys)).alias("column_name"),
                "violations",
            )
        )
        report = report.unionByName(repeated)
    return report.where(F.col("violations") > 0)
