"""Readers: tables, literal rows, generated rows, document folders and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.schemas import table_schemas


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet table `name` below a folder; columns and filters are pruned by the optimizer."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_stream(spark: SparkSession, root: str, name: str, ts: str | None = None, **options) -> DataFrame:
    """The same table as a file stream: the parts of its folder as they arrive, or its one file.

    `ts` is turned into the zoned type, because event-time watermarks do not take the zone-less
    one; this is the only place where that cast happens.
    """
    path = f"{root.rstrip('/')}/{name}.parquet"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(read_table(spark, root, name).schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    if files.getFileStatus(place).isDirectory():
        stream = reader.parquet(path)
    else:
        stream = reader.option("pathGlobFilter", f"{name}.parquet").parquet(root)
    return stream.withColumn(ts, F.col(ts).cast("timestamp")) if ts else stream


def rows_to_table(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """Literal rows with an explicit schema, for small hand-fed inputs such as a spike of readings."""
    return spark.createDataFrame(rows, schema)


def list_files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of the files in a folder; the contents are not read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).select("path", "length", "modificationTime")


def read_documents(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """(doc_name, text), one row per file whose name ends with `suffix`."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("doc_name"),
        F.col("content").cast("string").alias("text"),
    )


def with_suffix(files: DataFrame, column: str, suffix: str) -> DataFrame:
    return files.where(F.col(column).endswith(suffix))


def register_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def monitoring_baseline(
    spark: SparkSession, rows: int = 100, start: str = "2026-04-01 00:00:00", clusters: int = 3, seed: int = 42
) -> DataFrame:
    """Generated baseline predictions: one row per hour, clusters in turn, about 5% positive.

    Seeded, so a rerun gives the same rows.
    """
    n = F.col("id")
    generated = spark.range(rows).select(
        F.expr(f"timestampadd(HOUR, id, TIMESTAMP_NTZ '{start}')")
        .cast("timestamp_ntz")
        .alias("prediction_timestamp"),
        F.concat(F.lit("cluster_"), (n % clusters + 1).cast("string")).alias("cluster_id"),
        F.lit("A100").alias("gpu_type"),
        (F.rand(seed) * 20 + 60).alias("avg_temp"),
        (F.rand(seed + 1) * 0.5 + 0.5).alias("avg_utilization"),
        (F.rand(seed + 2) > 0.95).cast("int").alias("prediction"),
    )
    return generated.select(*table_schemas()["model_monitoring_baseline"].names)
