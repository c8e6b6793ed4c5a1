"""Writers, table housekeeping and atomic table versions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.session import scratch_dir


def overwrite(df: DataFrame, path: str) -> None:
    """Full refresh; running it twice leaves the same table. The new schema replaces the old."""
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_counted(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write and return the number of rows written, measured during the write itself."""
    seen = Observation("written")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return seen.get["rows"]


def evolved(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Old and new rows under the union of both schemas; columns one side lacks are null there."""
    return current.unionByName(incoming, allowMissingColumns=True)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in the declared order; missing ones are null, types are cast."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def preview(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """First rows in a defined order; a heap per task, never a full sort."""
    return df.orderBy(*order).limit(rows)


def ensure_schema(spark: SparkSession, name: str, use: bool = False) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """Managed Parquet table; returns it as read back, so later steps do not rerun the plan."""
    df.write.mode(mode).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def save_scratch(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the scratch folder and read back, for a plan that uses it several times."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def latest_version(spark: SparkSession, base: str) -> int | None:
    """Highest version folder below `base`, or None before the first. A version may hold no rows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    names = [entry.getPath().getName() for entry in files.listStatus(folder) if entry.isDirectory()]
    return max((int(n[8:]) for n in names if re.fullmatch(r"version=\d+", n)), default=None)


def read_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    chosen = latest_version(spark, base) if version is None else version
    return spark.read.parquet(f"{base}/version={chosen}")


def publish(df: DataFrame, base: str) -> int:
    """Write the next version of a table and return its number.

    A plan may read version n while it writes n + 1, so a read-modify-write never overwrites its
    own input, and a failed write shows nothing: files appear when the job commits.
    """
    version = (latest_version(df.sparkSession, base) or 0) + 1
    df.write.mode("errorifexists").parquet(f"{base}/version={version}")
    return version


def latest_numeric_version(versions: DataFrame, name: str, version: str) -> DataFrame:
    """Newest version per name where versions are text: '10' is newer than '9'."""
    return versions.groupBy(name).agg(F.max(F.col(version).cast("bigint")).alias("latest_version"))


def absent_from(wanted: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """What has to be created: rows of `wanted` whose key does not exist yet. A rerun gives none."""
    return wanted.join(existing.select(*keys), keys, "left_anti")
