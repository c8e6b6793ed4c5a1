"""Keyed upsert and snapshot difference on plain Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.session import scratch_dir


def unique_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _row) with the other columns in one struct; the job fails on a repeated key.

    The count per key runs in the aggregate that the following join on the same keys needs
    anyway as its shuffle, so the check costs no extra exchange.
    """
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), F.first(F.struct(F.lit(True).alias("_present"), *rest)).alias("_row")
    )
    message = F.concat(F.lit("duplicate source key: "), F.to_json(F.struct(*keys)))
    return grouped.select(
        *keys, F.when(F.col("_copies") > 1, F.raise_error(message)).otherwise(F.col("_row")).alias("_row")
    )


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """New state of `target`: matched keys take the source row, new keys are added, others stay.

    Columns missing on one side are null there, so the source may carry a wider or a narrower
    feature set. Publish the result as a new version; do not overwrite the files being read.
    """
    columns = target.columns + [c for c in source.columns if c not in target.columns]
    rest = [c for c in columns if c not in keys]
    old_rest = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(F.lit(True).alias("_present"), *old_rest).alias("_old"))
    joined = old.join(unique_rows(source, keys), keys, "full_outer")
    from_source = F.col("_row").isNotNull()

    def pick(name):
        new = F.col(f"_row.{name}") if name in source.columns else F.lit(None)
        kept = F.col(f"_old.{name}") if name in target.columns else F.lit(None)
        return F.when(from_source, new).otherwise(kept).alias(name)

    return joined.select(*keys, *[pick(c) for c in rest])


def upsert_partitions(path: str, source: DataFrame, keys: list[str], partition: str) -> None:
    """Upsert into a table partitioned by `partition`, rewriting only the partitions `source` touches.

    `partition` must follow from the key, such as the date of window_start; null is a partition like
    any other. It is read with the source's type, since folder names alone do not tell a text from a
    number. The new partitions are staged first, so the job that replaces them does not read what it
    overwrites, and a failed replace can be rerun.
    """
    spark = source.sparkSession
    kind = source.schema[partition].dataType
    stored = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(f.name, kind if f.name == partition else f.dataType) for f in stored])
    touched = source.select(F.col(partition).alias("_touched")).distinct()
    table = spark.read.schema(schema).parquet(path)
    target = table.join(touched, table[partition].eqNullSafe(touched["_touched"]), "left_semi")
    staged = scratch_dir(spark, "upsert")
    upsert(target, source, keys).write.parquet(staged)
    (
        spark.read.parquet(staged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def diff_snapshots(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Change rows from one snapshot to the next: the row plus `_change`.

    insert and update carry the new values, delete the old ones; unchanged rows are left out.
    Values are compared null-safe as whole structs, so no hash collision can hide a change.
    """
    rest = [c for c in new.columns if c not in keys]
    was = old.select(*keys, F.struct(F.lit(True).alias("_present"), *rest).alias("_old"))
    now = new.select(*keys, F.struct(F.lit(True).alias("_present"), *rest).alias("_new"))
    both = was.join(now, keys, "full_outer")
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    return (
        both.withColumn("_change", change)
        .where(F.col("_change").isNotNull())
        .withColumn("_row", F.coalesce("_new", "_old"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest], "_change")
    )


def apply_changes(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """A snapshot with its change rows applied: drop every changed key, add the new rows back."""
    kept = table.join(changes.select(*keys), keys, "left_anti")
    added = changes.where(F.col("_change") != "delete").drop("_change")
    return kept.unionByName(added, allowMissingColumns=True)
