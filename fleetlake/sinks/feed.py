"""Tables whose changes are recorded when they are written, and a data source that streams them.

A table is a folder of numbered versions (`version=1`, ...) with a folder `changes/version=n` beside each: the
rows by which version n differs from n - 1, with `_change`. Changes come from the join that makes the new
version, not from comparing two snapshots afterwards. A version counts once both folders carry the
`_SUCCESS` marker of a finished job; the changes are written first.

`fleet_changes` reads them, in batch or as a stream whose offsets are versions, so a consumer goes on
where its checkpoint ends and sees every version once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from fleetlake.session import scratch_dir
from fleetlake.sinks.changes import unique_rows
from fleetlake.sinks.tables import latest_version, read_version


def _write_version(rows: DataFrame, keys: list[str], base: str, version: int) -> int:
    """Rows are (keys, _old, _new); staged once, for the changes and the version both read them."""
    spark = rows.sparkSession
    staged = scratch_dir(spark, "staged")
    rows.write.parquet(staged)
    both = spark.read.schema(rows.schema).parquet(staged)
    change = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
    change = change.when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    names = [n for n in rows.schema["_new"].dataType.names if n != "_present"]
    picked = F.coalesce("_new", "_old")
    changed = both.withColumn("_change", change).where(F.col("_change").isNotNull())
    told = changed.select(*keys, *[picked[n].alias(n) for n in names], "_change")
    told.write.mode("overwrite").parquet(f"{base}/changes/version={version}")
    kept = both.where(F.col("_new").isNotNull()).select(*keys, *[F.col(f"_new.{n}").alias(n) for n in names])
    kept.write.mode("errorifexists").parquet(f"{base}/version={version}")
    return version


def _present(df: DataFrame, keys: list[str], name: str, columns: list[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema}
    rest = [(F.col(c) if c in kinds else F.lit(None)).alias(c) for c in columns if c not in keys]
    return df.select(*keys, F.struct(F.lit(True).alias("_present"), *rest).alias(name))


def _both(df: DataFrame, base: str, keys: list[str], whole: bool) -> tuple[DataFrame, int]:
    spark = df.sparkSession
    version = latest_version(spark, base) or 0
    old = read_version(spark, base, version) if version else df.limit(0)
    columns = df.columns if whole else [*old.columns, *[c for c in df.columns if c not in old.columns]]
    for name in columns:  # a column that one side lacks is null there, with the other side's type
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(old.schema[name].dataType))
        if name not in old.columns:
            old = old.withColumn(name, F.lit(None).cast(df.schema[name].dataType))
    now = unique_rows(df.select(*columns), keys).withColumnRenamed("_row", "_new")
    was = _present(old.select(*columns), keys, "_old", columns).withColumnsRenamed({k: f"_was_{k}" for k in keys})
    same = [F.col(f"_was_{k}").eqNullSafe(F.col(k)) for k in keys]  # a null key is a key
    both = was.join(now, reduce(lambda a, b: a & b, same), "full_outer")
    named = [F.when(F.col("_new").isNull(), F.col(f"_was_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    return both.select(*named, "_old", "_new"), version + 1


def publish_recorded(df: DataFrame, base: str, keys: list[str]) -> int:
    """Write `df` as the next version of the table at `base` with its changes, schema changes included."""
    rows, version = _both(df, base, keys, True)
    return _write_version(rows, keys, base, version)


def upsert_recorded(source: DataFrame, base: str, keys: list[str], deleted: str | None = None) -> int:
    """Upsert `source` into the table at `base` as its next version, with its changes.

    Where the boolean column `deleted` is true the key is removed instead.
    """
    gone = F.col("_new").isNotNull() & F.coalesce(F.col(f"_new.{deleted}"), F.lit(False)) if deleted else F.lit(False)
    rows, version = _both(source, base, keys, False)
    merged = F.when(gone, F.lit(None)).otherwise(F.coalesce("_new", "_old"))
    rows = rows.withColumn("_new", merged).where(F.col("_old").isNotNull() | F.col("_new").isNotNull())
    if deleted:
        rows = rows.withColumns({c: F.when(F.col(c).isNotNull(), F.col(c).dropFields(deleted)) for c in ("_old", "_new")})
    return _write_version(rows, keys, base, version)


class _Files:
    """Change files of finished versions, found through pyarrow so that planning needs no JVM."""

    def __init__(self, base: str):
        from pyarrow import fs

        self.files, self.base = fs.FileSystem.from_uri(base) if "://" in base or base.startswith("file:") else (fs.LocalFileSystem(), base)

    def _names(self, folder: str) -> list[str]:
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return [f.base_name for f in found]

    def versions(self) -> list[int]:
        """Versions 1, 2, ... up to the first that is not finished."""
        numbers = {int(m[1]) for n in self._names(self.base) if (m := re.fullmatch(r"version=(\d+)", n))}
        done = []
        while len(done) + 1 in numbers and "_SUCCESS" in self._names(f"{self.base}/version={len(done) + 1}"):
            done.append(len(done) + 1)
        return done

    def parts(self, version: int) -> list[str]:
        folder = f"{self.base}/changes/version={version}"
        return [f"{folder}/{n}" for n in sorted(self._names(folder)) if n.endswith(".parquet")]


class _Part(InputPartition):
    def __init__(self, version: int, path: str):
        super().__init__(path)
        self.version, self.path = version, path


class _Reader:
    def __init__(self, base: str, schema: T.StructType):
        self.base, self.schema = base, schema

    def _parts(self, first: int, last: int) -> list[_Part]:
        files = _Files(self.base)
        return [_Part(v, p) for v in range(first, last + 1) for p in files.parts(v)]

    def read(self, partition: _Part) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(self.schema)
        with _Files(self.base).files.open_input_file(partition.path) as file:
            for batch in pq.ParquetFile(file).iter_batches(10_000):
                have = dict(zip(batch.schema.names, batch.columns, strict=True)) | {"_version": pa.array([partition.version] * batch.num_rows, pa.int64())}
                columns = [have[f.name].cast(f.type) if f.name in have else pa.nulls(batch.num_rows, f.type) for f in wanted]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)


class _BatchReader(_Reader, DataSourceReader):
    def partitions(self) -> list[_Part]:
        return self._parts(1, len(_Files(self.base).versions()))


class _StreamReader(_Reader, DataSourceStreamReader):
    def __init__(self, base: str, schema: T.StructType, after: int):
        super().__init__(base, schema)
        self.after = after

    def initialOffset(self) -> dict:
        return {"version": self.after}

    def latestOffset(self) -> dict:
        return {"version": max(self.after, len(_Files(self.base).versions()))}

    def partitions(self, start: dict, end: dict) -> list[_Part]:
        return self._parts(start["version"] + 1, end["version"])

    def commit(self, end: dict) -> None:
        """Files stay: another consumer may be behind."""


class ChangeSource(DataSource):
    """Format `fleet_changes`; options `path` and, for streams, `after` (a version; 0: from the first)."""

    @classmethod
    def name(cls) -> str:
        return "fleet_changes"

    def reader(self, schema: T.StructType) -> _BatchReader:
        return _BatchReader(self.options["path"], schema)

    def streamReader(self, schema: T.StructType) -> _StreamReader:
        return _StreamReader(self.options["path"], schema, int(self.options.get("after", 0)))


def change_schema(spark: SparkSession, base: str) -> T.StructType:
    """The newest version's columns with `_change` and `_version`."""
    plain = read_version(spark, base).schema
    return T.StructType([*plain.fields, T.StructField("_change", T.StringType()), T.StructField("_version", T.LongType())])


def read_changes(spark: SparkSession, base: str) -> DataFrame:
    spark.dataSource.register(ChangeSource)
    return spark.read.format("fleet_changes").schema(change_schema(spark, base)).load(base)


def stream_changes(spark: SparkSession, base: str, after: int = 0) -> DataFrame:
    """The changes of all versions later than `after`, each version's once, as they are published."""
    spark.dataSource.register(ChangeSource)
    return spark.readStream.format("fleet_changes").schema(change_schema(spark, base)).option("after", after).load(base)


def fold_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The table that change rows since the first version lead to: each key's newest row unless it is a delete."""
    rest = [c for c in changes.columns if c not in (*keys, "_version")]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_version").alias("_row"))
    return newest.where(F.col("_row._change") != "delete").select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest if c != "_change"])
