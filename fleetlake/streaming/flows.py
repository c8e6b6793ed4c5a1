"""Structured Streaming forms of the feature, upsert, index and scoring operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlake.operators.features import hourly_aggregates, snapshot_statistics
from fleetlake.operators.latent import TextModel
from fleetlake.operators.retrieval import build_index


def windowed(
    stream: DataFrame,
    ts: str,
    keys: list[str],
    window: str,
    aggregates: list[Column],
    slide: str | None = None,
    watermark: str = "1 hour",
) -> DataFrame:
    """Aggregates per key and event-time window; tumbling, or sliding with `slide`.

    `ts` is zoned. Rows later than the watermark are dropped by Spark and counted in the query's
    progress; state older than it is released.
    """
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (
        stream.withWatermark(ts, watermark)
        .groupBy(*keys, span.alias("window"))
        .agg(*aggregates)
        .withColumn("window_start", F.col("window.start"))
        .withColumn("window_end", F.col("window.end"))
        .drop("window")
    )


def hourly_stream(readings: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """The hourly feature table over a stream of readings."""
    return windowed(readings, "timestamp", ["gpu_id"], "1 hour", hourly_aggregates(), watermark=watermark).drop("window_end")


def snapshot_stream(
    wide: DataFrame,
    window: str = "15 minutes",
    slide: str | None = None,
    watermark: str = "1 hour",
    keys: tuple[str, ...] = ("gpu_id",),
) -> DataFrame:
    """The 15-minute feature table over a stream of wide readings.

    first_reading and last_reading are the bounds of what was seen inside the window.
    """
    bounds = [F.min("timestamp").alias("first_reading"), F.max("timestamp").alias("last_reading")]
    return windowed(wide, "timestamp", list(keys), window, [*snapshot_statistics(), *bounds], slide, watermark)


def late_rows(batch: DataFrame, ts: str, newest: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """The rows of a batch that a watermark would drop, for a side table: (`newest`: one row, `seen`,
    the highest event time of the earlier batches)."""
    bound = newest.select((F.col("seen") - F.expr(f"INTERVAL {watermark}")).alias("_bound"))
    return batch.where(F.col(ts) < bound.agg(F.max("_bound")).scalar())


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows dropped for being later than the watermark, over the batches whose progress Spark still
    keeps (spark.sql.streaming.numRecentProgressUpdates); use `late_rows` for a complete side table."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for op in (progress["stateOperators"] if isinstance(progress, dict) else progress.stateOperators)
    )


def upsert_sink(base: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: add each batch of keyed rows to an upsert log at `base`.

    A batch writes only its own rows, into a folder named by the batch number, so the cost of a
    batch does not follow the size of the table and a replayed batch replaces its own folder.
    `read_merged` gives the table.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/batch={number}")

    return write


def read_merged(spark: SparkSession, base: str, keys: list[str], before: int | None = None) -> DataFrame:
    """The table of an upsert log: the newest row of every key, optionally before a batch."""
    log = spark.read.parquet(base)
    if before is not None:
        log = log.where(F.col("batch") < before)
    rest = [c for c in log.columns if c not in keys and c != "batch"]
    newest = F.max_by(F.struct(*rest), F.col("batch").cast("bigint"))
    return log.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def index_sink(base: str, model: TextModel, key: str = "chunk_id", text: str = "content") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: embed the arriving chunks that are new or changed into an upsert log.

    A chunk whose content hash the index has already is not embedded again. A batch holds arrivals,
    not the whole collection, so nothing is deleted here. Each batch writes its own folder and
    looks only at earlier ones, so a replay gives the same rows. Of several versions of a chunk
    inside one batch the one of the highest content hash counts. Of the index only keys, hashes and
    batch numbers are read, and only for the keys of the batch.
    """

    def newest(rows: DataFrame, content: Column) -> DataFrame:
        best = F.max_by(F.struct(*[c for c in rows.columns if c != key]), content).alias("_row")
        return rows.groupBy(key).agg(best).select(key, "_row.*")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if _exists(spark, base):
            fresh = newest(batch, F.sha2(F.col(text), 256))
            log = spark.read.parquet(base).where(F.col("batch") < number).select(key, "content_hash", F.col("batch").cast("bigint"))
            own = log.join(fresh.select(key), key, "left_semi")
            known = own.groupBy(key).agg(F.max_by("content_hash", "batch").alias("content_hash"))
            hashed = fresh.withColumn("content_hash", F.sha2(F.col(text), 256))
            rows = build_index(hashed.join(known, [key, "content_hash"], "left_anti"), model, key, text)
        else:  # nothing is known, so that vectors are shuffled and not the texts
            rows = newest(build_index(batch, model, key, text), F.col("content_hash"))
        rows.write.mode("overwrite").parquet(f"{base}/batch={number}")

    return write


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def compacted(spark: SparkSession, base: str, keys: list[str], to: str) -> None:
    """Write the newest row of every key of an upsert log as batch -1 of a new log at `to`.

    A sink that goes on writes its numbered batches there; the old log can go once no reader needs it.
    """
    read_merged(spark, base, keys).write.mode("overwrite").parquet(f"{to}/batch=-1")


def run_available(
    stream: DataFrame,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Process everything that has arrived, then stop: the triggered form of a scheduled refresh.

    Give a foreachBatch `sink`, or a `path` for plain appended Parquet. The checkpoint folder makes
    a restart continue where the last run ended.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(sink).start() if sink else writer.format("parquet").option("path", path).start()
    query.awaitTermination()
    return query
