"""Recorded changes against snapshot differences, and consumers that resume."""

from pyspark.sql import functions as F

from fleetlake.session import scratch_dir
from fleetlake.sinks import changes as CG
from fleetlake.sinks import feed
from fleetlake.sinks.tables import read_version
from fleetlake.streaming import flows as ST

NAMES = "k int, v string, n double"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def consume(spark, base, state, out):
    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return ST.run_available(feed.stream_changes(spark, base), state, sink=keep)


def test_recorded_changes_equal_snapshot_differences(spark):
    base, state, out = (scratch_dir(spark, n) for n in ("table", "state", "seen"))
    one = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (None, "z", 0.0)], NAMES)
    assert feed.publish_recorded(one, base, ["k"]) == 1
    consume(spark, base, state, out)
    assert spark.read.parquet(out).count() == 4
    change = spark.createDataFrame([(2, "b", None, False), (3, "new", 3.0, False), (4, "d", 4.0, False), (1, None, None, True), (9, None, None, True)], NAMES + ", gone boolean")
    assert feed.upsert_recorded(change, base, ["k"], deleted="gone") == 2
    assert rows(read_version(spark, base), "k", "v", "n") == sorted([(2, "b", None), (3, "new", 3.0), (None, "z", 0.0), (4, "d", 4.0)], key=str)
    assert feed.upsert_recorded(spark.createDataFrame([(2, 7)], "k int, extra int"), base, ["k"]) == 3
    assert feed.publish_recorded(read_version(spark, base).where("k <> 4"), base, ["k"]) == 4
    consume(spark, base, state, out)  # only versions 2 to 4
    seen = spark.read.parquet(out)
    assert rows(seen.groupBy("_version").count(), "_version", "count") == rows(feed.read_changes(spark, base).groupBy("_version").count(), "_version", "count")
    for version in (2, 3, 4):
        old, new = read_version(spark, base, version - 1), read_version(spark, base, version)
        for name in new.columns:
            if name not in old.columns:
                old = old.withColumn(name, F.lit(None).cast(new.schema[name].dataType))
        want = CG.diff_snapshots(old.where("k IS NOT NULL"), new.where("k IS NOT NULL"), ["k"])
        shown = [c for c in want.columns]
        assert rows(feed.read_changes(spark, base).where((F.col("_version") == version) & F.col("k").isNotNull()), *shown) == rows(want, *shown)
    lone = feed.read_changes(spark, base).where("k IS NULL").orderBy("_version").collect()
    assert [(r["_version"], r["_change"]) for r in lone] == [(1, "insert"), (4, "delete")]  # a null key is a key
    final = read_version(spark, base)
    assert rows(feed.fold_changes(feed.read_changes(spark, base), ["k"]), *final.columns) == rows(final, *final.columns)


def test_unfinished_versions_are_not_seen(spark):
    base = scratch_dir(spark, "table")
    one = spark.createDataFrame([(1, "a", 1.0)], NAMES)
    feed.publish_recorded(one, base, ["k"])
    files = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    feed.publish_recorded(one.withColumn("v", F.lit("b")), base, ["k"])
    files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/version=2/_SUCCESS"), False)
    assert feed.read_changes(spark, base).agg(F.max("_version")).first()[0] == 1
