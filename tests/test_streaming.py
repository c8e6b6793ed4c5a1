import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import retrieval as RT
from fleetlake.operators.features import hourly_features
from fleetlake.plans import registry
from fleetlake.session import scratch_dir
from fleetlake.sources import adapters as A
from fleetlake.sources.tables import read_stream, read_table
from fleetlake.streaming import corrected as CR
from fleetlake.streaming import flows as ST

T0 = datetime(2024, 1, 1)


def write(spark, path, rows):
    spark.createDataFrame(rows, "ts timestamp, k string, v double").coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return spark.readStream.schema("ts timestamp, k string, v double").option("maxFilesPerTrigger", 1).parquet(path)


def total(stream, **options):
    return ST.windowed(stream, "ts", ["k"], "1 hour", [F.sum("v").alias("v")], **options)


def test_late_rows_are_dropped_and_counted(spark):
    path, out, state = (scratch_dir(spark, n) for n in ("in", "out", "state"))
    write(spark, path, [(T0, "a", 1.0)])
    ST.run_available(total(source(spark, path)), state, path=out)
    write(spark, path, [(T0 + timedelta(hours=9), "a", 1.0)])
    ST.run_available(total(source(spark, path)), state, path=out)
    write(spark, path, [(T0, "a", 50.0), (T0 + timedelta(hours=9), "a", 1.0)])
    query = ST.run_available(total(source(spark, path)), state, path=out)
    assert ST.dropped_late_rows(query) == 1
    assert [r.v for r in spark.read.parquet(out).collect()] == [1.0]


def test_many_files_equal_one_batch(spark):
    path, base, state = (scratch_dir(spark, n) for n in ("in", "base", "state"))
    for i in range(4):
        write(spark, path, [(T0 + timedelta(minutes=20 * j), k, float(i + j)) for j in range(8) for k in "ab"])
    stream = total(source(spark, path), watermark="10 days")
    ST.run_available(stream, state, sink=ST.upsert_sink(base), mode="update")
    got = ST.read_merged(spark, base, ["k", "window_start"]).select("k", "window_start", "v")
    want = spark.read.parquet(path).groupBy("k", F.window("ts", "1 hour").alias("w")).agg(F.sum("v").alias("v"))
    assert got.exceptAll(want.select("k", "w.start", "v")).count() == 0 and got.count() == want.count()


def test_sliding_windows(spark):
    path, base, state = (scratch_dir(spark, n) for n in ("in", "base", "state"))
    write(spark, path, [(T0 + timedelta(minutes=40), "a", 2.0)])
    stream = total(source(spark, path), slide="30 minutes")
    ST.run_available(stream, state, sink=ST.upsert_sink(base), mode="update")
    starts = sorted(r.window_start for r in ST.read_merged(spark, base, ["k", "window_start"]).collect())
    assert starts == [T0, T0 + timedelta(minutes=30)]


def test_replayed_batch_changes_nothing(spark):
    base = scratch_dir(spark, "base")
    sink = ST.upsert_sink(base)
    one = spark.createDataFrame([("a", 1)], "k string, n int")
    two = spark.createDataFrame([("a", 2), ("b", 5)], "k string, n int")
    for batch, number in ((one, 0), (two, 1), (two, 1)):
        sink(batch, number)
    assert sorted(map(tuple, ST.read_merged(spark, base, ["k"]).collect())) == [("a", 2), ("b", 5)]


def test_event_stream_source(spark, small):
    stream = read_stream(spark, small, "events", ts="ts").select(*A.reading_columns())
    out, state = scratch_dir(spark, "out"), scratch_dir(spark, "state")
    ST.run_available(stream, state, path=out)
    assert spark.read.parquet(out).count() == read_table(spark, small, "events").count()


def test_index_follows_arriving_chunks(spark):
    path, base, state = (scratch_dir(spark, n) for n in ("in", "index", "state"))
    schema = "chunk_id int, content string"
    first = spark.createDataFrame([(1, "fan failure"), (2, "link down")], schema)
    model = RT.text_embedder(first, dims=32)

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        ST.run_available(stream, state, sink=ST.index_sink(base, model))

    arrive([(1, "fan failure"), (2, "link down")])
    arrive([(2, "link up"), (3, "driver crash")])
    want = RT.build_index(spark.createDataFrame([(1, "fan failure"), (2, "link up"), (3, "driver crash")], schema), model)
    assert sorted(map(tuple, ST.read_merged(spark, base, ["chunk_id"]).collect())) == sorted(map(tuple, want.collect()))
    assert spark.read.parquet(base).where("batch = 1").count() == 2  # the unchanged chunk is not embedded again
    again = spark.createDataFrame([(2, "link up"), (3, "driver crash")], schema)
    ST.index_sink(base, model)(again, 1)
    assert spark.read.parquet(base).where("batch = 1").count() == 2  # a replay writes the same rows
    ST.index_sink(base, model)(again, 2)
    assert spark.read.parquet(base).where("batch = 2").count() == 0
    twice = spark.createDataFrame([(4, "one version"), (4, "another version")], schema)
    ST.index_sink(base, model)(twice, 3)
    assert spark.read.parquet(base).where("batch = 3").count() == 1
    to = scratch_dir(spark, "compacted")
    ST.compacted(spark, base, ["chunk_id"], to)
    assert sorted(map(tuple, ST.read_merged(spark, to, ["chunk_id"]).collect())) == sorted(map(tuple, ST.read_merged(spark, base, ["chunk_id"]).collect()))
    ST.index_sink(to, model)(spark.createDataFrame([(1, "fan failure"), (9, "new")], schema), 0)
    assert spark.read.parquet(to).where("batch = 0").count() == 1


def test_first_batch_shuffles_vectors_and_keeps_one_version(spark):
    base, schema = scratch_dir(spark, "index"), "chunk_id int, content string"
    rows = [(1, "fan failure"), (1, "fan replaced"), (2, None), (3, None), (3, "link down"), (4, ""), (1, "fan failure")]
    batch = spark.createDataFrame(rows, schema)
    model = RT.text_embedder(batch, dims=8)
    ST.index_sink(base, model)(batch, 0)
    built = RT.build_index(batch, model).collect()
    want = {k: max((tuple(r) for r in built if r.chunk_id == k and (r.content_hash or k == 2)), key=lambda r: r[1] or "") for k in (1, 2, 3, 4)}
    got = ST.read_merged(spark, base, ["chunk_id"]).select("chunk_id", "content_hash", "embedding").collect()
    assert sorted(map(tuple, got)) == sorted(want.values(), key=lambda r: r[0])


def test_batch_vectors_of_the_document_index_do_not_split_texts_again(spark, small):
    """The rows that the model was learned from are read instead; the stream has its own."""
    plan = registry.all_queries()["stream_document_index"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "lower(" not in plan


def test_late_rows_for_a_side_table(spark):
    rows = spark.createDataFrame([(T0, 1), (T0 + timedelta(hours=3), 2)], "ts timestamp, k int")
    seen = spark.createDataFrame([(T0 + timedelta(hours=2),)], "seen timestamp")
    assert [r.k for r in ST.late_rows(rows, "ts", seen).collect()] == [1]
    assert ST.late_rows(rows, "ts", seen.limit(0)).count() == 0


def test_tables_that_are_folders_arrive_part_by_part(spark, small, tmp_path):
    """All streaming queries over tables of three parts, taken in two runs."""
    root = str(tmp_path / "root")
    whole = {name: read_table(spark, small, name) for name in ("events", "documents", "benchmark", "labels", "customer", "orders")}
    for name, df in whole.items():
        df.repartition(3).write.parquet(f"{root}/{name}.parquet")
    stream = read_stream(spark, root, "events", ts="ts").select(*A.reading_columns())
    out, state = scratch_dir(spark, "out"), scratch_dir(spark, "state")
    ST.run_available(stream, state, path=out)
    assert spark.read.parquet(out).count() == whole["events"].count()
    whole["events"].limit(5).coalesce(1).write.mode("append").parquet(f"{root}/events.parquet")
    ST.run_available(read_stream(spark, root, "events", ts="ts").select(*A.reading_columns()), state, path=out)
    assert spark.read.parquet(out).count() == whole["events"].count() + 5


@pytest.mark.parametrize("name", ["stream_hourly_features", "stream_snapshot_features", "stream_document_index", "stream_scored_events", "stream_hourly_corrected", "stream_snapshot_corrected"])
def test_streaming_queries_over_folders(spark, small, tmp_path, name):
    root = str(tmp_path / "root")
    for table in ("events", "documents"):
        read_table(spark, small, table).repartition(3).write.parquet(f"{root}/{table}.parquet")
    query = registry.all_queries()[name]
    one, two = query(spark, small), query(spark, root)
    assert one.count() == two.count() > 0
    if name != "stream_document_index":  # vectors of another fit are compared with the batch within the query
        assert one.exceptAll(two).count() == 0
    else:
        assert two.where("NOT as_in_batch").count() == 0


def test_rows_in_any_order_and_delay_give_the_batch_table(spark):
    """Three batches, the oldest hours last, one batch replayed, a log compacted in between."""
    rng = random.Random(3)
    rows = [(T0 + timedelta(minutes=rng.randint(0, 40_000)), f"g{rng.randint(0, 3)}", rng.random() * 50 + 60, rng.random() * 100, rng.random() * 80, 300.0, rng.randint(0, 1)) for _ in range(900)]
    rows += [(rows[0][0], "g0", None, None, None, None, None)]
    names = "timestamp timestamp, gpu_id string, temp_celsius double, utilization_pct double, memory_used_gb double, power_watts double, error_count int"
    df = spark.createDataFrame(sorted(rows, key=lambda r: r[0], reverse=True), names)
    parts = [spark.createDataFrame(sorted(rows, key=lambda r: r[0], reverse=True)[i::3], names) for i in range(3)]
    base, to = scratch_dir(spark, "log"), scratch_dir(spark, "log")
    for sink, batch, number in ((base, parts[0], 0), (base, parts[1], 1), (base, parts[1], 1)):
        CR.correcting_sink(sink, CR.HOURLY)(batch, number)
    CR.compact(spark, base, CR.HOURLY, to)
    CR.correcting_sink(to, CR.HOURLY)(parts[2], 0)
    want = hourly_features(df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))
    found = CR.hourly_table(CR.corrected_windows(spark, to, CR.HOURLY)).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    one, two = (registry.settled(x.select(*sorted(want.columns))) for x in (want, found))
    assert one.count() == two.count() and one.exceptAll(two).count() == 0
