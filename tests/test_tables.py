import pytest
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.session import scratch_dir
from fleetlake.sinks import changes as CG
from fleetlake.sinks import tables as SK
from fleetlake.sources import tables as SRC

KV = "k int, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_replaces_inserts_keeps(spark):
    target = spark.createDataFrame([(1, "old"), (2, "kept")], KV)
    source = spark.createDataFrame([(1, None), (3, "new")], KV)
    out = CG.upsert(target, source, ["k"])
    assert rows(out) == [(1, None), (2, "kept"), (3, "new")]
    assert rows(CG.upsert(out, source, ["k"])) == rows(out)


def test_upsert_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "old")], KV)
    source = spark.createDataFrame([(9, "x"), (9, "y")], KV)
    with pytest.raises(Exception, match="duplicate source key"):
        CG.upsert(target, source, ["k"]).collect()


def test_upsert_with_new_columns(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    source = spark.createDataFrame([(2, 5)], "k int, w int")
    assert rows(CG.upsert(target, source, ["k"])) == [(1, "a", None), (2, None, 5)]


def test_diff_and_apply(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None)], KV)
    new = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (5, "e")], KV)
    diff = CG.diff_snapshots(old, new, ["k"])
    assert rows(diff) == [(2, "c", "update"), (4, None, "delete"), (5, "e", "insert")]
    assert rows(CG.apply_changes(old, diff, ["k"])) == rows(new)


def test_contract(spark):
    df = spark.createDataFrame([("g", None, 1), ("g", None, 2)], "gpu_id string, window_start timestamp_ntz, is_anomaly int")
    want = schemas.table_schemas()["gpu_anomaly_labels"]
    found = {(r.rule, r.column_name): r.violations for r in schemas.check_contract(df, want, ["gpu_id", "window_start"]).collect()}
    assert found == {("null_value", "window_start"): 2, ("duplicate_key", "gpu_id,window_start"): 1}
    short = df.drop("is_anomaly").withColumn("gpu_id", F.lit(3))
    kinds = {(r.rule, r.column_name) for r in schemas.check_contract(short, want).collect()}
    assert {("missing_column", "is_anomaly"), ("type_mismatch", "gpu_id")} <= kinds


def test_aliases(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "temperature_celsius double, power_draw_watts double")
    assert schemas.canonicalise(df).columns == ["temp_celsius", "power_watts"]


def test_counted_write_versions_and_evolution(spark):
    base = scratch_dir(spark, "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    assert SK.write_counted(df, f"{base}/c") == 2
    assert SK.write_counted(df, f"{base}/c", "append") == 2
    assert spark.read.parquet(f"{base}/c").count() == 4
    assert SK.latest_version(spark, f"{base}/v") is None
    assert SK.publish(df, f"{base}/v") == 1
    assert SK.publish(SK.read_version(spark, f"{base}/v").where("k = 1"), f"{base}/v") == 2
    assert rows(SK.read_version(spark, f"{base}/v")) == [(1, "a")]
    assert SK.read_version(spark, f"{base}/v", 1).count() == 2
    wide = SK.evolved(df, spark.createDataFrame([(3, 1.0)], "k int, w double"))
    assert wide.columns == ["k", "v", "w"] and wide.count() == 3


def test_versions_without_rows_and_beyond_an_int(spark):
    base = scratch_dir(spark, "v")
    df = spark.createDataFrame([(1, "a")], KV)
    assert [SK.publish(df, base), SK.publish(df.limit(0), base)] == [1, 2]
    assert SK.latest_version(spark, base) == 2 and SK.read_version(spark, base).count() == 0
    assert SK.publish(df, base) == 3
    versions = spark.createDataFrame([("m", "3000000000"), ("m", "9")], "name string, version string")
    assert SK.latest_numeric_version(versions, "name", "version").first().latest_version == 3_000_000_000


def test_partition_upsert_keeps_null_and_text_partitions(spark):
    path = scratch_dir(spark, "parts")
    target = [(1, "a", "01"), (2, "b", None), (3, "c", None), (4, "d", "02")]
    shape = "k int, v string, p string"
    spark.createDataFrame(target, shape).write.partitionBy("p").parquet(path)
    CG.upsert_partitions(path, spark.createDataFrame([(2, "B", None), (1, "A", "01"), (5, "e", "03")], shape), ["k"], "p")
    found = spark.read.schema(shape).parquet(path)
    assert rows(found) == sorted([(1, "A", "01"), (2, "B", None), (3, "c", None), (4, "d", "02"), (5, "e", "03")], key=repr)


def test_conform_gives_the_declared_feature_table(spark):
    want = schemas.table_schemas()["gpu_health_features"]
    df = spark.createDataFrame([("g", 1)], "gpu_id string, error_count_1h int")
    out = SK.conform(df, want)
    assert out.columns == want.names
    assert out.schema["error_count_1h"].dataType.simpleString() == "bigint"


def test_managed_tables(spark):
    SK.ensure_schema(spark, "fleet_test")
    df = spark.createDataFrame([(1, "a")], KV)
    assert rows(SK.save_table(df, "fleet_test.kv")) == [(1, "a")]
    assert SK.save_table(df, "fleet_test.kv", "append").count() == 2
    SK.drop_table(spark, "fleet_test.kv")
    SK.drop_table(spark, "fleet_test.kv")
    assert not spark.catalog.tableExists("fleet_test.kv")


def test_numeric_version_order(spark):
    df = spark.createDataFrame([("m", "9"), ("m", "10")], "name string, version string")
    assert SK.latest_numeric_version(df, "name", "version").first().latest_version == 10


def test_create_if_absent(spark):
    wanted = spark.createDataFrame([("a",), ("b",)], "name string")
    assert rows(SK.absent_from(wanted, spark.createDataFrame([("a",)], "name string"), ["name"])) == [("b",)]
    assert SK.absent_from(wanted, wanted, ["name"]).count() == 0


def test_generated_baseline_is_repeatable(spark):
    one, two = SRC.monitoring_baseline(spark), SRC.monitoring_baseline(spark)
    assert one.count() == 100 and rows(one) == rows(two)
    assert one.columns == schemas.table_schemas()["model_monitoring_baseline"].names
    low, high = one.agg(F.min("avg_temp"), F.max("avg_temp")).first()
    assert 60 <= low and high < 80
    assert one.select("cluster_id").distinct().count() == 3


def test_documents_and_listing(spark, tmp_path):
    (tmp_path / "a.txt").write_text("héllo")
    (tmp_path / "b.md").write_text("no")
    assert rows(SRC.read_documents(spark, str(tmp_path))) == [("a.txt", "héllo")]
    listed = SRC.list_files(spark, str(tmp_path))
    assert sorted(r.length for r in listed.collect()) == [2, 6]
    assert SRC.with_suffix(listed, "path", ".md").count() == 1


def test_rows_and_views(spark):
    want = schemas.table_schemas()["gpu_anomaly_labels"]
    from datetime import datetime

    df = SRC.rows_to_table(spark, [("g", datetime(2024, 1, 1), 1)], want)
    assert spark.table(SRC.register_view(df, "labels_view")).count() == 1
    assert SK.preview(df, 10, "gpu_id").count() == 1
