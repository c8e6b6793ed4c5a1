"""Range join, as-of join, dimension joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.numeric import interval_us, micros, slot_start


def hot_groups(rows: DataFrame, keys: list[str], rows_per_task: int) -> DataFrame:
    """(keys, _parts): groups with more than `rows_per_task` rows and how many tasks they need.

    Counting combines on the map side. At most rows / rows_per_task groups can qualify, a few bytes
    each; Spark broadcasts them while they are few.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > rows_per_task).select(
        *keys, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_parts")
    )


def divided(rows: DataFrame, hot: DataFrame, keys: list[str], *spread: str) -> DataFrame:
    """Add `_salt`: 0, or a part number for the rows of a hot group.

    The input partition takes part in the hash, so identical copies that lie in many files still
    spread out. A rerun of a lost task sees the same partition number and so the same salts.
    """
    part = F.pmod(F.xxhash64(F.spark_partition_id(), *spread), F.col("_parts")).cast("int")
    return rows.join(hot, keys, "left").withColumn("_salt", F.coalesce(part, F.lit(0))).drop("_parts")


def repeated(rows: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Add `_salt`: one copy of the row for every part of its group, a single one if not hot."""
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    return rows.join(hot, keys, "left").withColumn("_salt", F.explode(parts)).drop("_parts")


def range_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    lo: str,
    hi: str,
    ts: str,
    how: str = "left",
    slot: str = "1 hour",
    rows_per_task: int = 10_000_000,
) -> DataFrame:
    """Rows of `right` whose `ts` lies in the left row's [lo, hi), for equal `key`.

    Column names must differ but for the key. A plain join on the key alone would bring all
    readings of a busy machine into one task and test each against each window. Here time is cut
    into slots and (key, slot, salt) is the equality key: a left row goes to every slot its window
    touches and to every salt there, a right row to exactly one of each, so every pair meets once.
    Slots with more than `rows_per_task` right rows have several salts, the others one. Pick `slot`
    about as long as the windows. For `how='left'`, left rows without a match follow with
    nulls; matching depends only on (key, lo, hi), so repeated left rows are kept as they are.
    """
    width = interval_us(slot)
    first = slot_start(micros(F.col(lo)), width)
    last = slot_start(micros(F.col(hi)) - 1, width)
    at = right.withColumn("_slot", slot_start(micros(F.col(ts)), width))
    hot = hot_groups(at.select(key, "_slot"), [key, "_slot"], rows_per_task)
    touched = left.where(F.col(lo) < F.col(hi)).withColumn("_slot", F.explode(F.sequence(first, last, F.lit(width))))
    probes = repeated(touched, hot, [key, "_slot"])
    placed = divided(at, hot, [key, "_slot"], ts)

    def meet(a, b):
        inside = (F.col(f"b.{ts}") >= F.col(f"a.{lo}")) & (F.col(f"b.{ts}") < F.col(f"a.{hi}"))
        same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (key, "_slot", "_salt")]
        return a.alias("a").join(b.alias("b"), [*same, inside])

    others = [c for c in right.columns if c != key]
    pairs = meet(probes, placed).select(
        *[F.col(f"a.{c}").alias(c) for c in left.columns], *[F.col(f"b.{c}").alias(c) for c in others]
    )
    if how == "inner":
        return pairs
    if how != "left":
        raise ValueError("how must be 'inner' or 'left'")
    hit = pairs.select(key, lo, hi).distinct()
    lonely = left.join(hit, [key, lo, hi], "left_anti")
    return pairs.unionByName(lonely, allowMissingColumns=True)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    tolerance: str | None = None,
    slot: str = "1 hour",
    rows_per_task: int = 10_000_000,
) -> DataFrame:
    """Each left row with the newest right row at or before it (point-in-time lookup).

    Right instants must be unique per key. Both sides are merged in one sorted stream per
    (key, slot), where the last right row seen so far is the answer. When a slot has none yet, the
    answer is the last right row of an earlier slot, found on one row per (key, slot). So no key is
    ever sorted as a whole, and no pair of rows is built. A slot with more than `rows_per_task` rows
    is cut into shorter ones; any disjoint slots in time order give the same answer.
    """
    width = interval_us(slot)
    payload = [c for c in right.columns if c != key]
    hit_type = right.select(F.struct(*payload).alias("_hit"))
    stream = left.select(
        key,
        micros(F.col(left_ts)).alias("_at"),
        F.lit(1).alias("_side"),
        F.struct(*[c for c in left.columns if c != key]).alias("_left"),
        F.lit(None).cast(hit_type.schema["_hit"].dataType).alias("_hit"),
    ).unionByName(
        right.select(
            key,
            micros(F.col(right_ts)).alias("_at"),
            F.lit(0).alias("_side"),
            F.struct(*payload).alias("_hit"),
        ),
        allowMissingColumns=True,
    )
    stream = stream.where(F.col(key).isNotNull()).withColumn("_slot", slot_start(F.col("_at"), width))
    hot = hot_groups(stream.select(key, "_slot"), [key, "_slot"], rows_per_task)
    shorter = F.greatest(F.ceil(F.lit(width) / F.col("_parts")), F.lit(1))
    offset = F.col("_at") - F.col("_slot")
    stream = (
        stream.join(hot, [key, "_slot"], "left")
        .withColumn("_slot", F.col("_slot") + F.coalesce(offset - F.pmod(offset, shorter), F.lit(0)))
        .drop("_parts")
    )

    within = (
        Window.partitionBy(key, "_slot").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = stream.withColumn("_hit", F.last("_hit", ignorenulls=True).over(within)).where(F.col("_side") == 1)

    per_slot = stream.groupBy(key, "_slot").agg(
        F.max_by("_hit", F.when(F.col("_side") == 0, F.col("_at"))).alias("_closing")
    )
    before = Window.partitionBy(key).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slot.select(key, "_slot", F.last("_closing", ignorenulls=True).over(before).alias("_carry"))

    out = filled.join(carried, [key, "_slot"]).withColumn("_hit", F.coalesce("_hit", "_carry"))
    if tolerance is not None:
        fresh = F.col("_at") - micros(F.col(f"_hit.{right_ts}")) <= interval_us(tolerance)
        out = out.withColumn("_hit", F.when(fresh, F.col("_hit")))
    matched = out.select(key, "_left.*", *[F.col(f"_hit.{c}").alias(c) for c in payload])
    nulls = left.where(F.col(key).isNull())
    return matched.unionByName(nulls, allowMissingColumns=True)


def with_dimension(fact: DataFrame, dimension: DataFrame, key: str = "cluster_id", how: str = "inner") -> DataFrame:
    """Equality join of facts to a dimension with one row per key.

    Not hinted: Spark broadcasts the dimension when its measured size is below
    `spark.sql.autoBroadcastJoinThreshold`, and otherwise splits skewed partitions at run time.
    """
    return fact.join(dimension, key, how)


def with_cluster_of_gpu(events: DataFrame, gpu_rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """Events know only their GPU: find its cluster first, then the cluster's dimension row.

    `gpu_rows` may be raw telemetry; it is reduced to one row per (gpu_id, cluster_id).
    """
    owner = gpu_rows.select("gpu_id", "cluster_id").distinct()
    return with_dimension(events.join(owner, "gpu_id"), clusters)


def join_features_to_labels(
    features: DataFrame, labels: DataFrame, keys: tuple[str, ...] = ("gpu_id", "window_start")
) -> DataFrame:
    """Inner join on the feature key, then 0 for missing numbers (text stays null)."""
    return features.join(labels, list(keys), "inner").na.fill(0)
