"""Grouped summaries: shares, rates, pivots, slices, text concatenation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.numeric import percent, settle


def share_of_total(df: DataFrame, group: Column, count: str = "count", share: str = "pct", digits: int = 2) -> DataFrame:
    """Rows per group and their percentage of all rows, in one scan.

    The total is a scalar subquery over the same group counts; its shuffle is the one the counts
    use, so Spark reuses it and the table is not read a second time.
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias(count))
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, settle(percent(F.col(count), total), digits))


def positive_rate(df: DataFrame, label: str) -> DataFrame:
    """Share of positive labels as one row."""
    return df.agg(F.avg(F.col(label).cast("double")).alias("positive_rate"))


def text_set(column: str) -> Column:
    """Distinct values of a low-cardinality column as sorted, comma-joined text."""
    return F.array_join(F.array_sort(F.collect_set(column)), ",")


def pivot_mean(df: DataFrame, index: str, columns: str, value: str, names: list | None = None) -> DataFrame:
    """Mean of `value` per index row and pivoted column; absent cells are null.

    Without `names` every value found becomes a column: Spark looks the distinct values up first and
    refuses more than spark.sql.pivotMaxValues of them. Given `names`, only those become columns and
    no extra job runs. For more columns than a row can hold use `pivot_map`.
    """
    return df.groupBy(index).pivot(columns, names).agg(F.avg(value))


def pivot_map(df: DataFrame, index: str, columns: str, value: str, size: int = 10_000) -> DataFrame:
    """(index, part, cells): the mean of `value` per pivoted value as maps, for columns known only by the data.

    Means are taken per (index, column) first. An index with many columns has several parts, dealt by a
    hash of the column, so that a map holds about half of `size` entries.
    """
    means = df.groupBy(index, columns).agg(F.avg(value).alias("_mean")).where(F.col(columns).isNotNull())
    parts = means.groupBy(index).agg((F.floor(2 * F.count(F.lit(1)) / size) + 1).alias("_parts"))
    dealt = means.join(parts, means[index].eqNullSafe(parts[index])).drop(parts[index])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64(columns), F.col("_parts")))
    entries = F.array_sort(F.collect_list(F.struct(columns, "_mean")))
    return dealt.groupBy(index, "part").agg(F.map_from_entries(entries).alias("cells"))


def slice_rows(df: DataFrame, slices: list[str], keys: list[str], *aggregates: Column) -> DataFrame:
    """Aggregates over the whole table and over each slice column alone, per `keys`.

    One pass by grouping sets. slice_key and slice_value are null for the whole table; a null
    value of a slice column keeps its slice_key, so the two are told apart.
    """
    sets = [[F.col(c) for c in keys]] + [[F.col(c) for c in [*keys, s]] for s in slices]
    wide = df.groupingSets(sets, *[F.col(c) for c in [*keys, *slices]]).agg(
        *aggregates, *[F.grouping(s).alias(f"_off_{s}") for s in slices]
    )
    key = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for s in slices:
        key = F.when(F.col(f"_off_{s}") == 0, F.lit(s)).otherwise(key)
        value = F.when(F.col(f"_off_{s}") == 0, F.col(s).cast("string")).otherwise(value)
    names = [c for c in wide.columns if c not in keys and c not in slices and not c.startswith("_off_")]
    return wide.select(*keys, key.alias("slice_key"), value.alias("slice_value"), *names)


def custom_metrics(df: DataFrame, slices: list[str], keys: list[str], definitions: dict[str, str]) -> DataFrame:
    """User aggregates given as SQL text, per key and slice, e.g. {'rate': 'avg(x > 1)'}.

    The text is an expression inside `agg`; the analyzer rejects unknown columns and functions
    before anything runs. Results are doubles.
    """
    metrics = [F.expr(text).cast("double").alias(name) for name, text in definitions.items()]
    return slice_rows(df, slices, keys, *metrics)


def ordered_concat(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    text: str,
    slot: Column,
    separator: str = " | ",
    part_rows: int = 1000,
) -> DataFrame:
    """Texts of a group joined in a defined order, as numbered parts of at most `part_rows` texts.

    A group of ordinary size has the single part 0. A group too large for one row becomes several
    rows that read in sequence, so nothing is cut off and no task collects more than one part.
    `slot` coarsens the first order column, e.g. its hour: rows are sorted per (group, slot) and
    numbered on from the row counts of the earlier slots, so a hot group is sorted in many tasks.
    The parts do not depend on the choice of `slot`.
    """
    rows = df.withColumn("_slot", slot)
    counts = rows.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_slot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys, "_slot").orderBy(*order))
    part = F.floor((F.col("_before") + F.col("_place") - 1) / part_rows).cast("bigint")
    numbered = rows.withColumn("_place", place).join(offsets, [*keys, "_slot"]).withColumn("part", part)
    item = F.struct((F.col("_before") + F.col("_place")).alias("position"), F.col(text).alias("text"))
    return numbered.groupBy(*keys, "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda r: r["text"]), separator).alias("combined"),
        F.count(F.lit(1)).alias("texts"),
    )
