"""Top-k and dense ranks without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First k rows: a heap per task and one merge. Give a unique last key for a defined result."""
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, groups: list[str], k: int, *order: Column | str) -> DataFrame:
    """First k rows per group with `rank`; each task drops all but its own k before the shuffle."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def latest_per_key(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """Keep one row per key, the first in the given order."""
    return top_per_group(df, keys, 1, *order).drop("rank")


def ranked_by_hash(
    df: DataFrame, key: list[str], groups: list[str] | None = None, rank: str = "rank", digits: int = 3
) -> DataFrame:
    """Dense 1-based rank within `groups` (or over everything) in the order of md5(key), key.

    The same as row_number() over (partition by groups order by md5(key), key), without bringing a
    group into one task: md5 spreads the keys evenly over 16^digits prefixes, prefix order is md5
    order, so a row's rank is the number of rows in lower prefixes plus its place in its own. Rows
    are sorted per (group, prefix); only one count per (group, prefix) is summed up.
    """
    groups = groups or []
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key]))
    hashed = df.withColumn("_md5", digest).withColumn("_prefix", F.substring("_md5", 1, digits))
    counts = hashed.groupBy(*groups, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    lower = Window.partitionBy(*groups).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, "_prefix", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_before"))
    own = Window.partitionBy(*groups, "_prefix").orderBy("_md5", *key)
    placed = hashed.withColumn("_place", F.row_number().over(own))
    return (
        placed.join(offsets, [*groups, "_prefix"])
        .withColumn(rank, F.col("_before") + F.col("_place"))
        .select(*df.columns, rank)
    )
