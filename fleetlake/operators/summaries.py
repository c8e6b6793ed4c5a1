"""Mergeable summaries of values: counts per window, slice, column and dyadic cell.

A cell is a range of doubles with the same sign, binary exponent and first `bits` bits behind it, so cells
are fixed beforehand, keep the order of values and are the same in every window, batch and table:
summaries add up. A cell is at most 2**-bits of its values wide. Values below 2**-300 in size share the cell
0, infinities and NaN have cells of their own at the ends, NaN being the largest as in Spark's order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST, MOST = -300, 1024


def value_cell(x: Column, bits: int = 8) -> Column:
    """The cell of a double, as a long that grows with it; null for null."""
    size, unit = F.abs(x), 1 << bits
    # A logarithm that falls just across a power of two gives the same cell from either side.
    exponent = F.greatest(F.floor(F.log2(size)), F.lit(LEAST).cast("long"))
    step = (exponent - LEAST) * unit + F.floor(size * F.pow(F.lit(2.0), bits - exponent)).cast("long")
    top = (MOST - LEAST + 2) * unit
    infinite = F.when(x > 0, F.lit(top)).otherwise(F.lit(-top))
    finite = F.when(size < 2.0**LEAST, F.lit(0)).otherwise(F.when(x > 0, step).otherwise(-step))
    return F.when(F.isnan(x), F.lit(top + 1)).when(size == float("inf"), infinite).otherwise(F.when(x.isNotNull(), finite)).cast("long")


def cell_edge(cell: Column, bits: int = 8) -> Column:
    """The value of a cell that is nearest to 0: its lower bound if positive, its upper bound if negative."""
    unit = 1 << bits
    size, top = F.abs(cell), (MOST - LEAST + 2) * unit
    exponent = F.floor(size / unit) - 1
    edge = (size - exponent * unit) * F.pow(F.lit(2.0), exponent + LEAST - bits)
    known = F.when(cell == 0, 0.0).when(size == top, float("inf")).otherwise(edge)
    return F.when(cell == top + 1, float("nan")).otherwise(F.when(cell < 0, -known).otherwise(known))


def value_summary(rows: DataFrame, keys: list[str], slices: Column, slice_columns: list[str], numeric: list[str], bits: int = 8) -> DataFrame:
    """(keys, slice_key, slice_value, column_name, bin, n) from rows with `keys`, the slice columns and numbers.

    Rows are counted at (keys, all slice columns together, column, cell), which combines before the
    shuffle; only those counts are repeated for the single slices of `slices` (an array of slice structs).
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), value_cell(F.col(c).cast("double"), bits).alias("bin")) for c in numeric])
    wide = rows.select(*keys, *slice_columns, F.explode(cells).alias("_cell")).select(*keys, *slice_columns, "_cell.*").where("bin IS NOT NULL")
    finest = wide.groupBy(*keys, *slice_columns, "column_name", "bin").agg(F.count(F.lit(1)).alias("n"))
    single = finest.withColumn("_slice", F.explode(slices)).select(*keys, "_slice.*", "column_name", "bin", "n")
    return single.groupBy(*keys, "slice_key", "slice_value", "column_name", "bin").agg(F.sum("n").alias("n"))


def merged(*summaries: DataFrame) -> DataFrame:
    """The summary of all rows that several summaries were made of."""
    rows = summaries[0]
    for more in summaries[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(*[c for c in rows.columns if c != "n"]).agg(F.sum("n").alias("n"))


def quantiles(summary: DataFrame, shares: dict[str, float], bits: int = 8) -> DataFrame:
    """Per group of a summary: n and, for each named share, the edge of the cell that holds the value of rank
    ceil(share * n)."""
    group = [c for c in summary.columns if c not in ("bin", "n")]
    own = Window.partitionBy(*group)
    up_to = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = summary.withColumns({"_upto": F.sum("n").over(up_to), "_all": F.sum("n").over(own)})
    first = {name: F.min(F.when(F.col("_upto") >= F.ceil(F.lit(share) * F.col("_all")), F.col("bin"))) for name, share in shares.items()}
    found = ranked.groupBy(*group).agg(F.max("_all").alias("n"), *[c.alias(name) for name, c in first.items()])
    return found.select(*group, "n", *[cell_edge(F.col(name), bits).alias(name) for name in shares])
