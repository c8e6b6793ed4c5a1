"""Time predicates and truncation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hour_of(ts: Column) -> Column:
    """Start of the hour, zone-less like the batch tables."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def latest(df: DataFrame, ts: str, minus: str | None = None) -> Column:
    """The newest instant of a table, optionally minus a span, as a lazy scalar subquery.

    The span is taken off inside the subquery: its result is then compared with the bare column,
    which lets Spark hand the value to the Parquet reader and prune row groups.
    """
    newest = F.max(ts)
    return df.agg(newest if minus is None else newest - F.expr(f"INTERVAL {minus}")).scalar()


def trailing(ts: str, span: str, clock: DataFrame, as_of: Column | None = None) -> Column:
    """Rows within `span` before `as_of`, which defaults to the newest `ts` of the table `clock`.

    "Now" is an argument: a wall clock would give each action of a run a different window.
    """
    bound = latest(clock, ts, span) if as_of is None else as_of - F.expr(f"INTERVAL {span}")
    return F.col(ts) >= bound


def between_dates(ts: str, start: str, end: str) -> Column:
    """Half-open: from the start of `start` to the end of the day `end`."""
    low = F.lit(start).cast("timestamp_ntz")
    high = F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return (F.col(ts) >= low) & (F.col(ts) < high)


def all_of(*conditions: Column | None) -> Column:
    """Conjunction of the conditions that are set; no condition keeps every row."""
    return reduce(lambda a, b: a & b, [c for c in conditions if c is not None], F.lit(True))


def chosen(column: str, value: str | None) -> Column | None:
    """Equality filter for a picker whose 'All' (or no choice) means no filter."""
    return None if value in (None, "All") else F.col(column) == F.lit(value)
