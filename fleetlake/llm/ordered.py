"""Groups of ordered rows without a group ever having to fit in one task's memory or in one task.

Rows are dealt by ranges of (keys, order), so a group that holds a large part of all rows is cut into
several ranges. A task streams its sorted rows. A group that lies inside one task is finished there; the
first and the last group of a task, and one larger than HELD characters, leave as pieces, and only those
meet again by key, where a second task streams them in order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetlake.llm.common import batches, written

HELD = 1 << 20
NOTHING = object()


def ordered(rows: DataFrame, keys: list[str], rest: list[str]) -> DataFrame:
    """Sorted by `keys` (nulls first), then `rest`, in ranges of `keys`; equal keys share a task."""
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys, *rest)


def values_of(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches(it):
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = HELD) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most 1,000 rows and about `size` characters."""

    def batch(held):
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= 1000 or chars >= size:
            yield batch(held)
            held, chars = [], 0
    if held:
        yield batch(held)


def folded(rows: DataFrame, keys: int, order: list[str], fold: Callable, out: str, held: int = HELD) -> DataFrame:
    """One row per group: its keys and what `fold` makes of its rows in order.

    `rows` lie as `ordered` leaves them: the first `keys` columns name the group and `order` sorts
    inside it. `fold()` has `add(values)`, for the columns after the keys, and `result()`, the values
    of the columns that `out` declares. Pieces are written, so no row is folded twice.
    """
    made = T.StructType.fromDDL(out)
    schema = T.StructType([*rows.schema, *made, T.StructField("_whole", T.BooleanType())])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    arrow, plain = to_arrow_schema(schema), len(rows.columns) - keys
    blank, none = (None,) * plain, (None,) * len(made)

    def near(it):
        def results():
            key, state, kept, chars, first = NOTHING, None, None, 0, True
            for row in values_of(it):
                own = row[:keys]
                if key is NOTHING or own != key:
                    if kept is not None and not first:
                        yield (*key, *blank, *state.result(), True)
                    first = key is NOTHING
                    key, state, kept, chars = own, fold(), None if first else [], 0
                if kept is None:
                    yield (*row, *none, False)
                    continue
                kept.append(row)
                state.add(row[keys:])
                chars += sum(len(x) for x in row if isinstance(x, str)) + 16
                if chars > held:
                    yield from ((*r, *none, False) for r in kept)
                    kept = None
            yield from ((*r, *none, False) for r in kept or [])

        yield from batched(results(), arrow)

    names = rows.columns[:keys]
    result = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema[:keys]], *made])
    result_arrow = to_arrow_schema(result)

    def far(it):
        def results():
            key, state = NOTHING, None
            for row in values_of(it):
                if key is NOTHING or row[:keys] != key:
                    if key is not NOTHING:
                        yield (*key, *state.result())
                    key, state = row[:keys], fold()
                state.add(row[keys:])
            if key is not NOTHING:
                yield (*key, *state.result())

        yield from batched(results(), result_arrow)

    parts = written(rows.mapInArrow(near, schema), "folded")
    cut = parts.filter(~F.col("_whole")).select(*rows.columns)
    cut = cut.repartition(*names).sortWithinPartitions(*names, *order).mapInArrow(far, result)
    return parts.filter("_whole").select(*result.names).unionByName(cut)
