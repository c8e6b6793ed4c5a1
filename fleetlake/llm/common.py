"""What the operators share: table reading, written intermediate tables, words and hashes of texts.

Texts reach Python as Arrow batches whose character buffer is used in place: words, their hashes and
the hashes of word windows come from NumPy passes over the whole batch, with no Python object per
word. A word is a run of bytes outside `[\\x20\\x09-\\x0D]`.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fleetlake.session import scratch_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Odd 64-bit bases: one for bytes, one for words, and one more of each for the second hash.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = 1000, size: int = 1 << 20) -> None:
    """Hand texts to Python in batches of at most `rows` rows and about `size` bytes.

    Only Spark's own default (10,000 rows of any length) is replaced; a caller's setting stays. Python
    workers are also told where the driver has this package, for nodes that share its folder and do
    not have it installed.
    """
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, known) if p)
    if spark.conf.get(BATCH_ROWS, "10000") == "10000":
        spark.conf.set(BATCH_ROWS, str(rows))
        spark.conf.set(BATCH_BYTES, str(size))


#: What the allocators of Python workers are told: large arrays go back to the system when they are freed.
LEAN = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576", "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def lean_workers(spark: SparkSession) -> None:
    """For work of many steps: texts go to Python a quarter of a megabyte at a time, and workers give freed
    memory back. They live through all steps beside a JVM that never shrinks, so what they keep adds up.

    A caller's own batch settings stay; so do the caller's settings for the allocators.
    """
    if spark.conf.get(BATCH_ROWS, "10000") == "10000":
        bound_batches(spark, size=1 << 18)
    bound_batches(spark)
    for name, value in LEAN.items():
        spark.sparkContext.environment.setdefault(name, value)


@contextmanager
def _freed_shuffles(spark: SparkSession):
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written below `spark.checkpoint.dir` and read back: lineage ends there.

    Shuffle files of the job are removed when it ends, so steps do not pile up on local disks.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with _freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Remove the files of tables made by `written` that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        folders = {name.rpartition("/")[0] for name in df.inputFiles()}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Recent(dict):
    """A cache of two generations of at most `size` entries each; a used entry moves to the younger.

    When the younger is full it becomes the older one, and what nobody asked for since then is
    forgotten. `made` gives the value of a key that neither has.
    """

    def __init__(self, size: int):
        super().__init__()
        self.size, self.older = size, {}

    def made(self, key):
        raise KeyError(key)

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.made(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value

    def absent(self, keys) -> list:
        """Which of `keys` neither generation has, each once."""
        older = self.older
        return [k for k in dict.fromkeys(keys) if k not in self and k not in older]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (one bound more than texts); null is empty."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64, kept between batches up to four million entries."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if len(known) <= 1 << 22:
            _POWERS[base] = known
    return known[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each span, from one running sum."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    undo = powers(pow(base, -1, 1 << 64), len(values) + 1)
    return (sums[ends] - sums[starts]) * undo[starts]


class Words(NamedTuple):
    data: np.ndarray
    bounds: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # number of the first word of each text, one more than texts

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; `which` 0 or 1 selects one of two independent hashes."""
        codes = self.data.astype(np.uint64) + np.uint64(1)
        raw = span_hashes(codes, self.start, self.end, BASES[2 * which])
        return mixed(raw ^ ((self.end - self.start).astype(np.uint64) << np.uint64(48)))


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that stay within one text."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    np.logical_not(inside[:-1], out=before[1:])
    np.logical_not(inside[1:], out=after[:-1])
    before[bounds[:-1][bounds[:-1] < n]] = True
    after[bounds[1:][bounds[1:] > 0] - 1] = True
    return np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """The words of every text of a batch; `lower` turns A-Z into a-z first."""
    data, bounds = text_bytes(column)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    start, end = runs(~WHITE[data], bounds)
    doc = np.searchsorted(bounds, start, side="right") - 1
    first = np.searchsorted(doc, np.arange(len(bounds)))
    return Words(data, bounds, doc, start, end, first)


def binary_column(items: list[bytes]) -> pa.Array:
    return pa.array(items, pa.binary())


def packed(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """values[bounds[i]:bounds[i+1]] as little-endian bytes, for each i."""
    raw, width = np.ascontiguousarray(values).tobytes(), values.dtype.itemsize
    return [raw[a * width : b * width] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that hold rows."""
    return (b for b in it if b.num_rows)
