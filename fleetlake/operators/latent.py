"""Text vectors learned from a corpus: a truncated SVD of its hashed TF-IDF matrix by block power iteration.

Tokens are hashed to FEATURES columns, rows have unit length. A random block of vectors is multiplied by the
matrix and its transpose a few times; every task adds up the products of its own rows, and the sums,
FEATURES by block numbers whatever the corpus holds, are added in row blocks before they reach the driver,
which makes the block orthonormal. The Gram matrix of the rows in that basis, added up in the same way, turns
it to the singular directions. A text's vector is its row times the basis: each is computed alone, so the
same text has the same vector in any batch.

Splitting and hashing a text costs more than a product with its row. `counted_tokens` does it once and writes
the rows; document counts, all products and the vectors of the corpus itself are read from them.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.session import scratch_dir

FEATURES, EXTRA, PART = 1 << 15, 16, 1024


class TextModel(NamedTuple):
    """idf of every hashed token, and the basis (FEATURES x dims, float32)."""

    idf: np.ndarray
    basis: np.ndarray

    def vectors(self, rows: pa.Array) -> pa.Array:
        """One vector per list of hashed tokens; zero for a text without known tokens, null for null."""
        return self._listed(_Rows.of(rows, self.idf), pc.is_null(rows))

    def counted_vectors(self, at: pa.Array, n: pa.Array) -> pa.Array:
        """The same for rows of `counted_tokens`."""
        return self._listed(_Rows.counted(at, n, self.idf), pc.is_null(at))

    def _listed(self, rows: _Rows, missing: pa.Array) -> pa.Array:
        flat = pa.array(rows.times(self.basis).ravel())
        ends = pa.array(np.arange(len(missing) + 1, dtype=np.int32) * self.basis.shape[1])
        return pa.ListArray.from_arrays(ends, flat, mask=missing)


def weighed(tokens, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of a row and their weights, the row's length being 1 (or 0)."""
    at, n = np.unique(np.asarray(tokens, np.int64), return_counts=True)
    w = n * idf[at]
    length = np.sqrt((w**2).sum())
    return at, (w / length if length > 0 else w).astype(np.float32)


def hashed_tokens(text: str | Column) -> Column:
    words = F.filter(F.split(F.lower(F.col(text) if isinstance(text, str) else text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(FEATURES)).cast("int"))


def _summed(rows: DataFrame, add, height: int, width: int) -> np.ndarray:
    """The sum over all tasks of what `add(batch of rows, out)` puts into a height x width array."""

    def tasks(it):
        total = np.zeros((height, width), np.float32)
        for batch in it:
            add(batch, total)
        for at in range(0, height, PART):
            part = total[at : at + PART]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["at", "part"])

    def merge(it):
        held: dict[int, np.ndarray] = {}
        for batch in it:
            for at, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[at] = held.get(at, 0) + np.frombuffer(part, np.float32).astype(np.float64)
        for at, part in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["at", "part"])

    kind = "at long, part binary"
    out = np.zeros((height, width))
    # Every task passes on a whole array: as many as the cores need, not as many as the table has splits.
    few = rows.coalesce(2 * rows.sparkSession.sparkContext.defaultParallelism)
    for row in few.mapInArrow(tasks, kind).repartition("at").mapInArrow(merge, kind).collect():
        part = np.frombuffer(row["part"], np.float64).reshape(-1, width)
        out[row["at"] : row["at"] + len(part)] = part
    return out


class _Rows(NamedTuple):
    """The weighed rows of a batch: row, column and weight of each entry, by row, and where the rows begin."""

    row: np.ndarray
    at: np.ndarray
    weight: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, tokens: pa.Array, idf: np.ndarray) -> _Rows:
        return cls._weighed(*_distinct(tokens), idf)

    @classmethod
    def counted(cls, at: pa.Array, n: pa.Array, idf: np.ndarray) -> _Rows:
        bounds = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(at), 0)))
        return cls._weighed(np.asarray(at.flatten()), np.asarray(n.flatten()), bounds, idf)

    @classmethod
    def _weighed(cls, at: np.ndarray, counts: np.ndarray, bounds: np.ndarray, idf: np.ndarray) -> _Rows:
        n = len(bounds) - 1
        row = np.repeat(np.arange(n), np.diff(bounds))
        w = counts * idf[at]
        length = np.sqrt(np.bincount(row, w * w, n))
        w = (w / np.where(length > 0, length, 1.0)[row]).astype(np.float32)
        return cls(row, at, w, bounds)

    def times(self, block: np.ndarray) -> np.ndarray:
        """Rows times a block, each row alone, so that its result does not depend on the batch."""
        out = np.zeros((len(self.bounds) - 1, block.shape[1]), np.float32)
        for i, (a, b) in enumerate(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)):
            out[i] = self.weight[a:b] @ block[self.at[a:b]]
        return out

    def add_back(self, products: np.ndarray, total: np.ndarray) -> None:
        """Add the transposed rows times `products`; entries are taken column by column."""
        order = np.argsort(self.at, kind="stable")  # of two-byte numbers: by radix
        row, weight = self.row[order], self.weight[order]
        sizes = np.bincount(self.at, minlength=1)
        columns = np.flatnonzero(sizes)
        ends = np.append(0, np.cumsum(sizes[columns])).tolist()
        for column, a, b in zip(columns.tolist(), ends, ends[1:], strict=False):
            total[column] += weight[a:b] @ products[row[a:b]]


def _distinct(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct columns of every row in order, how often each occurs, and where the rows begin and end."""
    n = len(tokens)
    sizes = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0))
    keys = np.repeat(np.arange(n) * FEATURES, sizes) + np.asarray(tokens.flatten())
    keys, counts = np.unique(keys, return_counts=True)
    return (keys % FEATURES).astype(np.int16), counts.astype(np.int32), np.searchsorted(keys, np.arange(n + 1) * FEATURES)


def counted_tokens(corpus: DataFrame, keep: tuple[str, ...] = (), text: str = "content") -> DataFrame:
    """The texts as rows of the matrix, written once: the columns `keep`, the distinct hashed tokens `at` in order
    and how often each occurs, `n`. Both are null for a null text and empty for one without tokens."""
    spark = corpus.sparkSession

    def counted(it):
        for batch in it:
            tokens = batch.column("_tokens")
            at, counts, bounds = _distinct(tokens)
            ends, missing = pa.array(bounds.astype(np.int32)), pc.is_null(tokens)
            lists = [pa.ListArray.from_arrays(ends, pa.array(values), mask=missing) for values in (at, counts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], names=[*keep, "at", "n"])

    fields = [T.StructField("at", T.ArrayType(T.ShortType())), T.StructField("n", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([*(corpus.schema[c] for c in keep), *fields])
    path = scratch_dir(spark, "tokens")
    corpus.select(*keep, hashed_tokens(text).alias("_tokens")).mapInArrow(counted, schema).write.parquet(path)
    return spark.read.parquet(path)


def fit_text_model(corpus: DataFrame, text: str = "content", dims: int = 256, rounds: int = 3, seed: int = 42) -> TextModel:
    """Learn the `dims` strongest directions of the TF-IDF rows of a corpus; directions it lacks are zero."""
    return fit_counted(counted_tokens(corpus, text=text), dims, rounds, seed)


def fit_counted(counted: DataFrame, dims: int = 256, rounds: int = 3, seed: int = 42) -> TextModel:
    """The same model from the rows of `counted_tokens`; null texts do not count as documents."""
    spark = counted.sparkSession
    rows = counted.where(F.col("at").isNotNull()).select("at", "n")
    n, idf = rows.count(), np.zeros(FEATURES)
    for column, df in rows.select(F.explode("at").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect():
        idf[column] = np.log((n + 1) / (df + 1))
    width = min(dims + EXTRA, FEATURES)
    basis, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(FEATURES, width)))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(basis.astype(np.float32))

        def back(batch, total):
            rows = _Rows.counted(*batch.columns, idf)
            rows.add_back(rows.times(shared.value), total)  # noqa: B023

        product = _summed(rows, back, FEATURES, width)
        basis, _ = np.linalg.qr(product + np.finfo(np.float32).tiny)
        shared.unpersist()
    shared = spark.sparkContext.broadcast(basis.astype(np.float32))

    def gram(batch, total):
        products = _Rows.counted(*batch.columns, idf).times(shared.value)
        total += products.T @ products

    strength, turn = np.linalg.eigh(_summed(rows, gram, width, width))
    order = np.argsort(-strength)[:dims]
    real = strength[order] > 1e-6 * max(strength.max(), 1e-30)
    return TextModel(idf, (basis @ (turn[:, order] * real)).astype(np.float32))


def embed_column(model: TextModel, text: str | Column) -> Column:
    """The vector of a text as array<float>; works on a batch and on a stream."""

    @F.arrow_udf("array<float>")
    def vectors(tokens: pa.Array) -> pa.Array:
        return model.vectors(tokens)

    return vectors(hashed_tokens(text))


def embed_counted(model: TextModel) -> Column:
    """The vectors of the rows of `counted_tokens`, equal to those of their texts."""

    @F.arrow_udf("array<float>")
    def vectors(at: pa.Array, n: pa.Array) -> pa.Array:
        return model.counted_vectors(at, n)

    return vectors("at", "n")
