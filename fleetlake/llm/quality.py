"""A quality score from statistics of whole texts, by regularised quadratic discriminant analysis.

Each text gives STATISTICS numbers (shares of byte classes, word and line shapes, repetition), taken on a log
scale. Per class the labelled rows are reduced to count, sums and products, which are added over the
cluster: all labelled rows count, and what reaches the driver has a fixed size. Covariances are shrunk
towards their diagonal and, by a smaller part, towards the pooled variance; their Cholesky factors are
computed once and sent with the model. A score is the logistic of the log-density difference (from
Mahalanobis distances) plus the log prior odds.

Null and empty texts are scored like any other text, from zero counts. With no labelled row of one
class the model cannot tell them apart: every score is then the share of class 1 (0.5 without any).
Labels other than 0 and 1 and null labels are ignored; of repeated labels each counts, as does each of
repeated documents, and each comes back with a score. An empty table of documents gives no rows. Whole texts
count, whatever their length. `columns` may be called anything but `score` and `predicted`, which are added.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm.common import BASES, Words, batches, bound_batches, mixed, runs, text_bytes, words_of

LOWER, UPPER, DIGIT, SPACE, BREAK, STOP, MARK, HIGH, OTHER = range(9)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[128:] = LOWER, UPPER, DIGIT, HIGH
CLASS[[9, 32]], CLASS[[10, 11, 12, 13]] = SPACE, BREAK
CLASS[[ord(c) for c in ".,;:?'\"()-"]] = STOP
CLASS[[ord(c) for c in "!#$%&*|=<>_~^@+/\\"]] = MARK
STATISTICS = (
    "words", "upper", "digit", "break", "stop", "mark", "high", "word_length", "word_spread", "capitals",
    "marked_words", "bare_marks", "distinct_words", "stutters", "repeated_triples", "repeated_lines", "line_length",
)


def _share(part, whole):
    return (part + 0.02) / (whole + 1.0)


def _distinct(doc: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each of n texts has."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return np.bincount(doc[new], minlength=n)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text."""
    words = words_of(column)
    data, bounds, n = words.data, words.bounds, len(words.bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    kinds = np.bincount(owner * 9 + CLASS[data], minlength=9 * n).reshape(n, 9).astype(float)
    size = kinds.sum(1)
    count = np.bincount(words.doc, minlength=n).astype(float)
    length = (words.end - words.start).astype(float)
    mean = np.bincount(words.doc, length, n) / np.maximum(count, 1)
    square = np.bincount(words.doc, length**2, n) / np.maximum(count, 1)
    first, last = CLASS[data[words.start]], CLASS[data[words.end - 1]]
    marked = np.bincount(words.doc, last == MARK, n)
    bare = np.bincount(words.doc, (first == MARK) & (last == MARK), n)
    capitals = np.bincount(words.doc, (first == UPPER) & (CLASS[data[np.minimum(words.start + 1, words.end - 1)]] == UPPER), n)
    hashes = words.hashes()
    same = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    stutters = np.bincount(words.doc[1:][same], minlength=n)
    triples = hashes[:-2] + hashes[1:-1] * np.uint64(BASES[1]) + hashes[2:] * np.uint64(BASES[2]) if len(hashes) > 2 else hashes[:0]
    whole = words.doc[:-2] == words.doc[2:] if len(hashes) > 2 else np.zeros(0, bool)
    n_triples = np.bincount(words.doc[:-2][whole], minlength=n) if len(hashes) > 2 else np.zeros(n, int)
    again = n_triples - (_distinct(words.doc[:-2][whole], mixed(triples[whole]), n) if len(hashes) > 2 else 0)
    start, end = runs(CLASS[data] != BREAK, bounds)
    lines = Words(data, bounds, np.searchsorted(bounds, start, side="right") - 1, start, end, bounds)
    n_lines = np.bincount(lines.doc, minlength=n).astype(float)
    again_lines = n_lines - _distinct(lines.doc, lines.hashes(), n)
    columns = [
        count + 1,
        *(_share(kinds[:, k], size) for k in (UPPER, DIGIT, BREAK, STOP, MARK, HIGH)),
        mean + 1,
        np.sqrt(np.maximum(square - mean**2, 0)) + 1,
        _share(capitals, count),
        _share(marked, count),
        _share(bare, count),
        (_distinct(words.doc, hashes, n) + 1) / (count + 1),
        _share(stutters, count),
        _share(again, n_triples),
        _share(again_lines, n_lines),
        size / np.maximum(n_lines, 1) + 1,
    ]
    return np.log(np.stack(columns, 1) + 1e-3)


class Discriminant(NamedTuple):
    prior: float  # share of class 1
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray | None
    factors: np.ndarray | None  # inverse Cholesky factors
    logdets: np.ndarray | None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        z = (x - self.centre) / self.scale
        density = [-0.5 * (((z - m) @ f.T) ** 2).sum(1) - 0.5 * d for m, f, d in zip(self.means, self.factors, self.logdets, strict=True)]
        odds = density[1] - density[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def solved(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float, flatten: float) -> Discriminant:
    """The model from (rows, sums, products) per class."""
    d = len(STATISTICS)
    rows = sum(m[0] for m in moments.values())
    prior = moments.get(1, (0,))[0] / rows if rows else 0.5
    if len(moments) < 2:
        return Discriminant(prior, np.zeros(d), np.ones(d), None, None, None)
    centre = sum(m[1] for m in moments.values()) / rows
    scale = np.sqrt(np.maximum(np.diag(sum(m[2] for m in moments.values())) / rows - centre**2, 1e-6))
    means, factors, logdets = [], [], []
    for label in (0, 1):
        n, sums, products = moments[label]
        mean = sums / n
        cov = (products / n - np.outer(mean, mean)) / np.outer(scale, scale)
        weight = min(1.0, shrink + d / (n + d))
        cov = (1 - weight) * cov + weight * np.diag(np.diag(cov))
        cov = (1 - flatten) * cov + flatten * np.eye(d)
        lower = np.linalg.cholesky(cov)
        means.append((mean - centre) / scale)
        factors.append(np.linalg.inv(lower))
        logdets.append(2 * np.log(np.diag(lower)).sum())
    return Discriminant(prior, centre, scale, np.array(means), np.array(factors), np.array(logdets))


def measured(docs: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """`columns` of every row with `statistics`, the numbers of its text: what training joins labels to."""
    bound_batches(docs.sparkSession)
    schema = docs.select(*columns).schema.add("statistics", T.ArrayType(T.DoubleType()))
    names = schema.names

    def measure(it):
        for batch in batches(it):
            x = statistics(batch.column(batch.num_columns - 1))
            bounds = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(bounds, pa.array(x.ravel()))], names=names)

    return docs.select(*columns, F.col(text_col).cast("string").alias("__text")).mapInArrow(measure, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(STATISTICS))


def fit(labelled: DataFrame, label_col: str = "quality", shrink: float = 0.1, flatten: float = 0.3) -> Discriminant:
    """Fit on rows (statistics, label). One row of moments per class and task is added up by Spark."""
    bound_batches(labelled.sparkSession)
    d = len(STATISTICS)

    def moments(it):
        total: dict[int, list] = {}
        for batch in batches(it):
            x, y = _matrix(batch.column(0)), np.asarray(batch.column(1))
            for label in (0, 1):
                own = x[y == label]
                if len(own):
                    part = np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
                    total[label] = total.get(label, 0) + part
        labels = [k for k, v in total.items() for _ in v]
        places = [i for v in total.values() for i in range(len(v))]
        values = [float(x) for v in total.values() for x in v]
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(places, pa.int32()), pa.array(values, pa.float64())], names=["label", "place", "value"])

    rows = labelled.select("statistics", F.col(label_col).cast("int").alias("label"))
    sums = rows.filter("label in (0, 1)").mapInArrow(moments, "label int, place int, value double")
    found: dict[int, np.ndarray] = {}
    for row in sums.groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
        found.setdefault(row["label"], np.zeros(1 + d + d * d))[row["place"]] = row["value"]
    return solved({k: (v[0], v[1 : d + 1], v[d + 1 :].reshape(d, d)) for k, v in found.items()}, shrink, flatten)


def scored(rows: DataFrame, model: Discriminant, columns: list[str], text_col: str | None = None) -> DataFrame:
    """`columns` of every row with `score` and `predicted` (1 from a score of 0.5 on), from its text
    where `text_col` is named, else from its `statistics`."""
    bound_batches(rows.sparkSession)
    schema = rows.select(*columns).schema.add("score", T.DoubleType()).add("predicted", T.IntegerType())
    names = schema.names

    def score(it):
        for batch in batches(it):
            last = batch.column(batch.num_columns - 1)
            values = model.scores(statistics(last) if text_col else _matrix(last))
            arrays = [*batch.columns[:-1], pa.array(values), pa.array((values >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    basis = F.col(text_col).cast("string") if text_col else F.col("statistics")
    return rows.select(*columns, basis.alias("__basis")).mapInArrow(score, schema)


def training_rows(known: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """(statistics, quality) of labelled rows (doc_id, statistics) outside the held-out fold, by crc32 of
    the id as text. Texts do not move: labels meet the statistics only."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    rated = labels.filter(F.col("quality").isNotNull()).filter(fold != held).select("doc_id", "quality")
    return known.select("doc_id", "statistics").join(rated, "doc_id").select("statistics", "quality")
