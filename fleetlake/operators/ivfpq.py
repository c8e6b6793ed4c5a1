"""Approximate nearest neighbours: inverted lists over k-means cells with product-quantised residuals.

Fitting runs Lloyd rounds on the executors over a bounded sample: a task adds its vectors up per centre and
passes on sums and counts. A vector belongs to the cell of its nearest centre; what is left of it is cut
into subspaces, each replaced by the number of the nearest entry of a codebook. A query looks into its
nearest cells, as many as hold `rerank` vectors and `probes` at least, and scores codes by adding table
entries. How many cells that is can be calibrated on exact neighbours of a sample. The best `rerank` by these scores are scored again on the vectors themselves.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetlake.operators.ranking import top_per_group
from fleetlake.operators.retrieval import cosine, top_k
from fleetlake.session import scratch_dir
from fleetlake.sinks.tables import save_scratch

LIST_ROWS = 4096


class Quantiser(NamedTuple):
    """Centres of the cells and, per subspace, the codebook of residuals."""

    centres: np.ndarray  # cells x dims
    books: list  # per subspace: codes x its dims
    bounds: np.ndarray  # where subspaces begin, one more than subspaces

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x, self.centres)

    def codes(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        rest = x - self.centres[cells]
        cut = [rest[:, a:b] for a, b in zip(self.bounds[:-1], self.bounds[1:], strict=True)]
        return np.stack([nearest(part, book) for part, book in zip(cut, self.books, strict=True)], axis=1).astype(np.uint8)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """queries x subspaces x 256: what each code adds to a query's inner product."""
        out = np.zeros((len(queries), len(self.books), 256), np.float32)
        for j, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:], strict=True)):
            out[:, j, : len(self.books[j])] = queries[:, a:b] @ self.books[j].T
        return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1)[None, :] - 2 * (x @ centres.T), axis=1)


def unit_rows(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of unit length of the vectors of `dims` finite components and some length, and their places."""
    lists = column.cast(pa.list_(pa.float64()))
    width = np.diff(np.asarray(lists.offsets))
    good = np.asarray(column.is_valid()) & (width == dims)
    flat = lists.flatten()
    values = np.asarray(flat.fill_null(float("nan")))
    starts = np.concatenate([[0], np.cumsum(width)])[:-1]
    places = np.flatnonzero(good)
    x = values[starts[places][:, None] + np.arange(dims)] if len(places) else np.zeros((0, dims))
    length = np.sqrt((x**2).sum(1))
    kept = np.isfinite(length) & (length > 0)
    return x[kept] / length[kept][:, None], places[kept]


def _rounds(sample: DataFrame, dims: int, parts: list, groups, rounds: int) -> list:
    """Lloyd rounds for several sets of centres at once; `groups(x)` gives the points of each set."""
    for _ in range(rounds):
        shared = sample.sparkSession.sparkContext.broadcast(parts)

        def add(it):
            sums = [np.zeros((len(p), p.shape[1] + 1)) for p in shared.value]  # noqa: B023
            for batch in it:
                x, _ = unit_rows(batch.column(0), dims)
                for total, own, points in zip(sums, shared.value, groups(x), strict=True):  # noqa: B023
                    at = nearest(points, own)
                    np.add.at(total, at, np.column_stack([points, np.ones(len(points))]))
            for part, total in enumerate(sums):
                used = np.flatnonzero(total[:, -1])
                columns = [pa.array(np.full(len(used), part)), pa.array(used), pa.array(list(total[used]), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "centre", "sums"])

        cells = sample.mapInArrow(add, "part long, centre long, sums array<double>").select("part", "centre", F.posexplode("sums"))
        added = cells.groupBy("part", "centre", "pos").agg(F.sum("col").alias("total"))
        new = [np.zeros((len(p), p.shape[1] + 1)) for p in parts]
        for row in added.collect():  # as many numbers as the centres have
            new[row["part"]][row["centre"], row["pos"]] = row["total"]
        # A centre that nothing is nearest to stays where it is.
        parts = [np.where(n[:, -1:] > 0, n[:, :-1] / np.maximum(n[:, -1:], 1), old) for n, old in zip(new, parts, strict=True)]
        shared.unpersist()
    return parts


def fit(vectors: DataFrame, row_id: str, vector: str = "embedding", cells: int | None = None, subspaces: int = 16, codes: int = 256, rounds: int = 6, sample_rows: int = 65_536) -> Quantiser | None:
    """Fit on at most about `sample_rows` vectors, chosen by a hash of their id; None without any vector.

    The default number of cells is the root of the number of rows, 4,096 at most.
    """
    x = F.col(vector)
    usable = vectors.where(x.isNotNull() & (F.size(x) > 0)).select(row_id, vector)
    rows, dims = usable.agg(F.count(F.lit(1)), F.max(F.size(x))).first()
    if not rows:
        return None
    share = min(1.0, sample_rows / rows)
    drawn = usable.where(F.pmod(F.xxhash64(row_id), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    path = scratch_dir(vectors.sparkSession, "quantiser")
    drawn.write.parquet(path)
    sample = vectors.sparkSession.read.parquet(path).select(vector)
    cells = cells or int(min(4096, max(1, rows**0.5)))
    first = vectors.sparkSession.read.parquet(path).orderBy(F.xxhash64(row_id, F.lit(1)), row_id).limit(max(cells, codes)).select(vector).toArrow()
    seeds, _ = unit_rows(first.column(0).combine_chunks(), dims)
    if not len(seeds):
        return None
    (centres,) = _rounds(sample, dims, [np.unique(seeds[:cells], axis=0)], lambda x: [x], rounds)
    bounds = np.linspace(0, dims, min(subspaces, dims) + 1).astype(int)

    def residuals(x):
        rest = x - centres[nearest(x, centres)]
        return [rest[:, a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    books = [np.unique(part[:codes], axis=0) for part in residuals(seeds)]
    return Quantiser(centres, _rounds(sample, dims, books, residuals, rounds), bounds)


def inverted_lists(vectors: DataFrame, row_id: str, model: Quantiser, vector: str = "embedding") -> DataFrame:
    """(cell, n, ids, codes): lists of at most LIST_ROWS vectors of one cell, packed where the rows lie, so
    a cell that holds a large part of all vectors is many lists."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    kind = vectors.schema[row_id].dataType

    def pack(it):
        quantiser, held = shared.value, {}
        dims = quantiser.centres.shape[1]

        def out(cell):
            ids, codes = (list(c) for c in zip(*held.pop(cell), strict=True))
            ids, codes = pa.concat_arrays(ids), np.concatenate(codes)
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            columns = [pa.array([cell], pa.int64()), pa.array([len(ids)], pa.int64()), lists, pa.array([codes.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["cell", "n", "ids", "codes"])

        for batch in it:
            x, places = unit_rows(batch.column(1), dims)
            cells = quantiser.cells(x)
            codes = quantiser.codes(x, cells)
            for cell in np.unique(cells).tolist():
                own = np.flatnonzero(cells == cell)
                for at in range(0, len(own), LIST_ROWS):
                    part = own[at : at + LIST_ROWS]
                    held.setdefault(cell, []).append((batch.column(0).take(pa.array(places[part])), codes[part]))
                    if sum(len(h[0]) for h in held[cell]) >= LIST_ROWS:
                        yield out(cell)
        for cell in list(held):
            yield out(cell)

    schema = T.StructType(
        [T.StructField("cell", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("codes", T.BinaryType())]
    )
    path = scratch_dir(vectors.sparkSession, "lists")
    vectors.select(row_id, vector).where(F.col(vector).isNotNull() & F.col(row_id).isNotNull()).mapInArrow(pack, schema).write.parquet(path)
    return vectors.sparkSession.read.schema(schema).parquet(path)


def probed(model: Quantiser, queries: np.ndarray, sizes: np.ndarray, probes: int, least: int) -> list[np.ndarray]:
    """The cells each query looks into, nearest first: `probes` or more, until they hold `least` vectors."""
    order = np.argsort((model.centres**2).sum(1)[None, :] - 2 * (queries @ model.centres.T), axis=1, kind="stable")
    held = np.cumsum(sizes[order], axis=1)
    counts = np.maximum((held < least).sum(1) + 1, probes)
    return [cells[:n] for cells, n in zip(order, counts, strict=True)]


def _pass(names: list, x: np.ndarray, lists: DataFrame, model: Quantiser, sizes: np.ndarray, query_id: T.StructField, row_id: T.StructField, probes: int, rerank: int) -> DataFrame:
    """(query_id, row_id, near): the `rerank` best of every query by code scores, a few more over all tasks."""
    asks: dict[int, list] = {}
    for q, cells in enumerate(probed(model, x, sizes, probes, rerank)):
        for cell in cells.tolist():
            asks.setdefault(cell, []).append(q)
    shared = lists.sparkSession.sparkContext.broadcast((asks, names, x @ model.centres.T, model.tables(x)))
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in (query_id, row_id)], T.StructField("near", T.DoubleType())])

    def scan(it):
        own_asks, own_names, centre, tables = shared.value
        for batch in it:
            for i in range(batch.num_rows):
                cell, n = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if cell not in own_asks:
                    continue
                ids = batch.column(2)[i].values
                codes = np.frombuffer(batch.column(3)[i].as_py(), np.uint8).reshape(n, -1)
                for q in own_asks[cell]:
                    score = centre[q, cell] + tables[q][np.arange(codes.shape[1])[None, :], codes].sum(1, dtype=np.float64)
                    best = np.argpartition(-score, rerank - 1)[:rerank] if n > rerank else np.arange(n)
                    asked = pa.array([own_names[q]] * len(best), arrow.field(0).type)
                    yield pa.RecordBatch.from_arrays([asked, ids.take(pa.array(best)), pa.array(score[best])], schema=arrow)

    arrow = to_arrow_schema(schema)
    wanted = lists.where(F.col("cell").isin(list(asks))) if len(asks) <= 256 else lists
    return wanted.mapInArrow(scan, schema)


def search(queries: DataFrame, vectors: DataFrame, model: Quantiser, lists: DataFrame, query_id: str, row_id: str, k: int = 3, vector: str = "embedding", probes: int = 8, rerank: int = 256, block: int = 4096) -> DataFrame:
    """(query_id, row_id, score, rank) by cosine; k rows per query wherever there are k vectors.

    Queries go in passes of about `block`, so what is broadcast does not grow with their number.
    """
    spark = vectors.sparkSession
    dims, rerank = model.centres.shape[1], max(rerank, k)
    sizes = np.zeros(len(model.centres), np.int64)
    for row in lists.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        sizes[row["cell"]] = row["n"]
    asked = queries.select(query_id, vector).where(F.col(vector).isNotNull())
    passes = max(1, -(-asked.count() // block))
    found = None
    for number in range(passes):
        part = asked.where(F.pmod(F.xxhash64(query_id), F.lit(passes)) == number).toArrow()
        x, places = unit_rows(part.column(1).combine_chunks(), dims) if part.num_rows else (np.zeros((0, dims)), [])
        names = part.column(0).take(pa.array(places, pa.int64())).to_pylist()
        near = _pass(names, x, lists, model, sizes, queries.schema[query_id], vectors.schema[row_id], probes, rerank)
        found = near if found is None else found.unionByName(near)
    best = top_per_group(found, [query_id], rerank, F.desc("near"), row_id).select(query_id, row_id)
    path = scratch_dir(spark, "near")
    best.write.parquet(path)
    best = spark.read.schema(best.schema).parquet(path)
    mine = vectors.select(row_id, F.col(vector).alias("_vector"))
    both = best.join(mine, row_id).join(asked.select(query_id, F.col(vector).alias("_asked")), query_id)
    scored = both.select(query_id, row_id, F.round(cosine(F.col("_asked"), F.col("_vector")), 10).alias("score"))
    return top_per_group(scored, [query_id], k, F.desc("score"), row_id)


def calibrated(model: Quantiser, queries: DataFrame, vectors: DataFrame, query_id: str, row_id: str, k: int, vector: str, target: float, sample: int = 64) -> int:
    """How many cells to look into so that they hold `target` of the exact neighbours of a sample: up to
    `sample` queries and as many vectors, each set chosen by a hash of its id."""

    def chosen(df, name):
        return df.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(name, F.lit(2)), name).limit(sample).select(F.col(name).alias("_asked"), vector)

    ranks, dims = [], model.centres.shape[1]
    for rows, own in ((chosen(queries, query_id), False), (chosen(vectors, row_id), True)):
        rows = save_scratch(rows, "sampled-queries")
        hits = top_k(rows, vectors, "_asked", row_id, k + own, vector)
        hits = hits.where(F.col("_asked") != F.col(row_id)) if own else hits
        pairs = hits.join(vectors.select(row_id, vector), row_id).join(rows.withColumnRenamed(vector, "_query"), "_asked")
        found = pairs.select("_query", vector).toArrow()
        if found.num_rows:
            one, two = (unit_rows(found.column(i).combine_chunks(), dims)[0] for i in (0, 1))
            order = np.argsort((model.centres**2).sum(1)[None, :] - 2 * (one @ model.centres.T), axis=1, kind="stable")
            ranks.append(np.argmax(order == model.cells(two)[:, None], axis=1))
    return max((int(np.quantile(r, target, method="higher")) + 1 for r in ranks), default=1)


def top_k_approx(
    queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str, k: int = 3, vector: str = "embedding", probes: int | None = None,
    rerank: int = 256, target: float = 0.97, **fitting,
) -> DataFrame:
    """Approximate cosine neighbours over an index of the whole corpus: same columns as `top_k`.

    Without `probes`, their number is calibrated to `target`. `fitting` goes to `fit`.
    """
    model = fit(corpus, corpus_id, vector, **fitting)
    if model is None:
        kinds = [queries.schema[query_id], corpus.schema[corpus_id], T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())]
        return corpus.sparkSession.createDataFrame([], T.StructType(kinds))
    lists = inverted_lists(corpus, corpus_id, model, vector)
    probes = probes or calibrated(model, queries, corpus, query_id, corpus_id, k, vector, target)
    return search(queries, corpus, model, lists, query_id, corpus_id, k, vector, probes, rerank)
