"""Exact top-k inner products by a pivot table.

Vectors are integers (components floor(scale * x)). Distances of every vector to PIVOTS pivots are computed
once. For a query the triangle inequality gives a lower bound on its distance to each vector, the
largest over all pivots, and with both norms an upper bound on the inner product. Candidates are
scored in order of that bound until the k-th score found is above the next bound, so the result is exact.

Rows are packed into blocks of at most BLOCK vectors and stay there: queries go to them, about
QUERIES at a time, so no vector is ever copied and what a pass broadcasts does not grow. A first pass scores
the SEEDS candidates of highest bound in every block; the k-th best of these over all blocks is a score that
the second pass starts from, in every block, so that a block none of whose bounds reaches it scores nothing.

Vectors that are null, empty or hold null or non-finite components take no part; vectors are compared only
with others of their length. Ties go to the smaller id. Rows are told apart by id: repeated rows with one id
are one candidate if they are equal, and each is scored if they are not; a query that is repeated is
answered once. Empty tables give no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import batches, binary_column, bound_batches, written

PIVOTS, BLOCK, QUERIES, STEP, SEEDS = 48, 4096, 4096, 128, 16


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v: array<long>) of the vectors that take part."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    rows = vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)))
    return rows.select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def _blocks(rows: DataFrame, pivots, size: int) -> DataFrame:
    """(dim, n, ids, vectors, table): at most `size` vectors of one length, with their pivot distances."""

    def pack(it):
        held: dict[int, list] = {}

        def out(dim, parts):
            ids, x = (np.concatenate(p) for p in zip(*parts, strict=True))
            own = pivots.value.get(dim, np.zeros((1, dim)))
            for at in range(0, len(ids), size):
                block = x[at : at + size]
                table = _distances(block, own)
                columns = [pa.array([dim], pa.int32()), pa.array([len(block)], pa.int32())]
                columns += [binary_column([a.tobytes()]) for a in (ids[at : at + size], block, table)]
                yield pa.RecordBatch.from_arrays(columns, names=["dim", "n", "ids", "vectors", "tables"])

        for batch in batches(it):
            ids, lists = np.asarray(batch.column(0)), batch.column(1)
            width = np.diff(np.asarray(lists.offsets))
            flat, starts = np.asarray(lists.flatten()).astype(float), np.concatenate([[0], np.cumsum(width)])
            for dim in np.unique(width):
                own = np.flatnonzero(width == dim)
                x = flat[starts[own][:, None] + np.arange(dim)]
                held.setdefault(int(dim), []).append((ids[own], x))
                if sum(len(p[0]) for p in held[int(dim)]) >= size:
                    yield from out(int(dim), held.pop(int(dim)))
        for dim, parts in held.items():
            yield from out(dim, parts)

    return rows.mapInArrow(pack, "dim int, n int, ids binary, vectors binary, tables binary")


def best_in_block(query, own: int, norm: float, reach, x, ids, norms, table, k: int, floor: float = -np.inf, seeds: int | None = None):
    """The k best (score, id) of one block for one query that reach `floor`, and how many were scored.

    Candidates are taken in order of their bound; with `seeds` only so many.
    """
    gap = np.abs(table - reach[None, :]).max(1)
    bound = (norm + norms - gap * gap) / 2
    bound += 1e-9 * (norm + norms) + 1e-6  # more than the rounding of distances can take away
    left = np.flatnonzero((bound >= floor) & (ids != own))
    if seeds is not None and len(left) > seeds:
        left = left[np.argpartition(-bound[left], seeds - 1)[:seeds]]
    left = left[np.argsort(-bound[left])]
    scores, names, scored = np.zeros(0), np.zeros(0, np.int64), 0
    for at in range(0, len(left), STEP):
        if len(scores) == k and scores[-1] > bound[left[at]]:
            break
        part = left[at : at + STEP]
        scored += len(part)
        scores, names = np.concatenate([scores, x[part] @ query]), np.concatenate([names, ids[part]])
        order = np.lexsort((names, -scores))
        # One candidate per id and score: an id that is there twice must not take two places.
        first = np.ones(len(order), bool)
        first[1:] = (names[order[1:]] != names[order[:-1]]) | (scores[order[1:]] != scores[order[:-1]])
        order = order[first][:k]
        scores, names = scores[order], names[order]
    good = scores >= floor
    return scores[good], names[good], scored


def _scored(corpus: DataFrame, shared, k: int, seeds: int | None) -> DataFrame:
    """(query_id, vec_id, score, scored): k rows a block and query at most, `scored` counting its candidates."""

    def score(it):
        asked = shared.value
        for batch in batches(it):
            for row in batch.to_pylist():
                if row["dim"] not in asked:
                    continue
                own, q, reach, square, floors = asked[row["dim"]]
                shape = lambda raw: np.frombuffer(raw).reshape(row["n"], -1)  # noqa: B023, E731
                ids, x, table = np.frombuffer(row["ids"], np.int64), shape(row["vectors"]), shape(row["tables"])
                norms = (x**2).sum(1)
                found = [best_in_block(q[i], own[i], square[i], reach[i], x, ids, norms, table, k, floors[i], seeds) for i in range(len(q))]
                names, counts = np.repeat(own, [len(f[0]) for f in found]), np.repeat([f[2] for f in found], [len(f[0]) for f in found])
                scores, hits = (np.concatenate([f[j] for f in found]) for j in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(hits), pa.array(scores.astype(np.int64)), pa.array(counts.astype(np.int64))],
                    names=["query_id", "vec_id", "score", "scored"],
                )

    return corpus.mapInArrow(score, "query_id long, vec_id long, score long, scored long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rows = found.select("query_id", "vec_id", "score").distinct()
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _asked(rows, pivots: dict, floors: dict) -> dict:
    """dim -> ids, vectors, pivot distances, squared lengths, floors of the queries of a pass."""
    by_dim: dict[int, dict] = {}
    for row in rows:
        by_dim.setdefault(len(row["v"]), {})[row["id"], tuple(row["v"])] = row["v"]
    out = {}
    for dim, own in by_dim.items():
        ids, x = np.array([i for i, _ in own], np.int64), np.array(list(own.values()), float)
        reach = _distances(x, pivots.get(dim, np.zeros((1, dim))))
        out[dim] = (ids, x, reach, (x**2).sum(1), np.array([floors.get(int(i), -np.inf) for i in ids]))
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `queries` the k highest inner products with the
    rows of `vectors` other than its own id. Inner products must stay below 2**53."""
    spark = vectors.sparkSession
    context = spark.sparkContext
    bound_batches(spark)
    rows = integer_vectors(vectors, id_col, vector_col, scale)
    first = rows.select(F.size("v").alias("dim"), "v").orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()
    chosen: dict[int, list] = {}
    for row in first:
        chosen.setdefault(row["dim"], []).append(row["v"])
    table = {d: np.array(v, float) for d, v in chosen.items()}
    pivots = context.broadcast(table)
    corpus = written(_blocks(rows, pivots, BLOCK), "vector-blocks")
    wanted = written(integer_vectors(queries, id_col, vector_col, scale), "query-vectors")
    passes = -(-2 * wanted.count() // QUERIES)
    results = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for number in range(passes):
        asked = wanted.filter(F.pmod(F.xxhash64("id"), F.lit(passes)) == number).collect()
        shared = context.broadcast(_asked(asked, table, {}))
        seeds = _best(_scored(corpus, shared, k, max(SEEDS, k)), k).filter(F.col("rank") == k).collect()
        shared.unpersist()
        shared = context.broadcast(_asked(asked, table, {r["query_id"]: float(r["score"]) for r in seeds}))
        found = written(_best(_scored(corpus, shared, k, None), k), "top-k")
        shared.unpersist()
        results = results.unionByName(found)
    return results.select("query_id", "rank", "vec_id", "score")
