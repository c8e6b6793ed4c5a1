"""Vectors from text, exact and approximate nearest neighbours, index refresh, context."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.text import preview
from fleetlake.operators.latent import TextModel, embed_column, fit_text_model
from fleetlake.operators.ranking import top_per_group
from fleetlake.sinks.changes import diff_snapshots


def text_embedder(corpus: DataFrame, text: str = "content", dims: int = 256) -> TextModel:
    """Fit text vectors of `dims` numbers on a corpus (see `latent`).

    It stands where a hosted embedding model would; any other model that fills the same `embedding`
    column fits the operators below.
    """
    return fit_text_model(corpus, text, dims)


def embed(df: DataFrame, model: TextModel, text: str = "content") -> DataFrame:
    """Add `embedding` as array<float>."""
    return df.withColumn("embedding", embed_column(model, text))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two float arrays in double precision; null if either has no length."""

    def dot(x, y):
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _best_per_query(k: int):
    """Function (unit queries, ids, vectors) -> frame of the k best (q, id, score) per query, without those
    below a floor per query.

    A closure, so that it travels to the tasks by value.
    """

    def unit_rows(vectors) -> np.ndarray:
        matrix = np.stack(list(vectors)).astype(np.float64)
        length = np.linalg.norm(matrix, axis=1)[:, None]
        return np.divide(matrix, length, out=np.full_like(matrix, np.nan), where=length > 0)

    def best(queries: np.ndarray, ids, vectors, least: np.ndarray | float = -np.inf) -> pd.DataFrame:
        # Rounded, so that equal vectors tie whatever their place in a product.
        scores = np.round(queries @ unit_rows(vectors).T, 10)
        ranked = np.where(np.isnan(scores), -np.inf, scores)
        keep = min(k, ranked.shape[1])
        # The k-th best score of each query; ties with it all stay for the final order.
        floor = np.maximum(-np.partition(-ranked, keep - 1, axis=1)[:, keep - 1], least)
        at_query, at_row = np.nonzero((ranked >= floor[:, None]) & np.isfinite(ranked))
        found = pd.DataFrame({"q": at_query, "id": np.asarray(ids)[at_row], "score": scores[at_query, at_row]})
        return found.sort_values(["q", "score", "id"], ascending=[True, False, True]).groupby("q").head(k)

    def merge(one: pd.DataFrame | None, two: pd.DataFrame) -> pd.DataFrame:
        both = two if one is None else pd.concat([one, two], ignore_index=True)
        return both.sort_values(["q", "score", "id"], ascending=[True, False, True]).groupby("q").head(k)

    def floors(top: pd.DataFrame, queries: int) -> np.ndarray:
        """The k-th score of each query so far."""
        found = np.full(queries, -np.inf)
        last = top[top.groupby("q").cumcount() == k - 1]
        found[last["q"].to_numpy()] = last["score"].to_numpy()
        return found

    return unit_rows, best, merge, floors


def top_k(
    queries: DataFrame,
    corpus: DataFrame,
    query_id: str,
    corpus_id: str,
    k: int = 3,
    vector: str = "embedding",
    block: int = 4096,
    cell: int = 50_000,
) -> DataFrame:
    """Exact cosine neighbours: (query_id, corpus_id, score, rank), ties by corpus_id.

    Up to `block` queries, counted first, are sent to the tasks as one matrix and the corpus stays
    where it is: each task multiplies its Arrow batches with the matrix and keeps the k best per
    query, so it passes on k rows per query and the shuffle does not grow with the corpus. A larger
    query set is cut into blocks and the corpus into cells of about `cell` rows, and every block
    meets every cell in a task of its own: exact as well, with nothing held by the driver. Vectors
    without length are never a hit.
    """
    asked = queries.select(query_id, vector).where(F.col(vector).isNotNull())
    held = corpus.select(corpus_id, vector).where(F.col(vector).isNotNull())
    schema = T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(corpus_id, corpus.schema[corpus_id].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    first = asked.limit(block + 1).collect()
    search = _scan if len(first) <= block else _grid
    hits = search(first, asked, held, query_id, corpus_id, k, vector, block, cell, schema)
    return top_per_group(hits, [query_id], k, F.col("score").desc(), F.col(corpus_id).asc())


def _scan(first, asked, held, query_id, corpus_id, k, vector, block, cell, schema) -> DataFrame:
    unit_rows, best, merge, floors = _best_per_query(k)
    if not first:
        return held.sparkSession.createDataFrame([], schema)
    shared = held.sparkSession.sparkContext.broadcast(([r[0] for r in first], unit_rows([r[1] for r in first])))

    def search(frames: Iterator) -> Iterator:
        names, matrix = shared.value
        top, least = None, -np.inf
        for frame in frames:
            for at in range(0, len(frame), 1000):
                rows = frame.iloc[at : at + 1000]
                found = best(matrix, rows[corpus_id].to_numpy(), rows[vector], least)
                if top is None or len(found):
                    top = merge(top, found)
                    least = floors(top, len(matrix))
        if top is not None and len(top):
            yield pd.DataFrame(
                {query_id: [names[i] for i in top["q"]], corpus_id: top["id"].to_numpy(), "score": top["score"].to_numpy()}
            )

    return held.mapInPandas(search, schema)


def _grid(first, asked, held, query_id, corpus_id, k, vector, block, cell, schema) -> DataFrame:
    unit_rows, best, *_ = _best_per_query(k)
    # Half full on average, so that uneven hashing stays within the intended sizes.
    blocks, cells = -(-2 * asked.count() // block), max(1, -(-2 * held.count() // cell))

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = asked.withColumn("_block", F.pmod(F.xxhash64(query_id), F.lit(blocks)).cast("int")).withColumn("_cell", every(cells))
    right = held.withColumn("_cell", F.pmod(F.xxhash64(corpus_id), F.lit(cells)).cast("int")).withColumn("_block", every(blocks))

    def meet(some: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if some.empty or rows.empty:
            return pd.DataFrame({query_id: [], corpus_id: [], "score": []})
        top = best(unit_rows(some[vector]), rows[corpus_id].to_numpy(), rows[vector])
        return pd.DataFrame(
            {query_id: some[query_id].to_numpy()[top["q"]], corpus_id: top["id"].to_numpy(), "score": top["score"].to_numpy()}
        )

    grid = ["_block", "_cell"]
    return left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInPandas(meet, schema)


def centroids(vectors: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per group: one typical query per class of a vector table.

    Averages are taken per (group, position), so a large group is combined on the map side.
    """
    cells = vectors.select(group, F.posexplode(vector).alias("position", "x"))
    means = cells.groupBy(group, "position").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "x"))), lambda c: c["x"]).alias(vector)
    )


def index_changes(indexed: DataFrame, chunks: DataFrame, key: str = "chunk_id", text: str = "content") -> DataFrame:
    """Chunks whose content differs from what the index was built from: `_change` per key.

    `indexed` carries (key, content_hash). Hashes are compared, so unchanged text is not moved.
    """
    now = chunks.select(key, F.sha2(F.col(text), 256).alias("content_hash"))
    return diff_snapshots(indexed.select(key, "content_hash"), now, [key])


def refresh_index(
    index: DataFrame, chunks: DataFrame, model: TextModel, key: str = "chunk_id", text: str = "content"
) -> DataFrame:
    """New state of the index (key, content_hash, embedding): only inserts and updates are embedded."""
    changes = index_changes(index, chunks, key, text)
    fresh = changes.where(F.col("_change") != "delete").select(key, "content_hash")
    embedded = embed(chunks.select(key, text).join(fresh, key), model, text).select(key, "content_hash", "embedding")
    kept = index.join(changes.select(key), key, "left_anti").select(key, "content_hash", "embedding")
    return kept.unionByName(embedded)


def build_index(chunks: DataFrame, model: TextModel, key: str = "chunk_id", text: str = "content") -> DataFrame:
    hashed = chunks.select(key, text, F.sha2(F.col(text), 256).alias("content_hash"))
    return embed(hashed, model, text).select(key, "content_hash", "embedding")


def assemble_context(
    hits: DataFrame,
    query_id: str,
    source: str,
    text: str,
    max_sources: int = 3,
    max_chars: int = 500,
) -> DataFrame:
    """(query_id, context, sources): the best hits as cited text, best first.

    Each source contributes its first `max_chars` characters; `hits` has rank and score. A query
    keeps at most `max_sources` rows before they are collected.
    """
    best = hits.where(F.col("rank") <= max_sources)
    cited = F.concat(F.lit("["), F.col(source).cast("string"), F.lit("] "), preview(F.col(text), max_chars))
    named = F.concat(F.col(source).cast("string"), F.lit(" (score: "), F.format_number("score", 4), F.lit(")"))
    rows = best.groupBy(query_id).agg(
        F.array_sort(F.collect_list(F.struct("rank", cited.alias("cited"), named.alias("named")))).alias("_rows")
    )
    return rows.select(
        query_id,
        F.array_join(F.transform("_rows", lambda r: r["cited"]), "\n\n").alias("context"),
        F.array_join(F.transform("_rows", lambda r: r["named"]), ", ").alias("sources"),
    )


def recall(approximate: DataFrame, exact: DataFrame, query_id: str, corpus_id: str) -> DataFrame:
    """Share of the exact neighbours that the approximate search found, as one row."""
    hit = approximate.select(query_id, corpus_id, F.lit(1).alias("_hit"))
    joined = exact.select(query_id, corpus_id).join(hit, [query_id, corpus_id], "left")
    return joined.agg(F.avg(F.coalesce("_hit", F.lit(0)).cast("double")).alias("recall"))
