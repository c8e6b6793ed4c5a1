"""Overlapping character chunks of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.text import strip_space


def _check(size: int, overlap: int) -> int:
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below the chunk size")
    return size - overlap


def chunk_count(length: Column, step: int) -> Column:
    """Chunks start at 0, step, 2 * step, ... below the length; empty text has none."""
    return F.ceil(F.coalesce(length, F.lit(0)) / step).cast("bigint")


def chunk_column(text: Column, size: int = 800, overlap: int = 100) -> Column:
    """Array of raw chunks; offsets count code points. Null or empty text gives an empty array."""
    step = _check(size, overlap)
    if overlap <= step:
        # Cut once into pieces of one step; a chunk is a piece and the start of the next.
        pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
        following = F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1)))
        chunks = F.zip_with(pieces, following, lambda p, q: F.concat(p, F.substring(F.coalesce(q, F.lit("")), 1, overlap)))
        return F.coalesce(chunks, F.array().cast("array<string>"))
    length = F.coalesce(F.length(text), F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), length - 1, F.lit(step)), lambda at: F.substring(text, at + 1, F.lit(size)))
    return F.when(length > 0, cut).otherwise(F.array().cast("array<string>"))


def chunk_documents(
    df: DataFrame, name: str, text: str, size: int = 800, overlap: int = 100, digits: int = 4
) -> DataFrame:
    """(chunk_id, doc_name, chunk_index, content): the chunk table of a document collection.

    Ids are dense from 0 in the order of md5(doc_name), doc_name, chunk_index; document names are
    unique. md5 spreads the documents evenly over 16^digits prefixes whose order is md5 order: the
    chunk counts summed per prefix give each prefix its first id, a running sum inside the prefix
    the first id of each document. So documents are sorted in as many tasks as there are prefixes,
    and their text is shuffled once.
    """
    step = _check(size, overlap)
    body = F.col(text)
    docs = df.select(
        F.col(name).cast("string").alias("doc_name"),
        F.md5(F.col(name).cast("string")).alias("_md5"),
        chunk_count(F.length(body), step).alias("_n"),
        body.alias("_text"),
    ).withColumn("_prefix", F.substring("_md5", 1, digits))
    totals = docs.groupBy("_prefix").agg(F.sum("_n").alias("_total"))
    lower = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_prefix", F.coalesce(F.sum("_total").over(lower), F.lit(0)).alias("_base"))
    own = Window.partitionBy("_prefix").orderBy("_md5", "doc_name").rowsBetween(Window.unboundedPreceding, -1)
    # `base` has at most 16^digits rows of a few bytes, whatever the size of the collection.
    placed = docs.withColumn("_inside", F.coalesce(F.sum("_n").over(own), F.lit(0))).join(F.broadcast(base), "_prefix")
    pieces = F.posexplode(chunk_column(F.col("_text"), size, overlap)).alias("chunk_index", "_piece")
    return placed.select("doc_name", (F.col("_base") + F.col("_inside")).alias("_first"), pieces).select(
        (F.col("_first") + F.col("chunk_index")).alias("chunk_id"),
        "doc_name",
        "chunk_index",
        strip_space(F.col("_piece")).alias("content"),
    )


def register_chunker(spark, name: str = "chunk_text", size: int = 800, overlap: int = 100) -> None:
    """The chunker as a SQL table function: SELECT * FROM chunk_text('...')."""
    step = _check(size, overlap)
    from pyspark.sql.functions import udtf

    class Chunker:
        def eval(self, text: str):
            for index, at in enumerate(range(0, len(text or ""), step)):
                yield index, text[at : at + size]

    spark.udtf.register(name, udtf(Chunker, returnType="chunk_index: int, content: string"))
