"""A training corpus from `documents`: quality, exact and near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of their input, whatever they are
called, also where nulls are in any of them; an empty table of documents stays empty.

Null and empty texts are judged like any other by the classifier; they equal one another, have no shingles
and no passages, and are one end token each. Repeated rows are equal texts of one id and stay together: a
decision on an id and text holds for each of them. Of equal or near texts the smallest id stays, so ties
do not depend on order.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import exact_dedup, jaccard_join, packing, quality, substring_dedup
from fleetlake.llm.common import lean_workers, table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, as they are.

    It learns from the labelled rows of this stage's input outside the held-out fold.
    """
    lean_workers(spark)
    known = quality.measured(docs, ["doc_id"])
    model = quality.fit(quality.training_rows(known, table(spark, sf_dir, "labels")))
    plain = [f"column{i}" for i in range(len(docs.columns))]  # a column may be called score
    rows = quality.scored(docs.toDF(*plain), model, plain, plain[docs.columns.index("text")])
    return rows.filter("predicted = 1").select(*plain).toDF(*docs.columns)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id."""
    lean_workers(spark)
    return exact_dedup.exact_dedup(docs)


def distinct_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by near equality the row with the smallest doc_id; unlinked ones all stay.

    Near means 80 % of the 5-word shingles; 3 words and 90 % are the contract of op 7 alone.
    """
    lean_workers(spark)
    parts = jaccard_join.linked_components(docs.select("doc_id", "text"), width=5, percent=80)
    # Written, so that its size is known: while it is small the texts need no shuffle.
    gone = written(parts.filter("component_id <> doc_id").select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier; those of which nothing is left go."""
    lean_workers(spark)
    fixed = ("doc_id", "text", "n_chars")
    plain = [c if c in fixed else f"column{i}" for i, c in enumerate(docs.columns)]  # or n_words
    rows = substring_dedup.without_repeats(docs.toDF(*plain)).filter("n_removed = 0 OR n_removed < n_words")
    cut = F.col("n_removed") > 0
    rows = rows.withColumn("text", F.when(cut, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.when(cut, F.length("text")).otherwise(F.col("n_chars"))
        rows = rows.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return rows.select(*plain).toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining text in sequences of at most 4,096 tokens."""
    lean_workers(spark)
    return packing.packed_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), cache=50_000)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", distinct_texts),
    ("jaccard_dedup", distinct_content),
    ("substring_dedup", without_repeated_passages),
    ("packing", packed),
]

#: The classifier's floating-point statistics and the tokenizer have no SQL form; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return written(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
