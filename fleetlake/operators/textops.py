"""Text operators over event descriptions, pages and questions.

A hosted model answers these in a managed service; here each keeps the contract (arity, output
type, bounds, nulls) with a deterministic rule in Column expressions, and `complete` takes any
batch callable where a model is wanted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.text import strip_space, word_count
from fleetlake.sinks.tables import save_scratch

# Root-cause labels; the keyword patterns are ours.
ROOT_CAUSES = {
    "hardware_failure": r"\b(?:power supply|fan failure|module failed|hardware|boards?)\b",
    "thermal_throttle": r"\b(?:thermal\w*|throttl\w*|overheat\w*|temperatures?|cooling|fans?)\b",
    "memory_error": r"\b(?:ecc|memory|pages? retired|row remap\w*)\b",
    "software_bug": r"\b(?:drivers?|kernel|crash\w*|exit codes?|segfaults?|exceptions?)\b",
    "network_issue": r"\b(?:networks?|link flap\w*|ports?|infiniband|packets?)\b",
}

# Field patterns of a job description; the first capture group is the value.
JOB_FIELDS = {
    "framework": r"with (.+?) on dataset",
    "model_size": r"([0-9]+B) ",
    "dataset": r"on dataset (\S+)",
    "objective": r"for (\S+)$",
}

# Field patterns of a web page.
PAGE_FIELDS = {
    "title": r"<title>([^<]*)</title>",
    "language": r'<html lang="([a-z]+)"',
    "heading": r"<h1>([^<]*)</h1>",
    "charset": r'charset="([^"]+)"',
}

# Routing rules: what asks for data, what asks for a procedure.
ROUTES = {
    "data": r"\b(?:how many|averages?|counts?|current|status|metrics?|telemetry|utilization|which|show me|showing|top [0-9]+)\b",
    "docs": r"\b(?:procedures?|runbooks?|troubleshoot\w*|how to|what should|what do|steps|maintenance|guides?|slas?)\b",
}

def classify(text: Column, lexicon: dict[str, str] | None = None) -> Column:
    """One label per text: the label whose pattern occurs most often; the first label on a tie.

    Null text and text in which no pattern occurs give null. The whole text is read, once per label.
    """
    lexicon = ROOT_CAUSES if lexicon is None else lexicon
    lowered = F.lower(text)
    scored = [
        F.struct(F.regexp_count(lowered, F.lit(pattern)).alias("hits"), F.lit(-i).alias("rank"), F.lit(label).alias("label"))
        for i, (label, pattern) in enumerate(lexicon.items())
    ]
    best = F.array_max(F.array(*scored))
    return F.when(best["hits"] > 0, best["label"])


def classify_words(df: DataFrame, text: str, lexicon: dict[str, list[str]], output: str = "label") -> DataFrame:
    """Add the label whose words occur most often in `text`, the first on a tie, null without any.

    Words are what stands between white space, lower-cased; the text is split once for all labels.
    """
    def hits(own: list[str]) -> Column:
        return F.size(F.filter("_words", lambda word: word.isin(own)))

    split = df.withColumn("_words", F.split(F.lower(text), r"\s+"))
    scored = [
        F.struct(hits(own).alias("hits"), F.lit(-i).alias("rank"), F.lit(label).alias("label"))
        for i, (label, own) in enumerate(lexicon.items())
    ]
    best = split.withColumn("_best", F.array_max(F.array(*scored)))
    return best.withColumn(output, F.when(F.col("_best.hits") > 0, F.col("_best.label"))).drop("_words", "_best")


def extract(text: Column, patterns: dict[str, str]) -> Column:
    """Struct with one field per pattern: its first capture group, null where it does not match."""
    return F.struct(
        *[F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).alias(name) for name, pattern in patterns.items()]
    )


def first_words(text: Column, words: int) -> Column:
    clean = strip_space(text)
    return F.array_join(F.slice(F.split(clean, r"\s+"), 1, words), " ")


def counted_sentences(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, sentence, hits) of every distinct sentence of a group; counting combines on the map side."""
    sentences = df.select(
        *keys, F.explode(F.split(F.col(text), r"[.!?]\s+|[.!?]$|\n")).alias("sentence")
    ).select(*keys, strip_space(F.col("sentence")).alias("sentence")).where(F.col("sentence") != "")
    return sentences.groupBy(*keys, "sentence").agg(F.count(F.lit(1)).alias("hits"))


def _fitted(df: DataFrame, sentences: DataFrame, keys: list[str], order: list[Column], max_words: int, separator: str) -> DataFrame:
    """(keys, event_count, summary): the first sentences of `order` that fit into `max_words` words.

    A sentence has at least one word, so only the first `max_words` sentences of a group can ever enter:
    each task passes on no more than that, and a group with a third of all rows reaches its final
    task as `max_words` rows. A first sentence above the cap is cut to it.
    """
    ranked = sentences.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
        F.col("rank") <= max_words
    )
    so_far = Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    fitting = (
        ranked.withColumn("words", F.sum(word_count(F.col("sentence"))).over(so_far))
        .where((F.col("words") <= max_words) | (F.col("rank") == 1))
        .withColumn("sentence", F.when(F.col("words") > max_words, first_words(F.col("sentence"), max_words)).otherwise(F.col("sentence")))
    )
    chosen = fitting.groupBy(*keys).agg(F.collect_list(F.struct("rank", "sentence")).alias("kept"))
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("event_count"))
    joined = F.array_join(F.transform(F.array_sort("kept"), lambda s: s["sentence"]), separator)
    return totals.join(chosen, keys, "left").select(*keys, "event_count", joined.alias("summary"))


def summarize_groups(
    df: DataFrame, keys: list[str], text: str, max_words: int = 80, separator: str = " | "
) -> DataFrame:
    """(keys, event_count, summary): what a group says most often, in at most `max_words` words.

    Every text of the group is split into sentences and counted; sentences enter by falling count
    (then alphabetically) while they fit.
    """
    order = [F.col("hits").desc(), F.col("sentence").asc()]
    return _fitted(df, counted_sentences(df, keys, text), keys, order, max_words, separator)


#: Characters of a group that one task walks over by itself; larger groups are walked by joins.
TASK_CHARS = 1 << 20


def ranked_sentences(sentences: DataFrame, keys: list[str], rounds: int = 4, damping: float = 0.85, task_chars: int = TASK_CHARS) -> DataFrame:
    """(keys, sentence, hits, score): a random walk between the sentences of a group that share words.

    A step goes from a sentence to one of its words, each alike, and from there to one of the sentences
    with that word, each alike; with 1 - damping it starts anew at a sentence by how often it is said.
    The walk runs over (sentence, word) pairs, so no two sentences are ever paired. Sentences travel once
    to the task of their group, which does all rounds there. Groups of more than `task_chars` characters
    spread over all tasks instead: `rounds` times two joins and two sums, linear in the text.
    """
    group = F.concat_ws("\x01", *[F.coalesce(F.col(k).cast("string"), F.lit("\x02")) for k in keys])
    rows = save_scratch(sentences.select(*keys, "sentence", "hits", group.alias("_group")), "sentences")
    sizes = rows.groupBy("_group").agg(F.sum(F.length("sentence") + 1).alias("_chars"))
    large = save_scratch(sizes.where(F.col("_chars") > task_chars).select("_group"), "large-groups")
    if large.isEmpty():
        return _walked_in_tasks(rows, keys, rounds, damping)
    near = _walked_in_tasks(rows.join(large, "_group", "left_anti"), keys, rounds, damping)
    return near.unionByName(_walked_by_joins(rows.join(large, "_group", "left_semi"), keys, rounds, damping))


def _distinct_words() -> Column:
    return F.array_distinct(F.filter(F.split(F.lower("sentence"), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def _walked_in_tasks(rows: DataFrame, keys: list[str], rounds: int, damping: float) -> DataFrame:
    """The walk where a group is whole in one task; a task holds a batch and the group that it ends in."""

    def scores(table: pa.Table) -> np.ndarray:
        words = table["_words"].combine_chunks()
        sentence = np.repeat(np.arange(table.num_rows), np.asarray(pc.list_value_length(words)))
        terms = words.flatten().dictionary_encode()
        groups = np.asarray(table["_group"].combine_chunks().dictionary_encode().indices).astype(np.int64)
        _, word = np.unique(groups[sentence] * (len(terms.dictionary) + 1) + np.asarray(terms.indices), return_inverse=True)
        base = np.asarray(table["hits"]).astype(float)
        x, own, holders = base, np.bincount(sentence, minlength=len(base)), np.bincount(word)
        for _ in range(rounds):
            mass = np.bincount(word, (x / np.maximum(own, 1))[sentence], len(holders)) / holders
            x = (1 - damping) * base + damping * np.bincount(sentence, mass[word], len(base))
        return x

    def finished(table: pa.Table) -> list[pa.RecordBatch]:
        return table.drop_columns(["_group", "_words"]).append_column("score", pa.array(scores(table))).to_batches()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = pc.index(held["_group"], held["_group"][-1]).as_py()  # sorted: all before are whole
            if last:
                yield from finished(held.slice(0, last))
                held = held.slice(last)
        if held is not None:
            yield from finished(held)

    columns = [*keys, "sentence", "hits"]
    schema = rows.select(*columns).schema.add("score", T.DoubleType())
    dealt = rows.select(*columns, "_group").repartition("_group").sortWithinPartitions("_group")
    return dealt.withColumn("_words", _distinct_words()).mapInArrow(walk, schema)


def _walked_by_joins(rows: DataFrame, keys: list[str], rounds: int, damping: float) -> DataFrame:
    """The walk as joins over (sentence, word) pairs; sums over a word or sentence combine before the shuffle.

    Sentences and words are named by 128-bit digests of the group and themselves.
    """

    def name(what: str) -> Column:
        return F.unhex(F.md5(F.concat("_group", F.lit("\x03"), what)))

    named = save_scratch(rows.withColumn("_s", name("sentence")), "named")
    pairs = named.select("_s", "_group", F.explode(_distinct_words()).alias("_word")).select("_s", name("_word").alias("_w"))
    sizes = [pairs.groupBy(c).agg(F.count(F.lit(1)).alias(n)) for c, n in (("_s", "_words"), ("_w", "_sentences"))]
    edges = save_scratch(pairs.join(sizes[0], "_s").join(sizes[1], "_w"), "edges")
    base = named.select("_s", F.col("hits").cast("double").alias("_base"))
    score = base.select("_s", F.col("_base").alias("_x"))
    for _ in range(rounds):
        mass = edges.join(score, "_s").groupBy("_w").agg(F.sum(F.col("_x") / F.col("_words")).alias("_m"))
        back = edges.join(mass, "_w").groupBy("_s").agg(F.sum(F.col("_m") / F.col("_sentences")).alias("_in"))
        new = (1 - damping) * F.col("_base") + damping * F.coalesce("_in", F.lit(0.0))
        score = save_scratch(base.join(back, "_s", "left").select("_s", new.alias("_x")), "scores")
    return named.join(score, "_s").select(*keys, "sentence", "hits", F.col("_x").alias("score"))


def summarize_by_rank(
    df: DataFrame, keys: list[str], text: str, max_words: int = 80, separator: str = " | ", rounds: int = 4
) -> DataFrame:
    """(keys, event_count, summary): the sentences most connected to the rest of their group by shared words.

    Scores are compared at 6 digits, equal ones by the sentence; the cap is that of `summarize_groups`.
    """
    ranked = ranked_sentences(counted_sentences(df, keys, text), keys, rounds)
    order = [F.round("score", 6).desc(), F.col("sentence").asc()]
    return _fitted(df, ranked, keys, order, max_words, separator)


def complete(
    df: DataFrame,
    prompt: str,
    answer: Callable[[list[str]], list[str]],
    output: str = "response",
    batch: int = 32,
) -> DataFrame:
    """Batch inference: `answer` maps a list of prompts to a list of texts, inside the tasks.

    Adds `output` and `error`. A batch whose call raises, or returns the wrong number of answers,
    gets the message in `error` and null text; the other batches and the job go on.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.StringType()), T.StructField("error", T.StringType())])

    def infer(frames: Iterator) -> Iterator:
        for frame in frames:
            for start in range(0, len(frame), batch):
                rows = frame.iloc[start : start + batch]
                prompts = rows[prompt].tolist()
                try:
                    texts, error = list(answer(prompts)), None
                    if len(texts) != len(prompts):
                        raise ValueError(f"{len(texts)} answers for {len(prompts)} prompts")
                except Exception as failure:
                    texts, error = [None] * len(prompts), f"{type(failure).__name__}: {failure}"
                yield rows.assign(
                    **{output: pd.Series(texts, index=rows.index, dtype=object),
                       "error": pd.Series([error] * len(prompts), index=rows.index, dtype=object)}
                )

    return df.mapInPandas(infer, schema)


def route_questions(df: DataFrame, text: str, rules: dict[str, str] | None = None) -> DataFrame:
    """Add `route`: data, docs, both (data first) or none, by the two rule patterns."""
    rules = ROUTES if rules is None else rules
    lowered = F.lower(F.col(text))
    data, docs = lowered.rlike(rules["data"]), lowered.rlike(rules["docs"])
    route = F.when(data & docs, "both").when(data, "data").when(docs, "docs").otherwise("none")
    return df.withColumn("route", route)


def register_text_functions(spark, answer: Callable[[list[str]], list[str]]) -> None:
    """Make the model call available in SQL as model_query(prompt), in Arrow batches."""

    @F.pandas_udf("string")
    def model_query(prompts: pd.Series) -> pd.Series:
        return pd.Series(list(answer(prompts.tolist())), index=prompts.index, dtype=object)

    spark.udf.register("model_query", model_query)
