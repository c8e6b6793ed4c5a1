"""Text labels learned from a few seed words: complement naive Bayes with expectation-maximisation.

Texts with seed words start out in the class of their seeds, all others in the remaining class. Each round
counts in how many texts of a class, and of the others together, a word occurs, keeps the words whose log
odds are `odds` and `z` standard errors away from 0, and deals every text out to the classes anew by the kept
words that it has and that it lacks. Seeds only start the first round: afterwards they weigh what the texts
say they do, like any other word.
Counts and scores are sums of Spark over (text, word) pairs; the model is a table of words. Texts are kept
as one list of words each; shares join the lists, and pairs are made from what that gives.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.sinks.tables import save_scratch


class BayesModel(NamedTuple):
    classes: list[str]
    priors: list[float]  # log odds of each class against the others for a text without any of the words
    words: DataFrame  # token, w_0, w_1, ...: what having the word adds


def word_lists(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """(_id, words): the different words of every text, lower-cased; null for null."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    return df.select(F.col(row_id).alias("_id"), words.alias("words"))


def distinct_words(lists: DataFrame, *columns: str) -> DataFrame:
    """(_id, columns, token) of word lists."""
    return lists.select("_id", *columns, F.explode("words").alias("token"))


def _normalised(odds: list[Column]) -> list[Column]:
    """Probabilities from log odds of each class against the others."""
    shares = [1 / (1 + F.exp(-F.greatest(F.least(o, F.lit(50.0)), F.lit(-50.0)))) for o in odds]
    total = sum(shares[1:], shares[0])
    return [s / total for s in shares]


def _started(tokens: DataFrame, ids: DataFrame, seeds: list[list[str]]) -> DataFrame:
    """(_id, r_0, ..., r_k): shares by seed words; the last class, without seeds, takes what has none."""
    hits = [F.count_if(F.col("token").isin(own)).alias(f"_h{i}") for i, own in enumerate(seeds)]
    found = tokens.where(F.col("token").isin([w for own in seeds for w in own])).groupBy("_id").agg(*hits)
    total = sum((F.col(f"_h{i}") for i in range(1, len(seeds))), F.col("_h0"))
    shares = [F.coalesce(F.col(f"_h{i}") / total, F.lit(0.0)).alias(f"r_{i}") for i in range(len(seeds))]
    rest = F.when(F.col("_h0").isNull(), 1.0).otherwise(0.0).alias(f"r_{len(seeds)}")
    return ids.join(found, "_id", "left").select("_id", *shares, rest)


def _model(lists: DataFrame, shares: DataFrame, classes: list[str], alpha: float, z: float, odds: float, least: int) -> BayesModel:
    k = range(len(classes))
    n = shares.agg(*[F.coalesce(F.sum(f"r_{j}"), F.lit(0.0)).alias(f"n_{j}") for j in k], F.count(F.lit(1)).alias("n")).first()
    rows = max(n["n"], 1)
    sizes = [max(n[f"n_{j}"], 1e-9) for j in k]
    # Shares meet a text's list, one row, before its words are taken apart.
    tokens = distinct_words(lists.join(shares, "_id"), *[f"r_{j}" for j in k])
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("_df"), *[F.sum(f"r_{j}").alias(f"c_{j}") for j in k])
    columns = []
    for j in k:
        size, rest = sizes[j], max(rows - sizes[j], 1e-9)
        # Smoothing in proportion to class sizes: a word that is as rare everywhere has odds of 1.
        more, less = alpha * size / rows, alpha * rest / rows
        inside, outside = F.col(f"c_{j}") + more, F.col("_df") - F.col(f"c_{j}") + less
        found = F.log(inside / size) - F.log(outside / rest)
        sure = F.greatest(F.lit(float(odds)), z * F.sqrt(1 / inside + 1 / outside))
        here, there = inside / (size + 2 * more), outside / (rest + 2 * less)
        lacks = F.log((1 - here) / (1 - there))
        columns += [F.when(F.abs(found) >= sure, F.log(here / there) - lacks).otherwise(0.0).alias(f"w_{j}")]
        columns += [F.when(F.abs(found) >= sure, lacks).otherwise(0.0).alias(f"m_{j}")]
    used = sum((F.abs(f"w_{j}") for j in k[1:]), F.abs("w_0")) > 0
    words = save_scratch(counts.where(F.col("_df") >= least).select("token", *columns).where(used), "words")
    lacking = words.agg(*[F.coalesce(F.sum(f"m_{j}"), F.lit(0.0)) for j in k]).first()
    priors = [math.log(s / max(rows - s, 1e-9)) + m for s, m in zip(sizes, lacking, strict=True)]
    return BayesModel(classes, priors, words.drop(*[f"m_{j}" for j in k]))


def class_shares(model: BayesModel, tokens: DataFrame, ids: DataFrame) -> DataFrame:
    """(_id, r_0, ...): the probability of each class for every id; a text without known words has the priors'."""
    k = range(len(model.classes))
    sums = tokens.join(model.words, "token").groupBy("_id").agg(*[F.sum(f"w_{j}").alias(f"s_{j}") for j in k])
    scores = [F.coalesce(f"s_{j}", F.lit(0.0)) + model.priors[j] for j in k]
    return ids.join(sums, "_id", "left").select("_id", *[p.alias(f"r_{j}") for j, p in enumerate(_normalised(scores))])


def learn_labels(
    df: DataFrame, row_id: str, text: str, seeds: dict[str, list[str]], other: str, rounds: int = 4, alpha: float = 1.0, z: float = 4.0, odds: float = 2.0, least: int = 5
) -> BayesModel:
    """Fit on the texts of `df`: classes are those of `seeds`, in that order, and `other`. Row ids are unique."""
    lists = save_scratch(word_lists(df, row_id, text), "word-lists")
    tokens = distinct_words(lists)
    ids = df.select(F.col(row_id).alias("_id"))
    classes = [*seeds, other]
    shares = _started(tokens, ids, list(seeds.values()))
    model = None
    for _ in range(rounds):
        model = _model(lists, save_scratch(shares, "shares"), classes, alpha, z, odds, least)
        shares = class_shares(model, tokens, ids)
    return model


def labelled(model: BayesModel, df: DataFrame, row_id: str, text: str) -> DataFrame:
    """(row_id, label, probability): the likeliest class, the first of equal ones."""
    shares = class_shares(model, distinct_words(word_lists(df, row_id, text)), df.select(F.col(row_id).alias("_id")))
    best = F.array_max(F.array(*[F.struct(F.col(f"r_{j}").alias("p"), F.lit(-j).alias("rank"), F.lit(c).alias("label")) for j, c in enumerate(model.classes)]))
    return shares.select(F.col("_id").alias(row_id), best["label"].alias("label"), best["p"].alias("probability"))
