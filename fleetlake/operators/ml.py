"""Training, evaluation and scoring of the anomaly classifier."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.numeric import rate
from fleetlake.functions.text import anomaly_flag, flag_status
from fleetlake.operators import boosting
from fleetlake.operators.ranking import ranked_by_hash

# The model's inputs, in this order.
FEATURES = [
    "avg_temp",
    "max_temp",
    "min_temp",
    "avg_utilization",
    "avg_memory_pct",
    "avg_power",
    "error_count_1h",
    "temp_stddev",
    "temp_range",
    "high_temp_pct",
]

# Tree count, depth, leaves, learning rate and rounds without improvement.
TRAINING = {"maxIter": 200, "maxDepth": 6, "maxLeaves": 31, "stepSize": 0.05, "patience": 20}


def feature_vector(features: list[str] | None = None) -> VectorAssembler:
    return VectorAssembler(inputCols=features or FEATURES, outputCol="features", handleInvalid="keep")


def stratified_split(df: DataFrame, label: str, key: list[str], test: float = 0.2) -> DataFrame:
    """Add is_test: exactly round(test * class size) rows of each class, chosen by md5 of the key.

    Repeatable on any engine and any partitioning, unlike a random draw. Ranks come from md5
    prefixes, so a class is never sorted in one task.
    """
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    ranked = ranked_by_hash(df, key, [label], rank="_rank")
    # One row per class.
    return ranked.join(sizes, label).select(
        *df.columns, (F.col("_rank") <= F.round(F.col("_size") * test)).alias("is_test")
    )


def sampled_split(df: DataFrame, label: str, classes: list, test: float = 0.2, seed: int = 42) -> DataFrame:
    """The test part by per-class Bernoulli sampling: one pass, class sizes only approximate."""
    return df.sampleBy(label, {c: test for c in classes}, seed)


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).alias("t")).scalar()
    return counts.select(label, "n", (totals["rows"] / (totals["classes"] * F.col("n"))).alias("weight"))


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: tp, fp, fn, precision, recall, f1 of class 1; an empty denominator gives 0."""
    yes, said = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(yes & said).alias("tp"), F.count_if(~yes & said).alias("fp"), F.count_if(yes & ~said).alias("fn")
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def or_zero(value):
        return F.coalesce(value, F.lit(0.0))

    return counts.select(
        "tp",
        "fp",
        "fn",
        or_zero(rate(tp, tp + fp)).alias("precision"),
        or_zero(rate(tp, tp + fn)).alias("recall"),
        or_zero(rate(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    )


def train(
    df: DataFrame,
    label: str = "is_anomaly",
    features: list[str] | None = None,
    held_out: str | None = "is_test",
    weighted: bool = True,
    **params,
) -> boosting.Model:
    """Gradient-boosted trees on the rows not held out; the held-out rows decide when to stop.

    Trees grow best gain first to 31 leaves and are added until the held-out loss has not fallen for 20
    rounds or 200 are grown. Sums are exact integers, so there is nothing random and no seed to give.
    """
    rows, weight = df, None
    options = {**TRAINING, **params}
    if weighted:
        base = rows if held_out is None else rows.where(~F.col(held_out))
        weights = balanced_weights(base, label).select(label, F.col("weight").alias("_weight"))
        rows, weight = rows.join(weights, label), "_weight"
    return boosting.fit(
        rows, features or FEATURES, label, weight, held_out,
        trees=options["maxIter"], depth=options["maxDepth"], leaves=options["maxLeaves"], rate=options["stepSize"], patience=options["patience"],
    )


def score(model: boosting.Model, df: DataFrame, threshold: float = 0.7) -> DataFrame:
    """All input columns plus score, is_anomaly_predicted and status; ids stay beside their score.

    Works on a batch and on a stream. Missing numbers count as 0, as in training.
    """
    return with_flag(df.withColumn("score", model.probability()), threshold)


def with_flag(df: DataFrame, threshold: float = 0.7, reported: str | None = None) -> DataFrame:
    """Flag and status from a score column, or from the flag a service reported where it is set."""
    known = F.col(reported) if reported else F.lit(None).cast("boolean")
    flag = anomaly_flag(known, F.col("score"), threshold)
    return df.withColumn("is_anomaly_predicted", flag).withColumn("status", flag_status(flag))


def compare_models(scored: dict[str, DataFrame], label: str, prediction: str) -> DataFrame:
    """Holdout metrics per model, best F1 first (ties by name), with `promote` on the winner."""
    from functools import reduce

    from pyspark.sql import Window

    rows = [binary_metrics(df, label, prediction).withColumn("model", F.lit(name)) for name, df in scored.items()]
    table = reduce(DataFrame.unionByName, rows)
    order = Window.orderBy(F.col("f1").desc(), "model")  # one row per model
    return table.withColumn("promote", F.row_number().over(order) == 1)
