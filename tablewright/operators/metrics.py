"""Quality of a scored table."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.columns import named
from tablewright.roles import INDEXED_LABEL, PREDICTION, RAW_PREDICTION

# Points of the ROC curve: 0 keeps every distinct score. The built-in evaluator
# down-samples to 1000, with cuts that depend on the partitioning.
ROC_BINS = 0


def confusion(df: DataFrame, label: str = INDEXED_LABEL, prediction: str = PREDICTION) -> DataFrame:
    return df.groupBy(
        named(label).cast("double").alias("label"),
        named(prediction).cast("double").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def class_report(counts: DataFrame) -> DataFrame:
    """Per class of a confusion table: support, predicted, hits and F1."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("predicted"),
            hit.cast("long").alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    sums = (
        counts.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    return sums.withColumn("f1", 2 * F.col("hits") / (F.col("support") + F.col("predicted")))


def accuracy_and_f1(counts: DataFrame) -> DataFrame:
    """One row: accuracy, and the mean of the class F1 weighted by class share."""
    return class_report(counts).agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
    )


def score_value(df: DataFrame, score: str) -> Column:
    """The score of the positive class, from a number or a two-class vector."""
    value = named(score)
    return vector_to_array(value)[1] if isinstance(df.schema[score].dataType, VectorUDT) else value


def roc_area(df: DataFrame, label: str = INDEXED_LABEL, score: str = RAW_PREDICTION) -> DataFrame:
    """One row: the exact area under the ROC curve.

    It is the share of (positive, negative) pairs in the right order, ties by
    half. Equal scores are counted together first, so a frequent score is one
    row. The distinct scores are then cut into ranges; each range adds its own
    pairs, and pairs across ranges follow from the totals of the ranges before,
    one row per shuffle partition. No task sees more than its range.
    """
    positive = (named(label) > 0.5).cast("long")
    scores = (
        df.select(score_value(df, score).cast("double").alias("score"), positive.alias("y"))
        .groupBy("score")
        .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
    )
    ranges = scores.repartitionByRange("score").withColumn("range", F.spark_partition_id())
    inside = Window.partitionBy("range").orderBy("score")
    below = (F.sum("n").over(inside) - F.col("n")).cast("double")
    pairs = F.col("p") * (below + F.col("n") / 2)
    totals = (
        ranges.withColumn("pairs", pairs)
        .groupBy("range")
        .agg(F.min("score").alias("low"), *[F.sum(c).alias(c) for c in ("p", "n", "pairs")])
    )
    before = (F.sum("n").over(Window.orderBy("low")) - F.col("n")).cast("double")
    won = F.sum(F.col("pairs") + F.col("p") * F.col("before"))
    # A curve without positives or without negatives has no pairs to compare.
    return totals.withColumn("before", before).agg(
        F.when(F.sum("p") == 0, 0.0)
        .when(F.sum("n") == 0, 1.0)
        .otherwise(won / F.sum("p") / F.sum("n"))
        .alias("roc_auc")
    )


def roc_auc(
    df: DataFrame, label: str = INDEXED_LABEL, score: str = RAW_PREDICTION, bins: int = ROC_BINS
) -> float:
    """Exact area, or with ``bins`` that of the built-in curve of so many points."""
    if not bins:
        return roc_area(df, label, score).first().roc_auc
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
    )
    return evaluator.evaluate(df)


def evaluate(predictions: DataFrame, bins: int = ROC_BINS) -> dict[str, float]:
    shares = accuracy_and_f1(confusion(predictions)).first()
    return {
        "roc_auc": roc_auc(predictions, bins=bins),
        "accuracy": shares.accuracy,
        "f1": shares.f1,
    }
