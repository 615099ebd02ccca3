import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablewright.operators.metrics import accuracy_and_f1, class_report, confusion, evaluate, roc_auc
from tests.support import rows


@pytest.fixture
def scored(spark):
    data = [(float(i % 3 == 0), float(i % 4 < 2), (i * 37 % 11) / 11) for i in range(200)]
    return spark.createDataFrame(data, "label double, prediction double, rawPrediction double")


def test_shares_equal_the_built_in_evaluator(scored):
    built_in = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    found = accuracy_and_f1(confusion(scored)).first()
    assert found.accuracy == pytest.approx(built_in.setMetricName("accuracy").evaluate(scored), abs=1e-12)
    assert found.f1 == pytest.approx(built_in.setMetricName("f1").evaluate(scored), abs=1e-12)


def test_a_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    report = rows(class_report(confusion(df)), "class")
    assert report == [(0.0, 2, 3, 2, 0.8), (1.0, 1, 0, 0, 0.0)]
    built_in = MulticlassClassificationEvaluator(metricName="f1")
    assert accuracy_and_f1(confusion(df)).first().f1 == pytest.approx(built_in.evaluate(df))


def brute_auc(pairs):
    positive = [s for y, s in pairs if y == 1]
    negative = [s for y, s in pairs if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


def test_area_under_curve_with_ties(scored):
    pairs = [(r.label, r.rawPrediction) for r in scored.collect()]
    assert roc_auc(scored, bins=0) == pytest.approx(brute_auc(pairs), abs=1e-12)
    flipped = scored.withColumn("rawPrediction", -scored.rawPrediction)
    assert roc_auc(flipped, bins=0) == pytest.approx(1 - brute_auc(pairs), abs=1e-12)


def test_area_equals_the_built_in_curve_of_all_scores(spark):
    """30,000 scores, a third of them equal, cut into many ranges."""
    df = spark.range(30000).select(
        (F.rand(1) < 0.3).cast("double").alias("label"),
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.rand(2)).alias("score"),
    )
    df = df.withColumn("rawPrediction", array_to_vector(F.array(-F.col("score"), F.col("score"))))
    built_in = BinaryClassificationEvaluator(numBins=0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        found = roc_auc(df)
        assert roc_auc(df, score="score") == found
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == pytest.approx(built_in.evaluate(df), abs=1e-12)
    assert roc_auc(df, bins=1000) == pytest.approx(found, abs=1e-4)


@pytest.mark.parametrize("label, area", [(1.0, 1.0), (0.0, 0.0)])
def test_area_with_one_class_only(spark, label, area):
    df = spark.createDataFrame([(label, 0.1), (label, 0.7)], "label double, rawPrediction double")
    assert roc_auc(df) == area == BinaryClassificationEvaluator(numBins=0).evaluate(df)


def test_evaluate(scored):
    found = evaluate(scored)
    assert set(found) == {"roc_auc", "accuracy", "f1"}
    assert all(0 <= v <= 1 for v in found.values())
