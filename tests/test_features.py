import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablewright.operators.features import (
    category_counts,
    check_categories,
    expected_columns,
    distinct_estimates,
    fit_features,
    impute_stage,
    index_models,
    index_sizes,
    learner,
    one_hot_model,
    one_hot_stage,
)
from tablewright.operators.medians import exact_medians, impute
from tablewright.operators.ranking import ROW_BITS, ranked
from tablewright.roles import ColumnRoles
from tablewright.sources.staging import drop_staged
from tests.support import plan


def test_one_hot_keeps_a_slot_for_unseen_and_null(spark):
    seen = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    (indexer,) = index_models(seen, ["c"])
    fitted = PipelineModel([indexer, one_hot_stage(["c"]).fit(indexer.transform(seen))])
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "zzz"), (3, None)], "i int, c string")
    found = fitted.transform(df).orderBy("i").select("c_idx", vector_to_array("c_ohe")).collect()
    assert [r[0] for r in found] == [0.0, 1.0, 2.0, 2.0]
    assert [r[1].index(1.0) for r in found] == [0, 1, 2, 2]
    assert {len(r[1]) for r in found} == {3}


NUMBERS = [1.0, 2.0, None, float("nan"), 10.0, 4.0]


def test_median_is_the_lower_middle_value(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(NUMBERS)], "i int, x double")
    staged = impute_stage(["x"], 0.001).fit(df).transform(df)
    exact = impute(df, exact_medians(df, ["x"]))
    expected = [1.0, 2.0, 2.0, 2.0, 10.0, 4.0]
    for filled in (staged, exact):
        assert [r[0] for r in filled.orderBy("i").select("x_imputed").collect()] == expected


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    with pytest.raises(Exception, match="(?i)surrogate"):
        impute_stage(["x"], 0.001).fit(df)
    with pytest.raises(ValueError, match=r"\['x'\]"):
        exact_medians(df, ["x"])


def lower_median(values):
    values = sorted(v for v in values if v is not None and v == v)
    return values[(len(values) - 1) // 2]


@pytest.mark.parametrize("finish_rows", [1, 50, 100_000])
def test_exact_medians_against_brute_force(spark, finish_rows):
    """Uniform, one value for a third of the rows, two values, extremes, constant."""
    draw = random.Random(7)
    table = [
        (
            draw.uniform(-5, 5),
            0.0 if draw.random() < 0.34 else draw.gauss(0, 1),
            float(draw.random() < 0.5),
            draw.choice([1e300, -1e300, 1e-300, float("inf"), 3.0]),
            8.0,
            None if draw.random() < 0.5 else float(draw.randrange(1000)),
        )
        for _ in range(4000)
    ]
    df = spark.createDataFrame(table, "a double, b double, c double, d double, e double, f double")
    found = exact_medians(df.repartition(6), df.columns, finish_rows=finish_rows)
    assert found == {c: lower_median([row[i] for row in table]) for i, c in enumerate(df.columns)}


def test_exact_median_of_lineitem(spark):
    lineitem = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    assert exact_medians(lineitem, ["l_extendedprice"], finish_rows=500) == {"l_extendedprice": 53028.16}


ROLES = ColumnRoles("y", ("id",), ("c", "d"), ("n", "m"))


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame(
        [(1, "a", "p", 1.0, 5), (2, "a", "q", None, 6), (3, "b", " ", 3.0, 7), (4, None, "q", 9.0, 8)],
        "id int, c string, d string, n double, m int",
    )


def test_vector_holds_one_hot_columns_before_numbers(mixed):
    model = fit_features(mixed, ROLES)
    found = model.transform(mixed).orderBy("id").select(vector_to_array("features").alias("v")).collect()
    # c: a, b, missing + unseen; d: q, missing, p + unseen; then n and m.
    assert found[1].v == [1, 0, 0, 0, 1, 0, 0, 0, 3.0, 6.0]
    assert found[3].v == [0, 0, 1, 0, 1, 0, 0, 0, 9.0, 8.0]


def test_one_sided_roles(mixed):
    for roles in (ColumnRoles("y", (), ("c",)), ColumnRoles("y", (), (), ("n", "m"))):
        assert "features" in fit_features(mixed, roles).transform(mixed).columns
    with pytest.raises(ValueError, match="no column is left"):
        fit_features(mixed, ColumnRoles("y"))


def test_expected_columns_of_ours_and_of_single_column_stages(mixed):
    from pyspark.ml.feature import Imputer, StringIndexer

    assert expected_columns(fit_features(mixed, ROLES)) == (["c", "d"], ["m", "n"])
    single = Pipeline(
        stages=[
            StringIndexer(inputCol="d", outputCol="d1", handleInvalid="keep"),
            StringIndexer(inputCol="c", outputCol="c1", handleInvalid="keep"),
            Imputer(inputCols=["n"], outputCols=["n1"]),
        ]
    ).fit(mixed)
    assert expected_columns(single) == (["c", "d"], ["n"])


def test_category_guard(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("c"), F.lit("x").alias("d"))
    roles = ColumnRoles("y", (), ("c", "d"))
    with pytest.raises(ValueError, match="'c'"):
        check_categories(df, roles, 1000)
    check_categories(df, roles, 5000)
    check_categories(df, roles, None)


def test_learner_parameters():
    trees = learner(max_iter=7, max_depth=3, weighted=True)
    assert trees.getMaxIter() == 7 and trees.getMaxDepth() == 3
    assert trees.getWeightCol() == "class_weight" and trees.getSubsamplingRate() == 0.8
    assert trees.getMaxBins() == 64 and trees.getStepSize() == 0.1 and trees.getSeed() == 42
    assert not learner().isSet("weightCol")


def test_index_equals_the_built_in_fit(spark):
    """Ties, nulls, other alphabets and one value for a third of the rows."""
    from pyspark.ml.feature import StringIndexer

    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 37).cast("string")).alias("a"),
        F.element_at(F.array(*map(F.lit, ["é", "z", "Z", "ß", "я", "a b"])), (F.col("id") % 6 + 1).cast("int")).alias("b"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 4).alias("c"),
    )
    built_in = StringIndexer(
        inputCols=df.columns, outputCols=[f"{c}_idx" for c in df.columns], handleInvalid="keep"
    ).fit(df)
    found = index_models(df, df.columns)
    assert [list(m.labels) for m in found] == [list(x) for x in built_in.labelsArray]
    assert PipelineModel(found).transform(df).exceptAll(built_in.transform(df)).count() == 0


def test_dictionaries_are_combined_before_the_shuffle(spark):
    df = spark.range(10).select(F.lit("x").alias("a"), F.lit("y").alias("b"))
    text = plan(category_counts(df, ["a", "b"]))
    assert text.count("Exchange") == 1 and "partial_count" in text[text.index("Exchange") :]


def test_distinct_estimates(spark):
    df = spark.range(0, 20000, 1, 40).select(
        F.col("id").alias("a"), (F.col("id") % 9).alias("b"), F.lit(None).cast("string").alias("c")
    )
    found = distinct_estimates(df, df.columns)
    assert found["a"] == pytest.approx(20000, rel=0.06) and found["b"] == 9 and found["c"] == 0


def test_approximate_medians_are_the_built_in_ones(mixed):
    from pyspark.ml.feature import Imputer

    numeric = ColumnRoles("y", (), (), ("n", "m"))
    (found,) = [s for s in fit_features(mixed, numeric, 0.001).stages if hasattr(s, "surrogateDF")]
    built_in = Imputer(strategy="median", inputCols=["n", "m"], outputCols=["p", "q"]).fit(
        mixed.selectExpr("n", "cast(m AS double) AS m")
    )
    assert found.surrogateDF.first() == built_in.surrogateDF.first()


def wide_rows(spark, n, columns="i"):
    """A column of n texts, the first one in a third of all rows, with nulls."""
    text = F.when(F.col("id") % 3 == 0, "v0").when(F.col("id") % 1000 == 1, None)
    return spark.range(0, n * 2, 1, 8).select(
        F.col("id").alias("i"),
        text.otherwise(F.concat(F.lit("v"), (F.col("id") % n).cast("string"))).alias("c"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("d"),
        (F.col("id") % 17).cast("double").alias("x"),
        (F.col("id") % 2).cast("int").alias("y"),
    )


def test_wide_dictionaries_are_joined_and_agree_with_the_built_in_index(spark, tmp_path):
    df = wide_rows(spark, 700)
    built_in = PipelineModel(index_models(df, ["c", "d"]))
    joined = index_models(df, ["c", "d"], most_collected=50, wide=100)
    assert [type(m).__name__ for m in joined] == ["StringIndexerModel", "CategoryIndex"]
    assert expected_columns(PipelineModel(joined)) == (["c", "d"], [])
    more = df.union(spark.createDataFrame([(-1, "unseen", None, 0.0, 0)], "i long, c string, d string, x double, y int"))
    expected = sorted((r.i, r.c_idx, r.d_idx) for r in built_in.transform(more).collect())
    for stages in (joined, PipelineModel.load(saved(PipelineModel(joined), tmp_path / "m")).stages):
        got = PipelineModel(stages).transform(more)
        assert set(got.columns) == {*more.columns, "c_idx", "d_idx"}
        assert sorted((r.i, r.c_idx, r.d_idx) for r in got.collect()) == expected


def saved(model, path):
    model.write().overwrite().save(str(path))
    return str(path)


def test_frequent_and_null_values_are_joined_by_many_keys(spark):
    df = wide_rows(spark, 5000).repartition(16)
    (index,) = index_models(df, ["c"], most_collected=10, wide=10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan_text = plan(index.transform(df))
        assert "SortMergeJoin" in plan_text and "BroadcastHashJoin" not in plan_text
        got = index.transform(df)
        assert got.count() == df.count()
        assert got.where("c = 'v0'").select("c_idx").distinct().collect()[0][0] == 0.0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rare_values_share_a_slot(spark):
    seen = spark.createDataFrame([("a",)] * 4 + [("b",)] * 3 + [("c",)] * 2 + [("d",)], "c string")
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "new"), (5, None)], "i int, c string")
    indexers = index_models(seen, ["c"])
    stages = one_hot_model(spark, index_sizes(indexers), max_slots=2)
    found = PipelineModel([*indexers, *stages]).transform(df).orderBy("i").select("c_idx", vector_to_array("c_ohe")).collect()
    assert [r[0] for r in found] == [0.0, 1.0, 2.0, 3.0, 4.0, 4.0]
    assert [r[1].index(1.0) for r in found] == [0, 1, 2, 2, 3, 3]
    assert {len(r[1]) for r in found} == {4}


def test_a_very_wide_column_trains_and_scores(spark, tmp_path):
    """A dictionary beyond what the driver may hold: nothing of it is collected."""
    df = wide_rows(spark, 160_000)
    roles = ColumnRoles("y", ("i",), ("c", "d"), ("x",))
    with pytest.warns(UserWarning, match="very many"):
        fitted = fit_features(df, roles, max_slots=20)
    sizes = {type(s).__name__: s for s in fitted.stages}
    # Missing values count as one more category.
    assert sizes["CategoryIndex"].sizes == [df.select("c").distinct().count()]
    trees = learner(max_iter=1, max_depth=2).setLabelCol("y").fit(fitted.transform(df.limit(2000)))
    model = PipelineModel.load(saved(PipelineModel([*fitted.stages, trees]), tmp_path / "wide"))
    scored = model.transform(df.limit(500))
    assert scored.count() == 500
    # 20 values, the others, unseen; then d with its unseen slot, then x.
    assert scored.select(F.size(vector_to_array("features"))).first()[0] == 22 + 3 + 1


def test_ranks_of_many_equal_counts(spark):
    """Two levels: ranges are numbered apart, none holds more than a few percent."""
    df = spark.range(0, 200_000, 1, 8).select(
        F.concat(F.lit("l"), F.col("id").cast("string")).alias("value"),
        (F.col("id") % 2).alias("g"),
        F.lit(1).alias("n"),
    )
    placed, path = ranked(df, [F.desc("n"), F.asc("value")], per="g")
    largest = (
        spark.read.parquet(path)
        .groupBy(F.shiftright("__row__", ROW_BITS).alias("part"))
        .count()
        .agg(F.max("count"))
        .first()[0]
    )
    assert largest < 0.05 * 200_000
    got = placed.where("g = 1").orderBy("place").select("place", "value").collect()
    expected = sorted(f"l{i}" for i in range(1, 200_000, 2))
    assert [(r.place, r.value) for r in got] == list(enumerate(expected))
    drop_staged(spark, path)
