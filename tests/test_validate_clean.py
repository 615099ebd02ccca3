import math

import pytest
from pyspark.sql import functions as F

from tablewright.operators.clean import (
    cleaning_stage,
    clean_values,
    drop_duplicates,
    drop_null_label,
)
from tablewright.operators.validate import check_required, profile, validate
from tablewright.roles import ColumnRoles
from tests.support import plan, rows


def test_profile(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), (" ",), ("a",)], "y string")
    assert rows(profile(df, "y")) == [(5, 1, 1, 3)]


@pytest.mark.parametrize(
    "data, schema, message",
    [
        ([(1, "a")], "id int, x string", "No label column"),
        ([], "y string, x string", "no rows"),
        ([("a", "1"), (None, "2"), (None, "3")], "y string, x string", "2 rows have no value"),
        ([("a", "1"), ("a", "2")], "y string, x string", "1 class, two or more"),
        ([("a", 1), ("b", 2)], "y string, id int", "no column is left"),
    ],
)
def test_guards(spark, data, schema, message):
    with pytest.raises(ValueError, match=message):
        validate(spark.createDataFrame(data, schema), "y", ["id"])


def test_guards_pass_and_learner_needs_two_classes(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "y string, n int, s string")
    assert validate(df, "y") == ColumnRoles("y", (), ("s",), ("n",))
    with pytest.raises(ValueError, match="exactly two classes"):
        validate(df, "y", learner=True)


def test_blank_labels_are_a_class_but_are_reported(spark):
    df = spark.createDataFrame([("a", 1), (" ", 2)], "y string, n int")
    with pytest.warns(UserWarning, match="1 rows have a blank label"):
        validate(df, "y")


def test_required_columns():
    check_required(["a", "b"], ["a"])
    with pytest.raises(ValueError, match=r"\['c'\]"):
        check_required(["a"], ["a", "c"])


BLANKS = [("a", "a"), (" ", "missing"), (None, "missing"), (" b ", " b "), ("\t", "\t"), ("", "missing")]


def test_categories(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(BLANKS)], "i int, `a.c` string")
    found = rows(clean_values(df, ["a.c"], []), "i")
    assert [value for _, value in found] == [cleaned for _, cleaned in BLANKS]


def test_numbers(spark):
    df = spark.createDataFrame(
        [("1", True, 3), ("abc", False, None), ("true", None, 5), (" 7 ", True, 1)],
        "t string, b boolean, i int",
    )
    found = rows(clean_values(df, [], ["t", "b", "i"]))
    assert found == [(1.0, 1.0, 3.0), (None, 0.0, None), (None, None, 5.0), (7.0, 1.0, 1.0)]


def test_other_types_become_text_categories(spark):
    df = spark.sql("SELECT date'2020-01-02' AS d, array(1, 2) AS a, map('k', 1) AS m, named_struct('x', 1) AS s")
    found = clean_values(df, df.columns, []).first()
    assert tuple(found) == ("2020-01-02", "[1, 2]", "{k -> 1}", "{1}")


def test_stage_and_function_agree(spark):
    df = spark.createDataFrame(
        [(i, raw, t) for i, ((raw, _), t) in enumerate(zip(BLANKS, ["1", "x", None, "", "2e3", " "]))],
        "i int, `a.c` string, `n 1` string",
    )
    roles = ColumnRoles("y", ("i",), ("a.c",), ("n 1",))
    staged = cleaning_stage(roles).transform(df).select(*[f"`{c}`" for c in df.columns])
    assert rows(staged, "i") == rows(clean_values(df, roles.categorical, roles.numeric), "i")


def test_cleaning_is_one_projection(spark):
    df = spark.range(5).select("id", *[F.lit("x").alias(f"c{i}") for i in range(30)])
    text = plan(clean_values(df, [f"c{i}" for i in range(30)], ["id"]))
    assert text.count("Project") == 1 and "Exchange" not in text


def test_drop_null_label_is_pushed_down(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")
    assert "PushedFilters: [IsNotNull(o_orderstatus)]" in plan(drop_null_label(orders, "o_orderstatus"))


COPIES = [(None, "Y", 1), (None, "Y", 2), (1, "Y", 3), (1, "N", 4), (1, "Y", 5)]


@pytest.fixture
def copies(spark):
    return spark.createDataFrame(COPIES, "id int, y string, x int")


def test_duplicates(copies):
    found = drop_duplicates(copies, ["id", "gone"], "y")
    assert found.columns == ["id", "y", "x"]
    assert sorted(rows(found), key=str) == [(1, "N", 4), (1, "Y", 3), (None, "Y", 1)]
    last = drop_duplicates(copies, ["id"], "y", keep="last")
    assert sorted(rows(last), key=str) == [(1, "N", 4), (1, "Y", 5), (None, "Y", 2)]


def test_null_ids_can_be_kept(copies):
    kept = drop_duplicates(copies, ["id"], "y", null_ids="keep")
    assert sorted(rows(kept), key=str) == [(1, "N", 4), (1, "Y", 3), (None, "Y", 1), (None, "Y", 2)]


def test_no_ids_no_deduplication(copies):
    assert drop_duplicates(copies, ["gone"], "y") is copies


def test_only_key_columns(copies):
    found = drop_duplicates(copies.select("y", "id"), ["id"], "y")
    assert found.columns == ["y", "id"] and found.count() == 3


def test_survivor_follows_order_and_not_partitioning(spark):
    df = spark.range(6000).select(
        (F.col("id") % 7).alias("k"),
        F.lit("y").alias("y"),
        (F.hash("id") % 50).alias("at"),
        F.col("id").cast("string").alias("note"),
    )
    one = rows(drop_duplicates(df.repartition(1), ["k"], "y", ["at"]), "k")
    many = rows(drop_duplicates(df.repartition(9), ["k"], "y", ["at"]), "k")
    best = {}
    for r in df.collect():
        best[r.k] = min(best.get(r.k, (math.inf, "")), (r.at, r.note))
    assert one == many == [(k, "y", *best[k]) for k in range(7)]


def test_a_hot_key_is_reduced_before_the_shuffle(spark, tmp_path):
    """A third of the rows share one key: each task sends at most one of them."""
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        F.lit("y").alias("y"),
        F.col("id").alias("x"),
    )
    found = drop_duplicates(df, ["k"], "y")
    assert found.count() == 20001
    assert found.filter("k = -1").first().x == 0
    text = plan(found)
    assert text.index("partial_min") > text.index("Exchange") and text.count("Exchange") == 1
