import pytest
from pyspark.sql import types as T

from tablewright.operators.header import clean_header
from tablewright.roles import (
    ColumnRoles,
    check_reserved,
    clean_name,
    clean_names,
    detect_roles,
    output_columns,
    restrict_roles,
)


@pytest.mark.parametrize(
    "raw, cleaned",
    [(None, ""), ("", ""), (" x ", "x"), ("\ufeffq", "q"), ("a\ufeffb", "ab"), ("  x\t\n", "x")],
)
def test_clean_name(raw, cleaned):
    assert clean_name(raw) == cleaned


def test_clean_names_keeps_first_of_equal_names():
    assert clean_names([" a", "b", "a ", None, "  "]) == ["a", "b"]


def test_header_drops_nameless_and_repeated_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "a int, b int, c int, d int, e int")
    messy = df.toDF("x", " x", "x ", "   ", "\ufeffq")
    cleaned = clean_header(messy)
    assert cleaned.columns == ["x", "q"]
    assert tuple(cleaned.first()) == (1, 5)


def test_header_with_dots_back_ticks_and_exact_duplicates(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    cleaned = clean_header(df.toDF("a.b", "we`ird", "z", "z"))
    assert cleaned.columns == ["a.b", "we`ird", "z"]
    assert tuple(cleaned.first()) == (1, 2, 3)


def test_header_names_equal_up_to_case(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF("Age", " age")
    with pytest.raises(ValueError, match="only in case"):
        clean_header(df)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert clean_header(df).columns == ["Age", "age"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_detect_roles_follows_types_and_schema_order(spark):
    schema = T.StructType.fromDDL(
        "id long, y string, s string, i int, d double, m decimal(5,2), b boolean, dt date, "
        "ts timestamp, arr array<int>, mp map<string,int>"
    )
    roles = detect_roles(schema, "y", ["id"])
    assert roles.categorical == ("s", "dt", "ts", "arr", "mp")
    assert roles.numeric == ("i", "d", "m", "b")


def test_restrict_roles():
    roles = ColumnRoles("y", ("id",))
    found = restrict_roles(
        ["id", "y", "a", "b", "label", "features"],
        roles,
        categorical=[" a", "a", "y", "label", None, "gone"],
        numeric=["b", "id", "features"],
    )
    assert found == ColumnRoles("y", ("id",), ("a",), ("b",))


@pytest.mark.parametrize("name", ["label", "class_weight", "Prediction", "a_idx", "a_ohe", "n_imputed"])
def test_generated_names_are_reserved(name):
    with pytest.raises(ValueError, match="generated names"):
        check_reserved(["a", "n", "y", name], ColumnRoles("y", (), ("a",), ("n",)))


def test_names_that_only_look_generated_are_free():
    check_reserved(["a", "n", "y", "n_idx", "a_imputed"], ColumnRoles("y", (), ("a",), ("n",)))


def test_output_columns():
    scored = ["id", "y", "a", "features", "prediction", "probability"]
    assert output_columns(scored, ["id", "gone"], "y") == ["id", "y", "prediction", "probability"]
    assert output_columns(scored, [], None) == ["prediction", "probability"]
    assert output_columns(scored, ["id"], "y", ["id", "y", "a"]) == [
        "id",
        "y",
        "a",
        "prediction",
        "probability",
    ]
    assert output_columns(["a", "b"], ["id"], "y") == ["a", "b"]
