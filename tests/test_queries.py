"""Every registered query against its SQL twin, on whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'"
        )
    return connection


def sorted_rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(row[i] for i in order) for row in found], key=repr)


@pytest.mark.parametrize("name", entry_point.queries())
def test_query(spark, sf_dir, sql, name):
    df = entry_point.queries()[name](spark, sf_dir)
    found = [tuple(r) for r in df.collect()]
    assert found
    twin = entry_point.oracle_sql().get(name)
    if twin is None:
        return
    expected = sql.execute(twin)
    names = [column[0] for column in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted_rows(df.columns, found) == sorted_rows(names, expected.fetchall())


def test_every_twin_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["doc_id", "label", "prediction", "probability"]
    assert df.count() > 0
