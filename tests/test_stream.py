import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tablewright.operators.features import fit_features, index_models, learner
from tablewright.plans.score import score_rows
from tablewright.roles import ColumnRoles
from tablewright.sources.tables import to_requests, to_split_requests
from tablewright.streaming.score import (
    marked_batch,
    read_stream,
    score_files,
    score_stream,
    text_schema,
    write_stream,
)
from tests.support import rows, write_lines

ROLES = ColumnRoles("y", ("o_orderkey",), ("o_orderpriority",), ("o_totalprice",))


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus"
    )


@pytest.fixture(scope="module")
def model(orders):
    from pyspark.ml import PipelineModel

    labelled = orders.withColumn("label", (F.col("o_orderstatus") == "F").cast("double"))
    features = fit_features(labelled, ROLES)
    trees = learner(max_iter=2, max_depth=2).fit(features.transform(labelled))
    return PipelineModel([*features.stages, trees])


def batch(model, orders):
    return score_rows(model, orders).select("o_orderkey", "prediction")


def run_stream(spark, model, stream, tmp_path):
    query = score_stream(
        model, stream, str(tmp_path / "out"), str(tmp_path / "state"), ids=["o_orderkey"]
    )
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


@pytest.mark.parametrize("format", ["parquet", "requests", "split_requests", "csv"])
def test_stream_equals_batch(spark, model, orders, tmp_path, format):
    source = str(tmp_path / "in")
    wide = orders.repartition(5)
    if format == "requests":
        to_requests(wide).write.text(source)
    elif format == "split_requests":
        to_split_requests(wide).write.text(source)
    elif format == "csv":
        wide.write.options(header=True, nullValue="NA").csv(source)
    else:
        wide.write.parquet(source)
    schema = text_schema(orders.columns) if format == "csv" else orders.schema
    stream = read_stream(spark, source, schema, format, files_per_trigger=2)
    assert stream.isStreaming
    found = run_stream(spark, model, stream, tmp_path).select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), "prediction"
    )
    expected = batch(model, orders)
    assert found.count() == orders.count()
    assert found.exceptAll(expected).count() == 0


def test_a_restart_scores_only_new_files(spark, model, orders, tmp_path):
    source = str(tmp_path / "in")
    orders.filter("o_orderkey < 500").write.parquet(source)
    for part in (None, "o_orderkey >= 500"):
        if part:
            orders.filter(part).write.mode("append").parquet(source)
        found = run_stream(spark, model, read_stream(spark, source, orders.schema), tmp_path)
    assert found.exceptAll(found.distinct()).count() == 0
    assert found.select("o_orderkey").exceptAll(orders.select("o_orderkey")).count() == 0
    assert found.count() == orders.count()


def test_csv_stream_counts_malformed_rows(spark, model, orders, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_lines(source / "a.csv", ",".join(orders.columns), "1,1-URGENT,5.5,F", "2,1-URGENT", "3,NA,,O")
    stream = read_stream(spark, str(source), text_schema(orders.columns), "csv")
    query = score_stream(model, stream, str(tmp_path / "out"), str(tmp_path / "state"), ids=["o_orderkey"])
    query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.o_orderkey for r in found.collect()) == ["1", "3"]
    assert query.lastProgress.observedMetrics["malformed"].malformed == 1


def test_csv_stream_with_other_header_is_refused(spark, model, orders, tmp_path):
    source = str(tmp_path / "in")
    orders.withColumnRenamed("o_totalprice", "total").write.option("header", True).csv(source)
    stream = read_stream(spark, source, text_schema(orders.columns), "csv")
    with pytest.raises(StreamingQueryException):
        run_stream(spark, model, stream, tmp_path)


def test_unknown_format_is_refused(spark, tmp_path, orders):
    with pytest.raises(ValueError, match="Unknown format 'orc'"):
        read_stream(spark, str(tmp_path), orders.schema, "orc")


def test_stream_survives_broken_requests(spark, tmp_path, orders, model):
    source, out = tmp_path / "broken", str(tmp_path / "broken_out")
    source.mkdir()
    wide = orders.limit(3)
    lines = [r.value for r in to_split_requests(wide).collect()]
    write_lines(source / "a.txt", *lines, "no json", '{"dataframe_split":{"columns":["a","b"],"data":[[1]]}}')
    stream = read_stream(spark, str(source), wide.schema, "split_requests")
    query = score_stream(model, stream, out, str(tmp_path / "broken_state"), ids=["o_orderkey"])
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 3
    assert sum(p.observedMetrics["malformed"].malformed for p in query.recentProgress if p.observedMetrics) == 2


def test_headers_with_spaces(spark, tmp_path, orders, model):
    source, out = tmp_path / "spaced", str(tmp_path / "spaced_out")
    source.mkdir()
    write_lines(source / "a.csv", "o_orderkey, o_orderpriority ,o_totalprice", "7,1-URGENT,5.0")
    stream = read_stream(
        spark, str(source), text_schema(["o_orderkey", " o_orderpriority ", "o_totalprice"]), "csv"
    )
    score_stream(model, stream, out, str(tmp_path / "spaced_state"), ids=["o_orderkey"]).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def files_run(spark, model, tmp_path, **options):
    query = score_files(
        spark, model, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"),
        quarantine=str(tmp_path / "broken"), ids=["o_orderkey"], **options
    )
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out")), spark.read.parquet(str(tmp_path / "broken"))


def test_files_with_two_column_orders_and_broken_rows(spark, model, orders, tmp_path):
    """A batch that ran but was not noted runs again: no row twice, broken rows to be read."""
    source = tmp_path / "in"
    source.mkdir()
    header = ["o_orderkey", "o_orderpriority", "o_totalprice"]
    write_lines(source / "a.csv", ",".join(header), "1,1-URGENT,5.5", "2,1-URGENT", "3,NA,")
    write_lines(source / "b.csv", ",".join(header[::-1]), "7.5,2-HIGH,4", "a,b,c,d")
    found, broken = files_run(spark, model, tmp_path)
    assert rows(found.select("o_orderkey"), "o_orderkey") == [("1",), ("3",), ("4",)]
    expected = score_rows(model, spark.createDataFrame([("4", "2-HIGH", "7.5")], header)).first()
    assert found.where("o_orderkey = 4").first().probability == expected.probability.tolist()
    assert rows(broken.select("value"), "value") == [("2,1-URGENT",), ("a,b,c,d",)]
    for noted in (tmp_path / "state" / "commits").iterdir():
        noted.unlink()
    write_lines(source / "c.csv", ",".join(header), "9,1-URGENT,1")
    found, broken = files_run(spark, model, tmp_path)
    assert rows(found.select("o_orderkey"), "o_orderkey") == [("1",), ("3",), ("4",), ("9",)]
    assert found.select("batch").distinct().count() == 2 and broken.count() == 2


def test_files_of_requests(spark, model, orders, tmp_path):
    wide = orders.limit(5)
    to_requests(wide).repartition(3).write.text(str(tmp_path / "in"))
    write_lines(tmp_path / "in" / "z.txt", "no json")
    found, broken = files_run(spark, model, tmp_path, format="requests", schema=wide.schema, files_per_trigger=1)
    assert found.select("o_orderkey").exceptAll(wide.select("o_orderkey")).count() == 0 and found.count() == 5
    assert rows(broken.select("value")) == [("no json",)]
    with pytest.raises(ValueError, match="Unknown format 'orc'"):
        marked_batch(spark, [], "orc", wide.schema)


def test_a_joined_dictionary_in_a_stream(spark, orders, tmp_path):
    """A wide column's index is a join with a table, in a stream as in a batch."""
    rows_in = orders.withColumn("o_orderpriority", F.concat_ws("-", "o_orderpriority", F.col("o_orderkey") % 40))
    (index,) = index_models(rows_in, ["o_orderpriority"], most_collected=10, wide=10)
    source = str(tmp_path / "in")
    rows_in.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderpriority"))).write.parquet(source)
    stream = read_stream(spark, source, rows_in.schema)
    write_stream(index.transform(stream), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    expected = index.transform(spark.read.parquet(source))
    assert found.count() == expected.count() and found.exceptAll(expected.select(found.columns)).count() == 0
