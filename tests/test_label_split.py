import hashlib

import pytest
from pyspark.sql import functions as F

from tablewright.operators.label import (
    LabelDictionary,
    add_class_weight,
    index_label,
    join_label_index,
    label_dictionary,
    label_table,
    two_labels,
)
from tablewright.operators.split import hash_split, random_split
from tests.support import plan, rows


def labels(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"y {kind}")


def test_order_is_frequency_then_text(spark):
    found = label_dictionary(labels(spark, ["b", "a", "c", "c", None]), "y")
    assert found == LabelDictionary(("c", "a", "b"), (2, 1, 1))


def test_same_order_as_the_built_in_indexer(spark, sf_dir):
    from pyspark.ml.feature import StringIndexer

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("source")
    fitted = StringIndexer(inputCol="source", outputCol="i").fit(documents)
    assert list(label_dictionary(documents, "source").values) == list(fitted.labels)


def test_integer_and_boolean_labels(spark):
    assert label_dictionary(labels(spark, [1, 0, 1], "int"), "y").values == ("1", "0")
    truth = labels(spark, [True, False, True], "boolean")
    found = label_dictionary(truth, "y")
    assert found.values == ("true", "false")
    assert rows(index_label(truth, "y", found)) == [(True, 0.0), (False, 1.0), (True, 0.0)]


def test_positive_label_gets_the_last_index(spark):
    df = labels(spark, ["yes", "yes", "no"])
    assert label_dictionary(df, "y").values == ("yes", "no")
    assert label_dictionary(df, "y", positive="yes").values == ("no", "yes")
    with pytest.raises(ValueError, match="does not occur"):
        label_dictionary(df, "y", positive="maybe")


def test_unknown_label_fails(spark):
    with pytest.raises(Exception, match="(?i)unseen label"):
        index_label(labels(spark, ["z"]), "y", LabelDictionary(("a", "b"), (1, 1))).collect()


def test_any_number_of_classes(spark):
    df = spark.range(25_000).select((F.col("id") % 12_000).alias("y"))
    assert len(label_dictionary(df, "y").values) == 12_000
    table = label_table(df, "y")
    indexed = join_label_index(df, "y", table)
    assert indexed.select("label").distinct().count() == 12_000
    assert indexed.agg(F.max("label")).first()[0] == 11_999


def test_table_and_dictionary_agree(spark):
    df = labels(spark, ["b", "a", "c", "c", None, "d", "d", "d"])
    found = label_dictionary(df, "y")
    table = {r.value: (r.idx, r.n, r.class_weight) for r in label_table(df, "y").collect()}
    weights = found.weights()
    assert table == {
        v: (i, n, weights[float(i)]) for i, (v, n) in enumerate(zip(found.values, found.counts))
    }
    assert join_label_index(df, "y", label_table(df, "y")).filter("label IS NULL").count() == 1


def test_too_many_labels_are_not_collected(spark):
    df = spark.range(1000).select(F.col("id").alias("y"))
    with pytest.raises(ValueError, match="more than 999"):
        label_dictionary(df, "y", most=999)
    assert len(label_dictionary(df, "y", most=1000).values) == 1000


def test_two_labels_are_counted_without_collecting_others(spark):
    df = labels(spark, ["b", "b", "a", "c", "c", "c"])
    assert two_labels(df, "y", "a", "c") == (LabelDictionary(("c", "a"), (3, 1)), 2)
    assert two_labels(labels(spark, ["b", "b"]), "y", "b", "b") == (LabelDictionary(("b",), (2,)), 0)


def test_weights(spark):
    found = LabelDictionary(("a", "b"), (5, 2))
    assert found.weights() == {0.0: 0.7, 1.0: 1.75}
    assert found.as_text_weights() == {"0.0": 0.7, "1.0": 1.75}
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "label double")
    weighted = add_class_weight(df, found.weights())
    assert rows(weighted) == [(0.0, 0.7), (1.0, 1.75), (2.0, None)]


def test_weights_sum_to_the_number_of_rows():
    found = LabelDictionary(("a", "b", "c"), (17, 5, 3))
    assert sum(n * w for n, w in zip(found.counts, found.weights().values())) == pytest.approx(25)


def test_portable_split_by_key_hash(spark):
    df = spark.createDataFrame([(7, "x")], "id int, s string")
    share = int(hashlib.md5(b"42|7").hexdigest()[:15], 16) / 2**60
    assert hash_split(df, ["id"], 1 - share + 1e-6, 42, portable=True).first().split_part == "test"
    assert hash_split(df, ["id"], 1 - share - 1e-6, 42, portable=True).first().split_part == "train"


@pytest.mark.parametrize("portable", [False, True])
def test_very_small_and_very_large_shares(spark, portable):
    df = spark.range(2_000_000)
    for test_size in (0.00001, 0.99999):
        found = hash_split(df, ["id"], test_size, 42, portable=portable)
        counts = {r.split_part: r["count"] for r in found.groupBy("split_part").count().collect()}
        few = min(counts.values())
        assert len(counts) == 2 and 5 <= few <= 45


def test_split_does_not_depend_on_the_width_of_the_key(spark):
    df = spark.range(500)
    narrow = df.select(F.col("id").cast("int").alias("id"))
    for portable in (False, True):
        wide_parts = rows(hash_split(df, ["id"], 0.3, 1, portable=portable), "id")
        assert rows(hash_split(narrow, ["id"], 0.3, 1, portable=portable), "id") == wide_parts


def test_split_share_and_independence_of_partitioning(spark):
    df = spark.range(20000)
    for portable in (False, True):
        one = hash_split(df.repartition(1), ["id"], 0.2, 42, portable=portable)
        many = hash_split(df.repartition(7), ["id"], 0.2, 42, portable=portable)
        assert one.exceptAll(many).count() == 0
        share = one.filter("split_part = 'test'").count() / 20000
        assert share == pytest.approx(0.2, abs=0.01)
        other = hash_split(df, ["id"], 0.2, 43, portable=portable)
        assert one.exceptAll(other).count() > 0


def test_rows_with_null_ids_or_without_ids_are_spread(spark):
    df = spark.range(3000).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("x"))
    for ids in (["k"], [], ["gone"]):
        share = hash_split(df, ids, 0.2, 42).filter("split_part = 'test'").count() / 3000
        assert share == pytest.approx(0.2, abs=0.03)


def test_split_needs_no_shuffle(spark):
    assert "Exchange" not in plan(hash_split(spark.range(10), ["id"], 0.2, 42))


def test_random_split_covers_all_rows_once(spark):
    df = spark.range(1000)
    train, test = random_split(df, 0.2, 42)
    assert train.unionByName(test).exceptAll(df).count() == 0
    assert train.count() + test.count() == 1000


@pytest.mark.parametrize("size", [0, 1, -0.1, 1.5])
def test_test_size_range(spark, size):
    with pytest.raises(ValueError, match="test_size"):
        hash_split(spark.range(1), ["id"], size, 1)
