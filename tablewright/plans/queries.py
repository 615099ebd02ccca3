"""Registered queries: each operator over whole tables.

The tables hold no nulls, blanks or broken rows; where an operator needs some,
a query makes them from the values by a rule that its SQL twin repeats.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import clean, features, label, medians, metrics, split, validate
from tablewright.operators.header import clean_header
from tablewright.plans import train
from tablewright.plans.score import score, score_output, score_rows
from tablewright.roles import ColumnRoles, detect_roles
from tablewright.sources import tables
from tablewright.sources.runs import RunStore
from tablewright.sources.sinks import prediction_sample, write_table
from tablewright.sources.staging import new_path, stage
from tablewright.streaming import score as streaming

Query = Callable[[SparkSession, str], DataFrame]

SEED = 42
TEST_SIZE = 0.2
DOCUMENT_ROLES = ColumnRoles(
    label="quality",
    ids=("doc_id",),
    categorical=("lang", "source"),
    numeric=("n_chars", "n_words"),
)
SMALL_FOREST = train.TrainParams(max_iter=5, use_class_weights=True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Sources and sinks


def customer_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        "c_acctbal",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
    )


def written_csv(df: DataFrame, name: str) -> str:
    path = new_path(df.sparkSession, name)
    df.write.options(header=True, nullValue=tables.NULL_TEXT).csv(path)
    return path


def customer_types(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("c_custkey").cast("long"),
        "c_name",
        F.col("c_nationkey").cast("int"),
        F.col("c_acctbal").cast("double"),
        "c_mktsegment",
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written_csv(customer_with_nulls(spark, sf_dir), "customer")
    return customer_types(tables.open_table(spark, path).rows)


def csv_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written_csv(customer_with_nulls(spark, sf_dir), "customer")
    rows, _ = tables.open_text_table(spark, path)
    return customer_types(rows)


def ragged_csv(spark: SparkSession, sf_dir: str) -> str:
    """Customer lines where one market segment lacks its last two fields."""
    whole = F.concat_ws(",", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    torn = F.concat_ws(",", "c_custkey", "c_name")
    line = F.when(F.col("c_mktsegment") == "MACHINERY", torn).otherwise(whole)
    lines = read(spark, sf_dir, "customer").select(
        line.alias("c_custkey,c_name,c_nationkey,c_mktsegment")
    )
    path = new_path(spark, "ragged")
    lines.write.options(header=True, sep=";").csv(path)
    return path


def nation_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("c_nationkey").cast("int").alias("c_nationkey")).agg(
        F.count(F.lit(1)).alias("n")
    )


def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nation_counts(tables.open_table(spark, ragged_csv(spark, sf_dir)).rows)


def csv_malformed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = tables.open_text_table(spark, ragged_csv(spark, sf_dir))
    return nation_counts(rows)


def csv_malformed_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.when(F.col("c_mktsegment") == "FURNITURE", "none").otherwise(
        F.col("c_nationkey").cast("string")
    )
    path = written_csv(
        read(spark, sf_dir, "customer").select("c_custkey", broken.alias("c_nationkey")), "typed"
    )
    schema = T.StructType(
        [T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.IntegerType())]
    )
    return nation_counts(tables.open_table(spark, path, schema=schema).rows)


def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.request_rows(
        read(spark, sf_dir, "orders"), 25, ["o_orderkey"], drop=["o_orderstatus", "absent"]
    )


def request_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customer_with_nulls(spark, sf_dir)
    return tables.from_requests(tables.to_requests(rows), rows.schema)


def split_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customer_with_nulls(spark, sf_dir)
    return tables.from_split_requests(tables.to_split_requests(rows), rows.schema)


def two_orders(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Customers as CSV files of one folder, whose columns stand in one order or the other."""
    rows = customer_with_nulls(spark, sf_dir)
    path = written_csv(rows.filter("c_custkey % 3 = 0").select(*reversed(rows.columns)), "two_orders")
    odd = rows.filter("c_custkey % 3 <> 0")
    odd.write.mode("append").options(header=True, nullValue=tables.NULL_TEXT).csv(path)
    return path, rows


def csv_two_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns go by name, whatever their order in each file."""
    path, rows = two_orders(spark, sf_dir)
    return tables.open_table(spark, path, schema=rows.schema).rows


def csv_two_orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folder as text, the way scoring reads it."""
    path, _ = two_orders(spark, sf_dir)
    return customer_types(tables.open_text_table(spark, path)[0])


def csv_two_orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folder as a stream of files, broken rows and all: features and quarantine."""
    path, rows = two_orders(spark, sf_dir)
    torn = rows.select(F.concat_ws(",", "c_custkey", "c_name").alias(",".join(rows.columns)))
    torn.write.mode("append").options(header=True, sep=";").csv(path)
    roles = ColumnRoles("c_name", ("c_custkey",), ("c_mktsegment",), ("c_acctbal",))
    fitted = features.fit_features(rows, roles)
    output, broken = new_path(spark, "stream_files"), new_path(spark, "quarantine")
    query = streaming.score_files(
        spark, fitted, path, output, new_path(spark, "stream_state"), broken, keep_input=True
    )
    query.awaitTermination()
    kept = spark.read.parquet(output).select(
        F.col("c_custkey").cast("long"), "c_mktsegment", F.col("c_acctbal").cast("double"), F.lit(None).cast("string").alias("broken")
    )
    lost = spark.read.parquet(broken).select(
        F.lit(None).cast("long").alias("c_custkey"),
        F.lit(None).cast("string").alias("c_mktsegment"),
        F.lit(None).cast("double").alias("c_acctbal"),
        F.col(streaming.BROKEN_TEXT).alias("broken"),
    )
    return kept.unionByName(lost)


def broken_requests(requests: DataFrame) -> DataFrame:
    """The document of every seventh customer is cut in half."""
    key = F.regexp_extract("value", "([0-9]+)", 1).cast("long")
    cut = F.substring("value", 1, 20)
    return requests.select(F.when(key % 7 == 0, cut).otherwise(F.col("value")).alias("value"))


def requests_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customer_with_nulls(spark, sf_dir)
    return tables.from_requests(broken_requests(tables.to_requests(rows)), rows.schema)


def split_requests_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of every seventh customer lack their last cell."""
    rows = customer_with_nulls(spark, sf_dir)
    whole = tables.to_split_requests(rows)
    short = F.regexp_replace("value", ",[^,]*\\]\\]", "]]")
    key = F.regexp_extract("value", "\\[\\[([0-9]+)", 1).cast("long")
    broken = whole.select(F.when(key % 7 == 0, short).otherwise(F.col("value")).alias("value"))
    return tables.from_split_requests(broken, rows.schema)


def request_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 rows in one document and back."""
    rows = customer_with_nulls(spark, sf_dir)
    return tables.from_split_requests(
        tables.to_split_request(rows, 25, ["c_custkey"]), rows.schema
    )


# Header, roles and checks


def normalize_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    messy = customer.select(
        F.col("c_custkey").alias("\ufeffc_custkey"),
        F.col("c_name").alias(" c_name"),
        F.col("c_mktsegment").alias("c_name "),
        F.col("c_nationkey").alias("  "),
        F.col("c_acctbal").alias("c_acct.bal\t"),
    )
    return clean_header(messy)


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read(spark, sf_dir, "lineitem").withColumns(
        {
            "l_linestatus": F.when(F.col("l_linestatus") == "O", " ").otherwise(F.col("l_linestatus")),
            "l_tax": F.nullif("l_tax", F.lit(0.0)),
        }
    )
    roles = detect_roles(lineitem.schema, "l_returnflag", ["l_orderkey", "l_linenumber"])
    return validate.column_profile(lineitem, roles)


def label_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "view", " ")
        .otherwise(F.nullif("event_type", F.lit("error")))
        .alias("event_type")
    )
    return validate.profile(events, "event_type")


# Cleaning


def blank_to_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    messy = (
        F.when(kind == "error", " ")
        .when(kind == "signup", "")
        .when(kind == "view", None)
        .when(kind == "click", " click ")
        .otherwise(kind)
    )
    events = read(spark, sf_dir, "events").select("event_id", messy.alias("event_type"))
    return clean.clean_values(events, ["event_type"], [])


def numeric_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = F.get_json_object("props", "$.k")
    messy = F.when(kind == "error", "n/a").when(kind == "signup", "").otherwise(text)
    events = read(spark, sf_dir, "events").select(
        "event_id", messy.alias("k"), (kind == "view").alias("is_view")
    )
    return clean.clean_values(events, [], ["k", "is_view"])


def drop_null_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type")
    )
    return clean.drop_null_label(events, "event_type")


def dedup_ids_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read(spark, sf_dir, "lineitem")
    return clean.drop_duplicates(lineitem, ["l_orderkey"], "l_linenumber", order_by=["l_shipdate"])


def users_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.nullif("user_id", F.lit(8)).alias("user_id"), "event_type", "ts", "value"
    )


def dedup_null_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_duplicates(users_with_nulls(spark, sf_dir), ["user_id"], "event_type", keep="last")


def dedup_keep_null_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_duplicates(
        users_with_nulls(spark, sf_dir), ["user_id"], "event_type", null_ids="keep"
    )


def dedup_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and kind, by an instant that is no feature."""
    events = read(spark, sf_dir, "events")
    roles = ColumnRoles("event_type", ("user_id",), (), ("value",))
    rows = train.prepared_rows(events, roles, TEST_SIZE, SEED, order_by=["ts", "event_id"])
    return rows.drop("split_part")


# Label, weights and split


def label_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = label.label_table(read(spark, sf_dir, "orders"), "o_orderstatus")
    return found.select(F.col("idx").cast("int").alias("label"), "value", "n")


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    found = label.label_dictionary(orders, "o_orderstatus")
    return label.index_label(orders, "o_orderstatus", found)


def returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "R", "returned").otherwise("kept")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", flag.alias("state"))


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label.label_table(returned(spark, sf_dir), "state").drop("idx")


def customer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many classes as customers: the dictionary is a table, and joined."""
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return label.join_label_index(customer, "c_name", label.label_table(customer, "c_name"))


def row_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = returned(spark, sf_dir)
    found = label.label_dictionary(lineitem, "state")
    return label.add_class_weight(label.index_label(lineitem, "state", found), found.weights())


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return split.hash_split(orders, ["o_orderkey"], TEST_SIZE, SEED)


def portable_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return split.hash_split(orders, ["o_orderkey"], TEST_SIZE, SEED, portable=True)


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = split.hash_split(read(spark, sf_dir, "orders"), ["o_orderkey"], TEST_SIZE, SEED)
    return marked.groupBy("split_part").agg(F.count(F.lit(1)).alias("n"))


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    parts = split.random_split(orders, TEST_SIZE, SEED)
    first, second = [
        part.withColumn("split_part", F.lit(name)) for name, part in zip((split.TRAIN, split.TEST), parts)
    ]
    return first.unionByName(second)


def random_split_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both parts together hold every row once."""
    return random_split(spark, sf_dir).drop("split_part")


# Feature stages


def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    seen = documents.withColumn("source", F.nullif("source", F.lit("src3")))
    fitted = PipelineModel(features.index_models(seen, ["lang", "source"]))
    return fitted.transform(documents)


def category_index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a dictionary that is joined, for a column where nearly every row has its own."""
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    name = F.when(F.col("c_custkey") % 5 == 0, "Customer#0").when(F.col("c_custkey") % 7 == 0, None)
    named = customer.withColumn("c_name", name.otherwise(F.col("c_name")))
    seen = named.filter(F.col("c_custkey") % 11 != 0)
    indexers = features.index_models(seen, ["c_name", "c_mktsegment"], most_collected=20, wide=20)
    return PipelineModel(indexers).transform(named)


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    seen = customer.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    (indexer,) = features.index_models(seen, ["c_mktsegment"])
    encoder = features.one_hot_stage(["c_mktsegment"]).fit(indexer.transform(seen))
    vector = vector_to_array("c_mktsegment_ohe")
    return encoder.transform(indexer.transform(customer)).select(
        "c_custkey",
        F.size(vector).alias("size"),
        (F.array_position(vector, 1.0) - 1).alias("slot"),
        F.aggregate(vector, F.lit(0.0), lambda total, x: total + x).alias("total"),
    )


def gappy_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_quantity", F.lit(1.0)).alias("l_quantity"),
        F.when(F.col("l_returnflag") == "R", F.lit(float("nan")))
        .otherwise(F.col("l_extendedprice"))
        .alias("l_extendedprice"),
        F.when(F.col("l_discount").between(0.005, 0.095), F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_tax").between(0.005, 0.075), F.col("l_tax")).alias("l_tax"),
    )


PRICES = ["l_quantity", "l_extendedprice"]
RATES = ("l_discount", "l_tax")


def median_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = medians.exact_medians(gappy_lineitem(spark, sf_dir), PRICES)
    return spark.createDataFrame(list(found.items()), "column_name string, surrogate double")


def impute_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = gappy_lineitem(spark, sf_dir)
    filled = medians.impute(lineitem, medians.exact_medians(lineitem, PRICES))
    return filled.select("l_orderkey", "l_linenumber", *[f"{c}_imputed" for c in PRICES])


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = gappy_lineitem(spark, sf_dir)
    fitted = features.impute_stage(RATES, rank_error=0.001).fit(lineitem)
    return fitted.transform(lineitem).select(
        "l_orderkey", "l_linenumber", *[f"{c}_imputed" for c in RATES]
    )


def documents_with_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.size(F.split("text", " ")).alias("n_words")
    )


def feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = documents_with_words(spark, sf_dir)
    fitted = features.fit_features(documents, DOCUMENT_ROLES)
    slots = fitted.transform(documents).select(
        "doc_id", F.posexplode(vector_to_array("features")).alias("slot", "value")
    )
    return slots.filter(F.col("value") != 0)


def expected_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inputs a fitted model asks for, each with its number of rows."""
    documents = documents_with_words(spark, sf_dir)
    fitted = features.fit_features(documents, DOCUMENT_ROLES)
    categorical, numeric = features.expected_columns(fitted)
    return validate.column_profile(
        documents, ColumnRoles("quality", ("doc_id",), tuple(categorical), tuple(numeric))
    )


# Training and scoring


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = read(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents_with_words(spark, sf_dir).join(quality, "doc_id")


def prepared_documents(spark: SparkSession, sf_dir: str) -> train.Prepared:
    return train.prepare(
        spark,
        labelled_documents(spark, sf_dir),
        "quality",
        ["doc_id"],
        test_size=TEST_SIZE,
        seed=SEED,
        positive_label="1",
    )


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = prepared_documents(spark, sf_dir)
    parts = [
        prepared.part(name).withColumn("split_part", F.lit(name)) for name in (split.TRAIN, split.TEST)
    ]
    return parts[0].unionByName(parts[1])


def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = prepared_documents(spark, sf_dir)
    model = train.fit(prepared, SMALL_FOREST)
    return model.transform(prepared.part(split.TEST)).select(
        "doc_id",
        "label",
        "prediction",
        vector_to_array("probability")[1].alias("probability"),
    )


def score_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for every scored row, whatever the trees are."""
    prepared = prepared_documents(spark, sf_dir)
    model = train.fit(prepared, SMALL_FOREST)
    margin = vector_to_array("rawPrediction")
    share = vector_to_array("probability")
    return model.transform(prepared.part(split.TEST)).select(
        "doc_id",
        "label",
        (F.abs(share[0] + share[1] - 1) < 1e-9).alias("shares_sum_to_one"),
        (F.abs(margin[0] + margin[1]) < 1e-9).alias("margins_cancel"),
        (F.abs(share[1] - 1 / (1 + F.exp(-2 * margin[1]))) < 1e-9).alias("logistic_share"),
        ((share[1] > 0.5).cast("double") == F.col("prediction")).alias("majority_prediction"),
    )


def registered_model(spark: SparkSession, sf_dir: str) -> str:
    """Train on the labelled documents, register the model, put it in production."""
    runs_path = new_path(spark, "runs")
    train.train(
        spark,
        labelled_documents(spark, sf_dir),
        "quality",
        ["doc_id"],
        SMALL_FOREST,
        runs_path,
        experiment="documents",
        run_name="small",
        register_as="good_documents",
        positive_label="1",
    )
    RunStore(spark, runs_path).promote("good_documents", 1)
    return runs_path


def batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV file in, CSV folder out, with the registered model."""
    runs_path = registered_model(spark, sf_dir)
    source = written_csv(documents_with_words(spark, sf_dir), "documents")
    scored = score(
        spark, source, new_path(spark, "scores"), runs_path, "good_documents", label_text=True
    )
    rows = tables.open_table(spark, scored.path).rows
    return rows.select(F.col("doc_id").cast("long"), "prediction", "probability", "predicted_label")


def batch_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for every row of a scored file, whatever the trees are."""
    shares = F.split("probability", ",").cast("array<double>")
    likely = shares[1] > 0.5
    return batch_scores(spark, sf_dir).select(
        "doc_id",
        (F.abs(shares[0] + shares[1] - 1) < 1e-9).alias("shares_sum_to_one"),
        (likely.cast("double") == F.col("prediction")).alias("majority_prediction"),
        (likely.cast("int") == F.col("predicted_label")).alias("label_text"),
    )


def streamed(spark: SparkSession, sf_dir: str, model, run) -> DataFrame:
    source = stage(documents_with_words(spark, sf_dir), "incoming")
    stream = streaming.read_stream(spark, source, spark.read.parquet(source).schema)
    output = new_path(spark, "stream_scores")
    query = streaming.score_stream(
        model, stream, output, new_path(spark, "stream_state"), ids=["doc_id"], run=run
    )
    query.awaitTermination()
    return spark.read.parquet(output).select(
        "doc_id", "prediction", F.col("probability")[1].alias("probability")
    )


def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, run = RunStore(spark, registered_model(spark, sf_dir)).load("good_documents")
    return streamed(spark, sf_dir, model, run)


def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, run = RunStore(spark, registered_model(spark, sf_dir)).load("good_documents")
    stream = streamed(spark, sf_dir, model, run)
    batch = score_rows(model, documents_with_words(spark, sf_dir), run).select(
        "doc_id",
        F.col("prediction").alias("batch_prediction"),
        vector_to_array("probability")[1].alias("batch_probability"),
    )
    return stream.join(batch, "doc_id", "full_outer").select(
        "doc_id",
        F.col("prediction").eqNullSafe(F.col("batch_prediction")).alias("same_prediction"),
        F.col("probability").eqNullSafe(F.col("batch_probability")).alias("same_probability"),
    )


def run_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label texts and class weights as a training run has recorded them."""
    runs = RunStore(spark, registered_model(spark, sf_dir)).runs()
    pairs = runs.select("run_name", "class_weights", F.posexplode("label_values").alias("label", "value"))
    weight = F.col("class_weights")[F.col("label").cast("double").cast("string")]
    return pairs.select("run_name", "label", "value", weight.alias("class_weight"))


def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request documents through the feature stages as a stream."""
    documents = documents_with_words(spark, sf_dir)
    fitted = features.fit_features(documents, DOCUMENT_ROLES)
    source = new_path(spark, "requests")
    tables.to_split_requests(documents).write.text(source)
    stream = streaming.read_stream(spark, source, documents.schema, "split_requests")
    output = new_path(spark, "stream_features")
    kept = ["doc_id", "lang_idx", "source_idx", "n_chars_imputed", "n_words_imputed"]
    query = streaming.write_stream(
        score_rows(fitted, stream).select(*kept), output, new_path(spark, "stream_state")
    )
    query.awaitTermination()
    return spark.read.parquet(output).select(*kept)


def registered_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save, register, promote and load a fitted model, then apply it."""
    documents = documents_with_words(spark, sf_dir)
    store = RunStore(spark, new_path(spark, "runs"))
    for name, categorical in (("narrow", ("lang",)), ("wide", ("lang", "source"))):
        roles = ColumnRoles("quality", ("doc_id",), categorical, DOCUMENT_ROLES.numeric)
        run_id = store.log_run(
            "documents",
            name,
            roles=roles,
            training_schema=documents.schema,
            model=features.fit_features(documents, roles),
        )
        version = store.register("document_features", run_id)
        store.promote("document_features", version)
    model, run = store.load("document_features")
    return score_rows(model, documents, run).select("doc_id", "lang_idx", "source_idx")


def labelled_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with one feature of two values."""
    quality = read(spark, sf_dir, "labels").select("doc_id", "quality")
    language = F.when(F.col("lang") == "en", "en").otherwise("other")
    return read(spark, sf_dir, "documents").select("doc_id", language.alias("language")).join(
        quality, "doc_id"
    )


ONE_TREE = {"max_iter": 1, "max_depth": 1, "subsampling_rate": 1.0}


def prepared_languages(spark: SparkSession, sf_dir: str) -> train.Prepared:
    return train.prepare(
        spark, labelled_languages(spark, sf_dir), "quality", ["doc_id"], positive_label="1"
    )


def one_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One split on one feature: a leaf's margin is the weighted mean of its -1 and 1."""
    prepared = prepared_languages(spark, sf_dir)
    rows = prepared.part(split.TRAIN)
    fitted = []
    for name, weighted in (("plain", False), ("weighted", True)):
        model = train.fit(prepared, train.TrainParams(**ONE_TREE, use_class_weights=weighted))
        share = F.round(vector_to_array("probability")[1], 9)
        fitted.append(model.transform(rows).select("doc_id", "language", F.lit(name).alias("weights"), share.alias("probability")))
    return fitted[0].unionByName(fitted[1])


def two_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two splits on one feature: the second tree follows what the first one leaves of the loss."""
    prepared = prepared_languages(spark, sf_dir)
    rows = prepared.part(split.TRAIN)
    fitted = []
    for name, weighted in (("plain", False), ("weighted", True)):
        params = train.TrainParams(**ONE_TREE | {"max_iter": 2}, step_size=0.3, use_class_weights=weighted)
        share = F.round(vector_to_array("probability")[1], 9)
        fitted.append(train.fit(prepared, params).transform(rows).select("doc_id", "language", F.lit(name).alias("weights"), share.alias("probability")))
    return fitted[0].unionByName(fitted[1])


def refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What training and scoring refuse of the labelled documents, and the number that is named."""
    documents = labelled_documents(spark, sf_dir)
    quality = F.col("quality")

    def prepared(rows: DataFrame, label: str = "quality") -> None:
        train.prepare(spark, rows, label, ["doc_id"]).drop()

    def scored_without_language() -> None:
        fitted = features.fit_features(documents, DOCUMENT_ROLES)
        score_rows(fitted, documents.drop("lang"))

    tries: dict[str, Callable[[], object]] = {
        "absent file": lambda: tables.open_table(spark, f"{sf_dir}/absent.csv"),
        "no label column": lambda: prepared(documents, "absent"),
        "no rows": lambda: prepared(documents.filter("doc_id < 0")),
        "null labels": lambda: prepared(documents.withColumn("quality", F.nullif(quality, F.lit(1)))),
        "one class": lambda: prepared(documents.filter("quality = 1")),
        "many classes": lambda: prepared(documents.withColumn("quality", F.col("n_chars"))),
        "no features": lambda: prepared(documents.select("doc_id", "quality")),
        "missing input": scored_without_language,
        "test size": lambda: train.TrainParams(test_size=1.0),
        "sample size": lambda: train.TrainParams(sample_size=0),
        "nothing": lambda: prepared(documents),
    }
    found = []
    for name, attempt in tries.items():
        try:
            attempt()
            message = None
        except (ValueError, AnalysisException) as error:
            message = str(error)
        number = re.search(r"^\D*(\d+) (?:rows|class)", message or "")
        found.append((name, message is not None, int(number[1]) if number else None))
    return spark.createDataFrame(found, "attempt string, refused boolean, number long")


def training_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a training run has recorded about such a tree on its test rows."""
    runs_path = new_path(spark, "runs")
    train.train(
        spark,
        labelled_languages(spark, sf_dir),
        "quality",
        ["doc_id"],
        train.TrainParams(**ONE_TREE),
        runs_path,
        run_name="one_tree",
        positive_label="1",
    )
    metric = F.col("metrics")
    return RunStore(spark, runs_path).runs().select(
        "run_name",
        F.round(metric["accuracy"], 9).alias("accuracy"),
        F.round(metric["f1"], 9).alias("f1"),
        F.round(metric["roc_auc"], 9).alias("roc_auc"),
    )


def grid_to_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parameter sets, the best one registered, promoted, and nothing else."""
    runs_path = new_path(spark, "runs")
    grid = {f"depth{d}": train.TrainParams(max_iter=2, max_depth=d) for d in (1, 2, 3)}
    train.train_grid(
        spark,
        labelled_documents(spark, sf_dir),
        "quality",
        ["doc_id"],
        grid,
        runs_path,
        register_as="good_documents",
        register_best="roc_auc",
        positive_label="1",
    )
    store = RunStore(spark, runs_path)
    store.promote("good_documents", 1)
    model, run = store.load("good_documents")
    documents = documents_with_words(spark, sf_dir)
    best = store.runs().agg(F.max(F.col("metrics")["roc_auc"]).alias("best")).first().best
    return score_rows(model, documents, run).select(
        "doc_id",
        F.lit(run.metrics["roc_auc"] == best).alias("is_best"),
        F.lit(store.versions("good_documents").count()).alias("versions"),
    )


def chosen_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit feature lists, fitted on the training part alone."""
    prepared = train.prepare(
        spark,
        labelled_documents(spark, sf_dir),
        "quality",
        ["doc_id"],
        categorical=["source", "absent", "quality"],
        numeric=["n_chars"],
    )
    fitted = train.fit_prepared_features(prepared)
    return fitted.transform(prepared.part(split.TEST)).select("doc_id", "source_idx", "n_chars_imputed")


# Evaluation


def rule_predictions(spark: SparkSession, sf_dir: str, border: int = 1500) -> DataFrame:
    """Long documents are predicted to be good."""
    quality = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    documents = read(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return documents.join(quality, "doc_id").select(
        "doc_id",
        "label",
        F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") > border).cast("double").alias("prediction"),
    )


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(rule_predictions(spark, sf_dir))


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_report(confusion(spark, sf_dir)).withColumn("f1", F.round("f1", 9))


def accuracy_and_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.accuracy_and_f1(confusion(spark, sf_dir)).select(
        F.round("accuracy", 9).alias("accuracy"), F.round("f1", 9).alias("f1")
    )


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = metrics.roc_area(rule_predictions(spark, sf_dir), score="score")
    return area.select(F.round("roc_auc", 9).alias("roc_auc"))


# Output and run selection


def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a two-class score as a vector, made from the price."""
    high = F.when(F.col("o_totalprice") > 200000, 0.75).otherwise(0.25)
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        (high > 0.5).cast("double").alias("prediction"),
        F.array(1 - high, high).alias("shares"),
    )


def with_probability(df: DataFrame) -> DataFrame:
    return df.withColumn("probability", array_to_vector("shares")).drop("shares")


def output_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_probability(rule_scores(spark, sf_dir))
    return score_output(scored, ["o_orderkey", "absent"], "o_orderstatus", None, "csv")


def output_keep_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_probability(rule_scores(spark, sf_dir))
    kept = ["o_orderkey", "o_orderpriority", "o_orderstatus", "prediction", "probability"]
    return score_output(scored, ["o_orderkey"], "o_orderstatus", kept, "csv")


def sample_of_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_probability(rule_scores(spark, sf_dir))
    path = new_path(spark, "sample")
    write_table(prediction_sample(scored, ["o_orderkey"], "o_orderstatus", 200), path)
    rows = tables.open_table(spark, path).rows
    return rows.select(F.col("o_orderkey").cast("long"), "o_orderstatus", "prediction", "probability")


BORDERS = (500, 1500, 3000)


def rule_runs(spark: SparkSession, sf_dir: str) -> RunStore:
    """One run per border of the length rule, with its quality."""
    store = RunStore(spark, new_path(spark, "runs"))
    for border in BORDERS:
        counts = metrics.confusion(rule_predictions(spark, sf_dir, border))
        shares = metrics.accuracy_and_f1(counts).first()
        store.log_run(
            "length_rule",
            f"border_{border}",
            params={"border": border},
            tags={"model": "rule"},
            metrics={"accuracy": round(shares.accuracy, 9), "f1": round(shares.f1, 9)},
            label_values=("0", "1"),
        )
    return store


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_runs(spark, sf_dir).runs().select(
        "run_name",
        F.col("params")["border"].cast("int").alias("border"),
        F.col("metrics")["accuracy"].alias("accuracy"),
        F.col("metrics")["f1"].alias("f1"),
        F.concat_ws(",", "label_values").alias("label_values"),
    )


def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = rule_runs(spark, sf_dir).best_run("accuracy", "length_rule")
    rows = [(best.run_name, best.metrics["accuracy"])]
    return spark.createDataFrame(rows, "run_name string, accuracy double")


QUERIES: dict[str, Query] = {
    "csv_roundtrip": csv_roundtrip,
    "csv_text_scan": csv_text_scan,
    "csv_malformed": csv_malformed,
    "csv_malformed_text": csv_malformed_text,
    "csv_malformed_typed": csv_malformed_typed,
    "request_rows": request_rows,
    "csv_two_orders": csv_two_orders,
    "csv_two_orders_text": csv_two_orders_text,
    "csv_two_orders_stream": csv_two_orders_stream,
    "request_json": request_json,
    "requests_malformed": requests_malformed,
    "split_requests_malformed": split_requests_malformed,
    "request_document": request_document,
    "split_requests": split_requests,
    "normalize_header": normalize_header,
    "column_profile": column_profile,
    "label_profile": label_profile,
    "blank_to_missing": blank_to_missing,
    "numeric_cast": numeric_cast,
    "drop_null_label": drop_null_label,
    "dedup_ids_label": dedup_ids_label,
    "dedup_null_ids": dedup_null_ids,
    "dedup_keep_null_ids": dedup_keep_null_ids,
    "dedup_prepared": dedup_prepared,
    "label_dictionary": label_dictionary,
    "customer_names": customer_names,
    "label_index": label_index,
    "class_weights": class_weights,
    "row_weights": row_weights,
    "hash_split": hash_split,
    "portable_split": portable_split,
    "split_counts": split_counts,
    "random_split": random_split,
    "random_split_cover": random_split_cover,
    "category_index": category_index,
    "category_index_table": category_index_table,
    "one_hot": one_hot,
    "median_surrogates": median_surrogates,
    "impute_exact": impute_exact,
    "impute_median": impute_median,
    "feature_vector": feature_vector,
    "expected_columns": expected_columns,
    "training_rows": training_rows,
    "gbt_scores": gbt_scores,
    "score_contract": score_contract,
    "batch_scores": batch_scores,
    "batch_contract": batch_contract,
    "run_dictionaries": run_dictionaries,
    "stream_scores": stream_scores,
    "stream_equals_batch": stream_equals_batch,
    "stream_features": stream_features,
    "registered_features": registered_features,
    "one_tree_scores": one_tree_scores,
    "two_tree_scores": two_tree_scores,
    "refusals": refusals,
    "training_metrics": training_metrics,
    "grid_to_production": grid_to_production,
    "chosen_features": chosen_features,
    "confusion": confusion,
    "class_report": class_report,
    "accuracy_and_f1": accuracy_and_f1,
    "roc_auc": roc_auc,
    "output_columns": output_columns,
    "output_keep_input": output_keep_input,
    "prediction_sample": sample_of_predictions,
    "run_log": run_log,
    "best_run": best_run,
}
