import csv
import random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright import RunStore, TrainParams, prepare, score, score_rows, train, train_grid
from tablewright.operators.features import expected_columns
from tablewright.plans.train import fit, fit_prepared_features
from tablewright.sources.staging import folder_exists, shared_folder
from tests.support import plan, rows, write_lines

SMALL = TrainParams(max_iter=3, max_depth=3, use_class_weights=True, sample_size=5)


def customer_lines(n=400, seed=3, labelled=True):
    """Customers who call support often leave; some fields are empty, NA or blank."""
    draw = random.Random(seed)
    lines = []
    for i in range(n):
        plan_name = draw.choice(["basic", "plus", " ", "NA", "pro"])
        calls = draw.choice(["0", "1", "2", "5", "8", "NA"])
        active = draw.choice(["true", "false"])
        leaves = "Yes" if calls in ("5", "8") and draw.random() < 0.9 else "No"
        fields = [str(i), plan_name, calls, active]
        lines.append(",".join([*fields, leaves] if labelled else fields))
    return lines


HEADER = "\ufeffCustomer, plan,calls,active"


@pytest.fixture(scope="module")
def training_file(tmp_path_factory):
    lines = customer_lines()
    return write_lines(
        tmp_path_factory.mktemp("train") / "train.csv",
        HEADER + ",leaves",
        *lines,
        lines[0],
        "400,pro",
    )


@pytest.fixture(scope="module")
def trained(spark, training_file, tmp_path_factory):
    runs_path = str(tmp_path_factory.mktemp("runs"))
    run = train(
        spark,
        training_file,
        " leaves",
        ["Customer"],
        SMALL,
        runs_path,
        experiment="customers",
        run_name="small",
        register_as="leavers",
        positive_label="Yes",
    )
    RunStore(spark, runs_path).promote("leavers", 1)
    return runs_path, run


def test_preparation(spark, training_file):
    prepared = prepare(spark, training_file, "leaves", ["Customer"], positive_label="Yes")
    assert prepared.roles.categorical == ("plan",) and prepared.roles.numeric == ("calls", "active")
    assert prepared.malformed == 1
    both = prepared.part("train").unionByName(prepared.part("test"))
    assert both.count() == 400
    assert both.filter("plan IS NULL OR trim(plan) = ''").count() == 0
    assert both.filter("plan = 'missing'").count() > 0
    assert rows(both.select("leaves", "label").distinct(), "label") == [("No", 0.0), ("Yes", 1.0)]
    assert both.agg(F.round(F.sum("class_weight"), 6)).first()[0] == 400
    assert "PartitionFilters: [isnotnull(split_part" in plan(prepared.part("train"))
    prepared.drop()
    assert not folder_exists(spark, prepared.staged)


def test_preparation_does_not_depend_on_partitioning(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id", (F.col("event_type") == "view").alias("y"), "value", "props"
    )
    found = []
    for n in (1, 7):
        prepared = prepare(spark, events.repartition(n), "y", ["user_id"])
        found.append(sorted(map(tuple, prepared.rows.collect())))
    assert found[0] == found[1]


def test_run_record(spark, trained):
    runs_path, run = trained
    assert set(run.metrics) == {"roc_auc", "accuracy", "f1"} and run.metrics["roc_auc"] > 0.8
    found = RunStore(spark, runs_path).run(run.run_id)
    assert found.metrics == run.metrics
    assert found.label_values == ["No", "Yes"]
    assert set(found.class_weights) == {"0.0", "1.0"}
    expected = {
        "data_path", "label_column", "id_columns", "test_size", "max_iter", "max_depth", "max_bins",
        "step_size", "subsampling_rate", "min_info_gain", "use_class_weights", "shuffle_partitions",
        "categorical_cols_count", "numeric_cols_count",
    }
    assert expected <= set(found.params)
    assert found.params["label_column"] == "leaves" and found.params["numeric_cols_count"] == "2"
    sample = spark.read.csv(f"{runs_path}/samples/{run.run_id}", header=True).collect()
    assert len(sample) == 5
    assert sample[0].asDict().keys() == {"Customer", "leaves", "prediction", "probability"}
    ids = [int(r.Customer) for r in sample]
    assert ids == sorted(ids)


def test_nothing_is_left_in_the_shared_folder(spark, training_file):
    from pathlib import Path

    folder = Path(shared_folder(spark)) / "tablewright"
    before = set(folder.iterdir())
    train(spark, training_file, "leaves", ["Customer"], SMALL)
    assert set(folder.iterdir()) == before


def read_output(path):
    found = []
    for file in sorted(path.glob("part-*.csv")):
        with file.open(newline="") as lines:
            found += list(csv.DictReader(lines))
    return found


def test_batch_scoring_of_a_file(spark, trained, tmp_path):
    runs_path, run = trained
    holdout = write_lines(
        tmp_path / "holdout.csv", HEADER, *customer_lines(60, 9, labelled=False), "60,pro,many,true", "61,pro"
    )
    done = score(spark, holdout, str(tmp_path / "out"), runs_path, "leavers", label_text=True)
    assert done.malformed == 1
    found = read_output(tmp_path / "out")
    assert sorted(int(r["Customer"]) for r in found) == list(range(61))
    assert set(found[0]) == {"Customer", "prediction", "probability", "predicted_label"}
    for r in found:
        no, yes = map(float, r["probability"].split(","))
        assert no + yes == pytest.approx(1)
        assert r["prediction"] == ("1.0" if yes > 0.5 else "0.0")
        assert r["predicted_label"] == ("Yes" if r["prediction"] == "1.0" else "No")


def test_scores_of_typed_and_text_input_agree(spark, trained, training_file, tmp_path):
    from tablewright.operators.header import clean_header
    from tablewright.sources.tables import open_table

    runs_path, run = trained
    typed = clean_header(open_table(spark, training_file).rows)
    direct = score_rows(run.model, typed).select(
        F.col("Customer").cast("string").alias("Customer"), "prediction"
    )
    score(spark, training_file, str(tmp_path / "out"), runs_path, "leavers")
    written = spark.read.csv(str(tmp_path / "out"), header=True)
    assert written.columns == ["Customer", "leaves", "prediction", "probability"]
    from_file = written.select("Customer", F.col("prediction").cast("double").alias("prediction"))
    assert direct.exceptAll(from_file).count() == 0 and from_file.exceptAll(direct).count() == 0


def test_keeping_the_input(spark, trained, tmp_path):
    runs_path, _ = trained
    df = spark.createDataFrame(
        [(1, "plus", 5, True, [1, 2])], "Customer int, plan string, calls int, active boolean, extra array<int>"
    )
    out = str(tmp_path / "out")
    score(spark, df, out, runs_path, "leavers", keep_input=True)
    (found,) = read_output(tmp_path / "out")
    assert list(found) == [*df.columns, "prediction", "probability"]
    assert (found["plan"], found["calls"], found["extra"]) == ("plus", "5.0", "[1,2]")
    score(spark, df, out, runs_path, "leavers", keep_input=True, output_format="parquet")
    assert len(spark.read.parquet(out).first().probability) == 2


def test_missing_columns_and_unseen_values(spark, trained):
    _, run = trained
    df = spark.createDataFrame([(1, "plus", 5)], "Customer int, plan string, calls int")
    with pytest.raises(ValueError, match=r"lack columns.*\['active'\]"):
        score_rows(run.model, df)
    odd = spark.createDataFrame(
        [(1, "never seen", None, None), (2, None, 3, False)],
        "Customer int, plan string, calls int, active boolean",
    )
    assert score_rows(run.model, odd).filter("prediction IS NOT NULL").count() == 2


def test_scoring_is_a_narrow_plan(spark, trained):
    _, run = trained
    df = spark.range(10).select(
        F.col("id").alias("Customer"), F.lit("plus").alias("plan"), F.lit(1).alias("calls"), F.lit(True).alias("active")
    )
    assert "Exchange" not in plan(score_rows(run.model, df))


def test_saved_model_scores_alike(spark, trained):
    runs_path, run = trained
    model, _ = RunStore(spark, runs_path).load("leavers")
    df = spark.createDataFrame(
        [(i, c, n, True) for i, (c, n) in enumerate([("plus", 5), ("pro", 0), (" ", 8), (None, None)])],
        "Customer int, plan string, calls int, active boolean",
    )
    assert rows(model.transform(df), "Customer") == rows(run.model.transform(df), "Customer")


def test_grid_fits_features_once(spark, training_file, tmp_path):
    grid = {f"depth{d}": TrainParams(max_iter=2, max_depth=d) for d in (1, 3)}
    runs = train_grid(spark, training_file, "leaves", ["Customer"], grid, str(tmp_path), experiment="grid")
    store = RunStore(spark, str(tmp_path))
    assert {r.run_name for r in store.runs().collect()} == {"depth1", "depth3"}
    best = store.best_run("roc_auc", "grid")
    assert best.metrics["roc_auc"] == max(r.metrics["roc_auc"] for r in runs)
    shared = [[s.uid for s in r.model.stages[:-1]] for r in runs]
    assert shared[0] == shared[1]
    with pytest.raises(ValueError, match="share test_size and seed"):
        train_grid(spark, training_file, "leaves", [], {"a": TrainParams(), "b": TrainParams(seed=1)})


def test_same_seed_same_model(spark, training_file):
    prepared = prepare(spark, training_file, "leaves", ["Customer"])
    features = fit_prepared_features(prepared)
    first, second = (fit(prepared, SMALL, features).stages[-1].toDebugString for _ in range(2))
    assert first.split("\n", 1)[1] == second.split("\n", 1)[1]


def test_exact_medians_in_the_model(spark, training_file):
    prepared = prepare(spark, training_file, "leaves", ["Customer"])
    model = fit_prepared_features(prepared)
    (imputer,) = [s for s in model.stages if type(s).__name__ == "ImputerModel"]
    known = sorted(r.calls for r in prepared.part("train").collect() if r.calls is not None)
    assert imputer.surrogateDF.first().calls == known[(len(known) - 1) // 2]
    assert expected_columns(model) == (["plan"], ["active", "calls"])


def test_refused_inputs(spark, tmp_path):
    def data(schema, *values):
        return spark.createDataFrame(list(values), schema)

    with pytest.raises(ValueError, match="exactly two classes"):
        prepare(spark, data("y string, n int", ("a", 1), ("b", 2), ("c", 3)), "y")
    with pytest.raises(ValueError, match="generated names"):
        prepare(spark, data("y string, n int, class_weight double", ("a", 1, 1.0), ("b", 2, 1.0)), "y")
    with pytest.raises(ValueError, match=r"dots.*'n.1'"):
        prepare(spark, data("y string, `n.1` int", ("a", 1), ("b", 2)), "y")
    many = spark.range(300).select(
        (F.col("id") % 2).alias("y"), F.concat(F.lit("t"), F.col("id")).alias("text")
    )
    with pytest.raises(ValueError, match="More than 100 categories"):
        prepare(spark, many, "y", max_categories=100)
    with pytest.raises(ValueError, match="sample_size"):
        TrainParams(sample_size=0)
    with pytest.raises(ValueError, match="test_size"):
        TrainParams(test_size=1.0)


def test_a_label_of_very_many_values_is_refused_before_any_is_collected(spark, monkeypatch):
    raw = spark.range(50_000).select(F.concat(F.lit("l"), "id").alias("y"), (F.col("id") % 7).alias("n"))
    collected = []
    real = DataFrame.collect

    def counted(df):
        found = real(df)
        collected.append(len(found))
        return found

    monkeypatch.setattr(DataFrame, "collect", counted)
    with pytest.raises(ValueError, match="exactly two classes, 'y' has more than 2"):
        prepare(spark, raw, "y")
    assert max(collected, default=0) <= 2


def test_random_split_is_offered(spark, training_file):
    prepared = prepare(spark, training_file, "leaves", ["Customer"], split="random")
    assert prepared.part("train").count() + prepared.part("test").count() == 400


def test_duplicates_by_the_values_as_read(spark):
    """The order looks at columns that are no features, and at whole numbers beyond doubles."""
    big = 9007199254740992
    raw = spark.createDataFrame(
        [(1, "a", big + 1, None), (1, "a", big, 5), (2, "b", 1, 2), (3, "a", 1, 1)],
        "k int, y string, n long, at int",
    )
    prepared = prepare(spark, raw, "y", ["k"], numeric=["n"], order_by=["n"])
    assert prepared.rows.filter("k = 1").first().n == float(big)
    by_time = prepare(spark, raw, "y", ["k"], numeric=["n"], order_by=["at"])
    kept = by_time.rows.filter("k = 1")
    assert kept.columns == ["k", "y", "n", "split_part"] and kept.count() == 1


def test_a_source_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def touched(value):
        seen.add(1)
        return value

    raw = spark.range(200).select("id", touched(F.concat(F.lit("y"), F.col("id") % 2)).alias("y"), (F.col("id") % 7).alias("n"))
    for split in ("hash", "random"):
        before = seen.value
        prepared = prepare(spark, raw, "y", ["id"], split=split)
        assert prepared.rows.count() == 200 and seen.value - before == 200


def test_many_categories_are_a_warning(spark):
    many = spark.range(10_500).select(
        (F.col("id") % 2).alias("y"), F.concat(F.lit("t"), F.col("id")).alias("text")
    )
    prepared = prepare(spark, many, "y", test_size=0.001)
    with pytest.warns(UserWarning, match="very many categories"):
        features = fit_prepared_features(prepared)
    assert features.transform(prepared.part("test")).count() > 0


def test_unknown_formats_are_refused(spark, tmp_path):
    raw = spark.range(40).select((F.col("id") % 2).alias("y"), F.col("id").alias("n"))
    runs = str(tmp_path / "runs")
    train(spark, raw, "y", params=SMALL, runs_path=runs, register_as="m")
    RunStore(spark, runs).promote("m", 1)
    with pytest.raises(ValueError, match="Unknown format 'orc'"):
        score(spark, str(tmp_path), str(tmp_path / "out"), runs, "m", format="orc")


def test_best_of_a_grid_is_registered(spark, tmp_path):
    raw = spark.range(300).select((F.col("id") % 2).alias("y"), (F.col("id") % 10).alias("n"))
    runs = str(tmp_path / "grid")
    grid = {f"d{d}": TrainParams(max_iter=1, max_depth=d) for d in (1, 2, 4)}
    found = train_grid(
        spark, raw, "y", [], grid, runs, register_as="m", register_best="roc_auc", order_by=["n"]
    )
    store = RunStore(spark, runs)
    (version,) = store.versions("m").collect()
    best = max(run.metrics["roc_auc"] for run in found)
    assert store.run(version.run_id).metrics["roc_auc"] == best
    recorded = store.run(version.run_id).params
    assert recorded["order_by"] == "n" and recorded["split"] == "hash" and recorded["data_path"] == "DataFrame"
