from concurrent.futures import ThreadPoolExecutor

import pytest

from tablewright.operators.features import fit_features
from tablewright.roles import ColumnRoles
from tablewright.sources.runs import NO_STAGE, RunStore, run_roles, run_schema
from tablewright.sources.staging import create_once
from tests.support import rows

ROLES = ColumnRoles("y", ("id",), ("c",), ("n",))


@pytest.fixture
def store(spark, tmp_path):
    return RunStore(spark, str(tmp_path / "store"))


def test_empty_store(store):
    assert store.runs().count() == 0 and store.registry().count() == 0
    with pytest.raises(ValueError, match="no version in stage"):
        store.find("m")
    with pytest.raises(ValueError, match="No run with metric"):
        store.best_run("roc_auc")


def test_run_record(spark, store):
    schema = spark.createDataFrame([], "id int, c string, n double, y string").schema
    run_id = store.log_run(
        "exp",
        "first",
        params={"max_iter": 5, "use_class_weights": True},
        tags={"model": "trees"},
        metrics={"f1": 0.5},
        label_values=("no", "yes"),
        class_weights={"0.0": 0.7, "1.0": 1.75},
        roles=ROLES,
        training_schema=schema,
    )
    found = store.run(run_id)
    assert found.params == {"max_iter": "5", "use_class_weights": "True"}
    assert found.metrics == {"f1": 0.5} and found.tags == {"model": "trees"}
    assert found.label_values == ["no", "yes"] and found.class_weights == {"0.0": 0.7, "1.0": 1.75}
    assert run_roles(found) == ROLES and run_schema(found) == schema
    assert found.model_path is None


def test_best_run(store):
    for name, value in (("b", 0.8), ("a", 0.8), ("c", 0.7), ("d", None)):
        store.log_run("exp", name, metrics={} if value is None else {"roc_auc": value})
    store.log_run("other", "z", metrics={"roc_auc": 0.9})
    assert store.best_run("roc_auc", "exp").run_name == "a"
    assert store.best_run("roc_auc").run_name == "z"


def test_versions_and_stages(store):
    first, second = store.log_run("exp", "one"), store.log_run("exp", "two")
    assert store.register("m", first) == 1 and store.register("m", second) == 2
    assert rows(store.versions("m"), "version") == [(1, NO_STAGE, first), (2, NO_STAGE, second)]
    store.promote("m", 1)
    assert store.find("m").run_id == first
    store.promote("m", 2)
    assert store.find("m").run_id == second
    store.promote("m", 2, "Archived")
    assert store.find("m").run_id == first
    assert store.find("m", "Archived").run_id == second
    with pytest.raises(ValueError, match="no version 9"):
        store.promote("m", 9)


def test_model_survives_saving(spark, store):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (2, " ", None), (3, "b", 4.0)], "id int, c string, n double"
    )
    model = fit_features(df, ROLES)
    run_id = store.log_run("exp", model=model, roles=ROLES, training_schema=df.schema)
    store.register("m", run_id)
    store.promote("m", 1)
    loaded, run = store.load("m")
    assert run.run_id == run_id
    assert rows(loaded.transform(df), "id") == rows(model.transform(df), "id")


def test_a_version_taken_meanwhile_is_left_to_its_owner(store):
    """Another training registers between the look at the versions and the own claim."""
    first, second = store.log_run("e", "x"), store.log_run("e", "y")
    look = store.registry

    def racing():
        store.registry = look
        seen = store.spark.createDataFrame(look().collect(), look().schema)
        store.register("raced", first)
        return seen

    store.registry = racing
    assert store.register("raced", second) == 2
    assert rows(store.versions("raced"), "version") == [(1, NO_STAGE, first), (2, NO_STAGE, second)]


def test_claims_of_many_writers(store):
    """Writers that all want version 1: each gets one of its own."""
    runs = [store.log_run("e", f"r{i}") for i in range(8)]
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda run: store.register("a/b c", run), runs))
    assert sorted(versions) == list(range(1, 9))
    held = {(r.version, r.run_id) for r in store.versions("a/b c").collect()}
    assert held == set(zip(versions, runs))


def test_a_file_is_created_once(spark, tmp_path):
    for path in (f"{tmp_path}/x/claim", f"file://{tmp_path}/y/claim"):
        assert create_once(spark, path, "one")
        assert not create_once(spark, path, "two")
    assert (tmp_path / "x/claim").read_text() == (tmp_path / "y/claim").read_text() == "one"
