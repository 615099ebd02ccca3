"""Training: from a raw table to a recorded run with its model."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import named
from tablewright.operators.clean import clean_values, drop_duplicates, drop_null_label
from tablewright.operators.features import check_categories, fit_features, learner
from tablewright.operators.header import clean_header
from tablewright.operators.label import (
    LabelDictionary,
    add_class_weight,
    in_order,
    index_label,
    label_range,
    two_labels,
)
from tablewright.operators.metrics import ROC_BINS, evaluate
from tablewright.operators.split import TEST, TRAIN, check_test_size, hash_split, random_split
from tablewright.operators.validate import (
    check_classes,
    check_columns,
    check_features,
    check_label_counts,
    label_counts,
    validate,
)
from tablewright.roles import (
    INDEXED_LABEL,
    PREDICTION,
    PROBABILITY,
    RAW_PREDICTION,
    SPLIT_PART,
    ColumnRoles,
    check_feature_names,
    check_reserved,
    clean_name,
    clean_names,
    detect_roles,
    restrict_roles,
)
from tablewright.sources.runs import RunStore
from tablewright.sources.sinks import check_sample_size, prediction_sample, write_table
from tablewright.sources.staging import drop_staged, stage
from tablewright.sources.tables import open_table


@dataclass(frozen=True)
class TrainParams:
    test_size: float = 0.2
    seed: int = 42
    max_iter: int = 60
    max_depth: int = 5
    max_bins: int = 64
    step_size: float = 0.1
    subsampling_rate: float = 0.8
    min_info_gain: float = 0.0
    use_class_weights: bool = False
    sample_size: int = 200

    def __post_init__(self) -> None:
        check_test_size(self.test_size)
        check_sample_size(self.sample_size)

    def learner(self):
        return learner(
            max_iter=self.max_iter,
            max_depth=self.max_depth,
            max_bins=self.max_bins,
            step_size=self.step_size,
            subsampling_rate=self.subsampling_rate,
            min_info_gain=self.min_info_gain,
            seed=self.seed,
            weighted=self.use_class_weights,
        )


@dataclass(frozen=True)
class Prepared:
    """Cleaned rows, staged once and stored apart by split part."""

    rows: DataFrame
    staged: str
    roles: ColumnRoles
    dictionary: LabelDictionary
    training_schema: T.StructType
    malformed: int
    split_seed: int
    test_size: float

    def part(self, part: str) -> DataFrame:
        """Rows of one part with class number and weight; reads only its files."""
        kept = self.rows.filter(F.col(SPLIT_PART) == part).drop(SPLIT_PART)
        indexed = index_label(kept, self.roles.label, self.dictionary)
        return add_class_weight(indexed, self.dictionary.weights())

    def drop(self) -> None:
        drop_staged(self.rows.sparkSession, self.staged)


def prepared_rows(
    df: DataFrame,
    roles: ColumnRoles,
    test_size: float,
    seed: int,
    order_by: Sequence[str] = (),
    null_ids: str = "collapse",
    split: str = "hash",
) -> DataFrame:
    """Drop unlabelled and duplicate rows, clean, mark the part of a split by hash.

    One shuffle at most, and that only when id columns are present.
    """
    ids = [c for c in roles.ids if c in df.columns]
    columns = [*ids, roles.label, *roles.features]
    # Duplicates go by the values as they were read, before cleaning makes some of them equal.
    used = list(dict.fromkeys([*columns, *order_by]))
    labelled = drop_null_label(df.select(*map(named, used)), roles.label)
    distinct = drop_duplicates(labelled, ids, roles.label, order_by, null_ids=null_ids)
    cleaned = clean_values(distinct.select(*map(named, columns)), roles.categorical, roles.numeric)
    return hash_split(cleaned, ids, test_size, seed) if split == "hash" else cleaned


def randomly_marked(df: DataFrame, test_size: float, seed: int) -> DataFrame:
    train, test = random_split(df, test_size, seed)
    return train.withColumn(SPLIT_PART, F.lit(TRAIN)).unionByName(
        test.withColumn(SPLIT_PART, F.lit(TEST))
    )


def prepare(
    spark: SparkSession,
    source: str | DataFrame,
    label: str,
    ids: Sequence[str] = (),
    format: str = "csv",
    schema: T.StructType | None = None,
    categorical: Iterable[str] | None = None,
    numeric: Iterable[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    positive_label: str | None = None,
    order_by: Sequence[str] = (),
    null_ids: str = "collapse",
    split: str = "hash",
    max_categories: int | None = None,
    on_malformed: str = "drop",
) -> Prepared:
    """Read, check, clean, split and stage; many models can be fitted on the result."""
    check_test_size(test_size)
    table = open_table(spark, source, format, schema, on_malformed)
    try:
        df = clean_header(table.rows)
        label = clean_name(label)
        check_columns(df.columns, label)
        roles = detect_roles(df.schema, label, clean_names(ids))
        # Without any column left the guards on rows come first.
        if not roles.features:
            validate(df, label, clean_names(ids), learner=True)
        roles = restrict_roles(df.columns, roles, categorical, numeric)
        check_features(roles)
        check_feature_names(roles)
        check_reserved(df.columns, roles)
        # The guards see the rows that are staged, on their way: the source is read once.
        seen = Observation()
        observed = df.observe(seen, *label_counts(label), *label_range(label))
        rows = prepared_rows(
            observed, roles, test_size, seed, clean_names(order_by), null_ids, split
        )
        if split == "hash":
            staged = stage(rows, "prepared", partition_by=[SPLIT_PART])
        else:
            whole = stage(rows, "prepared")
            marked = randomly_marked(spark.read.parquet(whole), test_size, seed)
            staged = stage(marked, "prepared", partition_by=[SPLIT_PART])
            drop_staged(spark, whole)
        malformed = table.malformed
    finally:
        table.drop()
    try:
        found = seen.get
        check_label_counts(found, label)
        rows = spark.read.parquet(staged)
        # Before any label is brought over: a third value is seen as rows with neither of two.
        least, greatest = found["least_label"], found["greatest_label"]
        dictionary, others = two_labels(rows, label, least, greatest)
        check_classes(len(dictionary.values), label, learner=True, more=others > 0)
        dictionary = in_order(list(zip(dictionary.values, dictionary.counts)), label, positive_label)
        check_categories(rows, roles, max_categories)
    except Exception:
        drop_staged(spark, staged)
        raise
    return Prepared(
        rows=rows,
        staged=staged,
        roles=roles,
        dictionary=dictionary,
        training_schema=df.schema,
        malformed=malformed,
        split_seed=seed,
        test_size=test_size,
    )


@dataclass(frozen=True)
class Run:
    run_id: str | None
    model: PipelineModel
    metrics: dict[str, float]


def fit_prepared_features(
    prepared: Prepared, rank_error: float = 0.0, max_slots: int | None = None
) -> PipelineModel:
    return fit_features(prepared.part(TRAIN), prepared.roles, rank_error, max_slots)


def fit(
    prepared: Prepared, params: TrainParams = TrainParams(), features: PipelineModel | None = None
) -> PipelineModel:
    """Feature stages and trees as one model, fitted on the training part."""
    features = features or fit_prepared_features(prepared)
    trees = params.learner().fit(features.transform(prepared.part(TRAIN)))
    return PipelineModel([*features.stages, trees])


def train(
    spark: SparkSession,
    source: str | DataFrame,
    label: str,
    ids: Sequence[str] = (),
    params: TrainParams = TrainParams(),
    runs_path: str | None = None,
    experiment: str = "default",
    run_name: str | None = None,
    register_as: str | None = None,
    rank_error: float = 0.0,
    bins: int = ROC_BINS,
    max_slots: int | None = None,
    **reading,
) -> Run:
    """Prepare, fit, measure and record one run; ``reading`` goes to ``prepare``."""
    grid = {run_name: params}
    (run,) = train_grid(
        spark, source, label, ids, grid, runs_path, experiment, register_as, rank_error, bins,
        max_slots=max_slots, **reading
    )
    return run


def train_grid(
    spark: SparkSession,
    source: str | DataFrame,
    label: str,
    ids: Sequence[str],
    grid: dict[str | None, TrainParams],
    runs_path: str | None = None,
    experiment: str = "default",
    register_as: str | None = None,
    rank_error: float = 0.0,
    bins: int = ROC_BINS,
    register_best: str | None = None,
    max_slots: int | None = None,
    **reading,
) -> list[Run]:
    """Fit one model per parameter set on the same preparation and features.

    ``register_as`` registers every run, or only the best one by the metric
    ``register_best`` (equal ones: the first of the grid).
    """
    splits = {(p.test_size, p.seed) for p in grid.values()}
    if len(splits) != 1:
        raise ValueError("All parameter sets of a grid share test_size and seed.")
    ((test_size, seed),) = splits
    prepared = prepare(spark, source, label, ids, test_size=test_size, seed=seed, **reading)
    try:
        features = fit_prepared_features(prepared, rank_error, max_slots)
        data_path = source if isinstance(source, str) else "DataFrame"
        each = None if register_best else register_as
        options = {"rank_error": rank_error, "bins": bins, "max_slots": max_slots, **reading}
        runs = [
            measured_run(prepared, features, params, runs_path, experiment, name, each, bins, data_path, options)
            for name, params in grid.items()
        ]
    finally:
        prepared.drop()
    if register_best and register_as and runs_path is not None:
        best = max(runs, key=lambda run: run.metrics[register_best])
        RunStore(spark, runs_path).register(register_as, best.run_id)
    return runs


def measured_run(
    prepared: Prepared,
    features: PipelineModel,
    params: TrainParams,
    runs_path: str | None,
    experiment: str,
    run_name: str | None,
    register_as: str | None,
    bins: int,
    data_path: str,
    options: dict[str, object],
) -> Run:
    model = fit(prepared, params, features)
    roles = prepared.roles
    ids = [c for c in roles.ids if c in prepared.rows.columns]
    kept = dict.fromkeys([*ids, roles.label, INDEXED_LABEL, RAW_PREDICTION, PROBABILITY, PREDICTION])
    predictions = model.transform(prepared.part(TEST)).select(*map(named, kept))
    predictions.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        metrics = evaluate(predictions, bins)
        if runs_path is None:
            return Run(None, model, metrics)
        store = RunStore(prepared.rows.sparkSession, runs_path)
        run_id = uuid4().hex
        write_table(
            prediction_sample(predictions, ids, roles.label, params.sample_size),
            store.sample_path(run_id),
        )
    finally:
        predictions.unpersist()
    weights = prepared.dictionary.as_text_weights() if params.use_class_weights else None
    store.log_run(
        experiment,
        run_name,
        params=run_params(prepared, params, data_path, options),
        tags={"dataset": experiment, "model": "GBTClassifier", "framework": "pyspark"},
        metrics=metrics,
        label_values=prepared.dictionary.values,
        class_weights=weights,
        roles=roles,
        training_schema=prepared.training_schema,
        model=model,
        run_id=run_id,
    )
    if register_as:
        store.register(register_as, run_id)
    return Run(run_id, model, metrics)


# How a source is read unless a training says otherwise; runs record all of it.
READING = {
    "format": "csv",
    "schema": None,
    "categorical": None,
    "numeric": None,
    "positive_label": None,
    "order_by": (),
    "null_ids": "collapse",
    "split": "hash",
    "max_categories": None,
    "on_malformed": "drop",
}


def option_text(value: object) -> str:
    if isinstance(value, T.StructType):
        return value.simpleString()
    if isinstance(value, str) or not isinstance(value, Iterable):
        return str(value)
    return ",".join(map(str, value))


def run_params(
    prepared: Prepared, params: TrainParams, data_path: str, options: dict[str, object]
) -> dict[str, object]:
    spark = prepared.rows.sparkSession
    return {
        "data_path": data_path,
        **{name: option_text(value) for name, value in (READING | options).items()},
        "label_column": prepared.roles.label,
        "id_columns": ",".join(prepared.roles.ids),
        **asdict(params),
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "categorical_cols_count": len(prepared.roles.categorical),
        "numeric_cols_count": len(prepared.roles.numeric),
        "malformed_rows": prepared.malformed,
    }
