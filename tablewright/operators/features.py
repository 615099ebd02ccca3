"""Fitted feature stages and the learner.

The stages that a model keeps are the built-in ones. What they learn is counted
here with grouped aggregates: the built-in fits bring the dictionaries and
quantile sketches of all tasks together in one task, which is the slowest step
once a table has hundreds of thousands of tasks.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import (
    Imputer,
    ImputerModel,
    OneHotEncoder,
    OneHotEncoderModel,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.columns import named, quoted
from tablewright.operators.category_index import CategoryIndex
from tablewright.operators.clean import cleaning_stage
from tablewright.operators.medians import exact_medians
from tablewright.operators.ranking import ranked
from tablewright.operators.validate import check_features
from tablewright.roles import (
    CLASS_WEIGHT,
    FEATURES,
    IMPUTED_SUFFIX,
    INDEX_SUFFIX,
    INDEXED_LABEL,
    ONE_HOT_SUFFIX,
    SLOT_SUFFIX,
    ColumnRoles,
)
from tablewright.sources.staging import drop_staged, stage

# From so many categories on a column's dictionary and one-hot slots are worth a warning:
# the learner holds about four bytes of memory for each slot of each row.
WIDE_CATEGORIES = 10_000

# Values of all columns together that a fit brings to the driver at most.
MOST_COLLECTED = 100_000

SKETCH_GROUPS = 512


def distinct_estimates(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Approximate numbers of distinct texts, all columns in one scan.

    The sketches of the tasks are merged group by group first, so that no task
    has to take in the sketches of all others.
    """
    sketches = [f"s{i}" for i in range(len(columns))]
    merged = (
        df.select(
            (F.spark_partition_id() % SKETCH_GROUPS).alias("sketch_group"),
            *[named(c).cast("string").alias(s) for c, s in zip(columns, sketches)],
        )
        .groupBy("sketch_group")
        .agg(*[F.hll_sketch_agg(s).alias(s) for s in sketches])
        .agg(*[F.hll_sketch_estimate(F.hll_union_agg(s)).alias(s) for s in sketches])
    )
    return dict(zip(columns, merged.first()))


def check_categories(df: DataFrame, roles: ColumnRoles, max_categories: int | None) -> None:
    """Refuse columns with more categories than the caller allows, if there is a limit.

    The dictionaries of the fitted index live on the driver and in every task,
    so their size is estimated before they are collected.
    """
    if max_categories is None or not roles.categorical:
        return
    estimates = distinct_estimates(df, roles.categorical)
    too_wide = {c: n for c, n in estimates.items() if n > max_categories}
    if too_wide:
        raise ValueError(
            f"More than {max_categories} categories in {too_wide}; declare the column as id, "
            "leave it out, or raise max_categories."
        )


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of each value of each column, counted in one scan and one shuffle."""
    cells = [
        F.struct(F.lit(i).alias("position"), named(c).cast("string").alias("value"))
        for i, c in enumerate(columns)
    ]
    present = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    return present.groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"))


def index_models(
    df: DataFrame,
    columns: Sequence[str],
    most_collected: int = MOST_COLLECTED,
    wide: int = WIDE_CATEGORIES,
) -> list[StringIndexerModel | CategoryIndex]:
    """Index of each column's values by falling frequency, equal ones by text.

    Unseen and null values get the index after the last one. Up to ``most_collected`` values of
    all columns together become built-in stages, which hold them on the driver. Where there are
    more, the counts are ranked as a table, and columns of more than ``wide`` values
    are indexed by a join with it; the indexes are the same.
    """
    counts = category_counts(df, columns)
    few = counts.limit(most_collected + 1).collect()
    if len(few) <= most_collected:
        dictionaries = [[] for _ in columns]
        for row in sorted(few, key=lambda r: (r.position, -r.n, r.value)):
            dictionaries[row.position].append(row.value)
        models = [built_in_index(c, values) for c, values in zip(columns, dictionaries)]
        warn_of_wide(dict(zip(columns, map(len, dictionaries))))
        return models
    return table_index(df.sparkSession, counts, columns, wide)


def built_in_index(column: str, values: list[str]) -> StringIndexerModel:
    return StringIndexerModel.from_labels(
        values, inputCol=column, outputCol=column + INDEX_SUFFIX, handleInvalid="keep"
    )


def table_index(
    spark: SparkSession, counts: DataFrame, columns: Sequence[str], bound: int
) -> list[StringIndexerModel | CategoryIndex]:
    """One join stage for the wide columns, built-in ones for the others."""
    placed, path = ranked(counts, [F.desc("n"), F.asc("value")], per="position")
    sizes = dict.fromkeys(range(len(columns)), 0)
    sizes |= {r.position: r.n for r in placed.groupBy("position").agg(F.count(F.lit(1)).alias("n")).collect()}
    wide = [i for i, n in sizes.items() if n > bound]
    narrow = {i: [] for i in sizes if i not in wide}
    rows = placed.where(F.col("position").isin(list(narrow))) if narrow else placed.limit(0)
    for row in sorted(rows.select("position", "value", "place").collect(), key=lambda r: r.place):
        narrow[row.position].append(row.value)
    own = F.array_position(F.array(*map(F.lit, wide)), F.col("position")) - 1
    dictionary = placed.where(F.col("position").isin(wide)).select(
        own.cast("int").alias("position"), "value", F.col("place").cast("double").alias("idx")
    )
    kept = stage(dictionary, "dictionary")
    drop_staged(spark, path)
    warn_of_wide({columns[i]: n for i, n in sizes.items()})
    names = [columns[i] for i in wide]
    joined = CategoryIndex(names, [c + INDEX_SUFFIX for c in names], [sizes[i] for i in wide], kept)
    return [*[built_in_index(columns[i], values) for i, values in narrow.items()], joined]


def warn_of_wide(sizes: dict[str, int]) -> None:
    if wide := {c: n for c, n in sizes.items() if n > WIDE_CATEGORIES}:
        warnings.warn(f"Columns with very many categories, each a slot of every row unless max_slots is set: {wide}")


def index_sizes(indexers: Sequence[StringIndexerModel | CategoryIndex]) -> dict[str, int]:
    """The number of known values of each indexed column."""
    sizes = {}
    for indexer in indexers:
        if isinstance(indexer, CategoryIndex):
            sizes |= dict(zip(indexer.getInputCols(), indexer.sizes))
        else:
            sizes[indexer.getInputCol()] = len(indexer.labels)
    return sizes


def slot_stage(sizes: dict[str, int], max_slots: int) -> SQLTransformer:
    """Where a column has more values, those after the ``max_slots`` most frequent share one slot.

    Unseen and null values keep a slot of their own, the last one.
    """
    slots = []
    for c, n in sizes.items():
        index = quoted(c + INDEX_SUFFIX)
        slot = f"CASE WHEN {index} >= {n} THEN {max_slots + 1}D ELSE least({index}, {max_slots}D) END"
        slots.append(f"{slot if n > max_slots else index} AS {quoted(c + SLOT_SUFFIX)}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(slots)} FROM __THIS__")


def one_hot_stage(categorical: Sequence[str], suffix: str = INDEX_SUFFIX) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[c + suffix for c in categorical],
        outputCols=[c + ONE_HOT_SUFFIX for c in categorical],
        handleInvalid="keep",
    )


def one_hot_model(
    spark: SparkSession, sizes: dict[str, int], max_slots: int | None
) -> list[SQLTransformer | OneHotEncoderModel]:
    """The fitted encoder for known numbers of values: that of a table of one row."""
    suffix = INDEX_SUFFIX
    stages = []
    last = dict(sizes)
    if max_slots is not None:
        suffix = SLOT_SUFFIX
        stages.append(slot_stage(sizes, max_slots))
        last = {c: n if n <= max_slots else max_slots + 1 for c, n in sizes.items()}
    values = spark.range(0, 1, 1, 1).select(*[F.lit(float(n)).alias(c + suffix) for c, n in last.items()])
    return [*stages, one_hot_stage(tuple(sizes), suffix).fit(values)]


def impute_stage(numeric: Sequence[str], rank_error: float) -> Imputer:
    return Imputer(
        strategy="median",
        inputCols=list(numeric),
        outputCols=[c + IMPUTED_SUFFIX for c in numeric],
        relativeError=rank_error,
    )


def impute_model(spark: SparkSession, medians: dict[str, float]) -> ImputerModel:
    """The fitted stage for medians that are known: those of a table of one row."""
    values = spark.range(0, 1, 1, 1).select(
        *[F.lit(m).cast("double").alias(c) for c, m in medians.items()]
    )
    return impute_stage(tuple(medians), rank_error=0.0).fit(values)


def fit_features(
    rows: DataFrame, roles: ColumnRoles, rank_error: float = 0.0, max_slots: int | None = None
) -> PipelineModel:
    """Clean, index, one-hot, impute and assemble: one-hot columns come first.

    Medians are exact; a ``rank_error`` leaves them to the built-in approximation. ``max_slots``
    gives only a column's most frequent values a one-hot slot each, the others one together:
    the learner keeps four bytes for every slot of every row.
    """
    check_features(roles)
    cleaning = cleaning_stage(roles)
    cleaned = cleaning.transform(rows)
    stages = [cleaning]
    inputs = []
    if roles.categorical:
        indexers = index_models(cleaned, roles.categorical)
        sizes = index_sizes(indexers)
        encoding = one_hot_model(rows.sparkSession, {c: sizes[c] for c in roles.categorical}, max_slots)
        stages += [*indexers, *encoding]
        inputs += encoding[-1].getOutputCols()
    if roles.numeric:
        if rank_error:
            imputer = impute_stage(roles.numeric, rank_error).fit(cleaned)
        else:
            imputer = impute_model(rows.sparkSession, exact_medians(cleaned, roles.numeric))
        stages.append(imputer)
        inputs += imputer.getOutputCols()
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
    return PipelineModel(stages)


def learner(
    max_iter: int = 60,
    max_depth: int = 5,
    max_bins: int = 64,
    step_size: float = 0.1,
    subsampling_rate: float = 0.8,
    min_info_gain: float = 0.0,
    seed: int = 42,
    weighted: bool = False,
) -> GBTClassifier:
    trees = GBTClassifier(
        labelCol=INDEXED_LABEL,
        featuresCol=FEATURES,
        maxIter=max_iter,
        maxDepth=max_depth,
        maxBins=max_bins,
        stepSize=step_size,
        subsamplingRate=subsampling_rate,
        minInfoGain=min_info_gain,
        seed=seed,
    )
    return trees.setWeightCol(CLASS_WEIGHT) if weighted else trees


def expected_columns(model: PipelineModel) -> tuple[list[str], list[str]]:
    """Input columns a fitted model needs: categorical and numeric, sorted."""
    categorical: set[str] = set()
    numeric: set[str] = set()
    for stage in model.stages:
        if isinstance(stage, (StringIndexerModel, CategoryIndex)):
            categorical |= set(input_names(stage))
        elif isinstance(stage, ImputerModel):
            numeric |= set(input_names(stage))
    return sorted(categorical), sorted(numeric)


def input_names(stage: StringIndexerModel | CategoryIndex | ImputerModel) -> list[str]:
    return stage.getInputCols() if stage.isSet("inputCols") else [stage.getInputCol()]
