"""Batch scoring with a fitted or registered model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString
from pyspark.sql import DataFrame, Row, SparkSession

from tablewright.operators.features import expected_columns
from tablewright.operators.header import clean_header
from tablewright.operators.validate import check_required
from tablewright.roles import (
    PREDICTED_LABEL,
    PREDICTION,
    ColumnRoles,
    clean_name,
    clean_names,
    output_columns,
)
from tablewright.sources.runs import PRODUCTION, RunStore, run_roles, run_schema
from tablewright.sources.sinks import file_rows, write_table
from tablewright.sources.tables import MALFORMED_COUNT, conform, open_text_table


def score_rows(
    model: PipelineModel,
    df: DataFrame,
    run: Row | None = None,
    label_text: bool = False,
) -> DataFrame:
    """All rows with prediction and probability: projections only, no shuffle.

    ``run`` gives the types of training back to columns that were read as text.
    With ``label_text`` the predicted class number is also written as its label.
    """
    categorical, numeric = expected_columns(model)
    check_required(df.columns, [*categorical, *numeric])
    if run is not None:
        df = conform(df, run_schema(run), run_roles(run))
    scored = model.transform(df)
    if label_text:
        to_text = IndexToString(
            inputCol=PREDICTION, outputCol=PREDICTED_LABEL, labels=list(run.label_values)
        )
        scored = to_text.transform(scored)
    return scored


def score_output(
    scored: DataFrame,
    ids: Sequence[str],
    label: str | None,
    input_columns: Sequence[str] | None,
    format: str,
) -> DataFrame:
    return file_rows(scored, output_columns(scored.columns, ids, label, input_columns), format)


@dataclass(frozen=True)
class Scored:
    path: str
    malformed: int


def score(
    spark: SparkSession,
    source: str | DataFrame,
    output_path: str,
    runs_path: str,
    model_name: str,
    stage: str = PRODUCTION,
    ids: Sequence[str] | None = None,
    label: str | None = None,
    keep_input: bool = False,
    label_text: bool = False,
    format: str = "csv",
    output_format: str = "csv",
    on_malformed: str = "drop",
) -> Scored:
    """Score a file with a registered model in one pass and write the result."""
    model, run = RunStore(spark, runs_path).load(model_name, stage)
    roles: ColumnRoles = run_roles(run)
    seen = None
    if isinstance(source, DataFrame):
        rows = source
    elif format == "parquet":
        rows = spark.read.parquet(source)
    elif format == "csv":
        rows, seen = open_text_table(spark, source, on_malformed)
    else:
        raise ValueError(f"Unknown format '{format}', use csv or parquet.")
    rows = clean_header(rows)
    scored = score_rows(model, rows, run, label_text)
    result = score_output(
        scored,
        roles.ids if ids is None else clean_names(ids),
        roles.label if label is None else clean_name(label),
        rows.columns if keep_input else None,
        output_format,
    )
    write_table(result, output_path, output_format)
    return Scored(output_path, seen.get[MALFORMED_COUNT] if seen else 0)
