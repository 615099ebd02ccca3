"""Writing scored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import named, probability_text
from tablewright.roles import PREDICTION, PROBABILITY


def file_column(field: T.StructField, format: str) -> Column:
    """A column as the file format can hold it."""
    value = named(field.name)
    if isinstance(field.dataType, VectorUDT):
        value = probability_text(value) if format == "csv" else vector_to_array(value)
    elif format == "csv" and isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        value = F.to_json(value)
    return value.alias(field.name)


def file_rows(df: DataFrame, columns: Sequence[str], format: str = "csv") -> DataFrame:
    """The chosen columns; vectors become comma-joined text (CSV) or arrays."""
    fields = {f.name: f for f in df.schema.fields}
    return df.select(*[file_column(fields[c], format) for c in columns])


def write_table(df: DataFrame, path: str, format: str = "csv") -> None:
    """Overwrite a folder; executors write their own files."""
    writer = df.write.mode("overwrite")
    if format == "csv":
        writer.option("header", True).csv(path)
    elif format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"Unknown format '{format}', use csv or parquet.")


def prediction_sample(
    predictions: DataFrame, ids: Sequence[str], label: str, size: int
) -> DataFrame:
    """The first rows by id with label, prediction and probability text."""
    check_sample_size(size)
    keys = [c for c in ids if c in predictions.columns]
    kept = [*keys, label, PREDICTION, PROBABILITY]
    rows = file_rows(predictions, kept)
    return rows.orderBy(*map(named, keys or kept)).limit(size)


def check_sample_size(size: int) -> None:
    if size <= 0:
        raise ValueError("sample_size has to be positive.")
