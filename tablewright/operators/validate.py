"""Checks before training and scoring, answered by one aggregate."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import named
from tablewright.operators.label import TWO_CLASSES
from tablewright.roles import ColumnRoles, detect_roles


def profile(df: DataFrame, label: str) -> DataFrame:
    """One row: rows, null labels, blank labels, distinct labels."""
    return df.agg(*label_counts(label), F.count_distinct(named(label)).alias("n_classes"))


def column_profile(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """One row per feature: its role, null count and count of blank texts."""
    described = []
    aggregates = []
    for position, name in enumerate(roles.features):
        value = named(name)
        if name in roles.categorical:
            kind, blank = "categorical", F.trim(value.cast("string")) == ""
        else:
            kind, blank = "numeric", F.lit(False)
        aggregates += [
            F.count_if(value.isNull()).alias(f"nulls{position}"),
            F.count_if(blank).alias(f"blanks{position}"),
        ]
        described.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("role"),
                F.col("n_rows"),
                F.col(f"nulls{position}").alias("n_null"),
                F.col(f"blanks{position}").alias("n_blank"),
            )
        )
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggregates)
    return counted.select(F.inline(F.array(*described)))


def label_counts(label: str) -> list[Column]:
    """Rows, null labels and blank labels, as an observation can count them."""
    value = named(label)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(value.isNull()).alias("n_null_labels"),
        F.count_if(F.trim(value.cast("string")) == "").alias("n_blank_labels"),
    ]


def check_columns(columns: Sequence[str], label: str) -> None:
    if not label or label not in columns:
        raise ValueError(f"No label column '{label}' among {list(columns)}")


def check_label_counts(found: dict[str, int], label: str) -> None:
    if found["n_rows"] == 0:
        raise ValueError("The table has no rows.")
    if found["n_null_labels"] > 0:
        raise ValueError(f"{found['n_null_labels']} rows have no value in label column '{label}'.")
    if found["n_blank_labels"]:
        warnings.warn(f"{found['n_blank_labels']} rows have a blank label, which counts as a class.")


def check_classes(n_classes: int, label: str, learner: bool = False, more: bool = False) -> None:
    """``more`` says that there are classes beyond those counted."""
    if n_classes < TWO_CLASSES and not more:
        raise ValueError(f"'{label}' has {n_classes} class, two or more are needed.")
    if learner and (more or n_classes != TWO_CLASSES):
        found = f"more than {n_classes}" if more else n_classes
        raise ValueError(f"The learner takes exactly two classes, '{label}' has {found}.")


def check_features(roles: ColumnRoles) -> None:
    if not roles.features:
        raise ValueError("Besides label and ids no column is left as a feature.")


def validate(df: DataFrame, label: str, ids: Sequence[str] = (), learner: bool = False) -> ColumnRoles:
    """Run all checks in order, stop at the first failure, return the roles."""
    check_columns(df.columns, label)
    found = profile(df, label).first().asDict()
    check_label_counts(found, label)
    check_classes(found["n_classes"], label)
    roles = detect_roles(df.schema, label, ids)
    check_features(roles)
    check_classes(found["n_classes"], label, learner)
    return roles


def check_required(columns: Sequence[str], required: Sequence[str]) -> None:
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"The rows to score lack columns of the model: {missing}")
