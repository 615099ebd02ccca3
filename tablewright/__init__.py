"""Two-class prediction on large tables, written as Spark jobs."""

from tablewright.plans.score import score, score_rows
from tablewright.plans.train import TrainParams, fit, prepare, train, train_grid
from tablewright.roles import ColumnRoles, clean_name, detect_roles
from tablewright.sources.runs import RunStore
from tablewright.sources.tables import open_table

__all__ = [
    "ColumnRoles",
    "RunStore",
    "TrainParams",
    "clean_name",
    "detect_roles",
    "fit",
    "open_table",
    "prepare",
    "score",
    "score_rows",
    "train",
    "train_grid",
]
