"""Which column plays which part: label, ids, categorical and numeric features."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

# The generated column names, which are the public contract of a
# scored table, the name of the folder column of the prepared table, and the mark
# that some editors put before the first header name.
INDEXED_LABEL = "label"
CLASS_WEIGHT = "class_weight"
FEATURES = "features"
RAW_PREDICTION = "rawPrediction"
PROBABILITY = "probability"
PREDICTION = "prediction"
PREDICTED_LABEL = "predicted_label"
SPLIT_PART = "split_part"
INDEX_SUFFIX = "_idx"
SLOT_SUFFIX = "_slot"
ONE_HOT_SUFFIX = "_ohe"
IMPUTED_SUFFIX = "_imputed"

BYTE_ORDER_MARK = "\ufeff"

RESERVED_NAMES = (
    INDEXED_LABEL,
    CLASS_WEIGHT,
    FEATURES,
    RAW_PREDICTION,
    PROBABILITY,
    PREDICTION,
    PREDICTED_LABEL,
    SPLIT_PART,
)


@dataclass(frozen=True)
class ColumnRoles:
    label: str
    ids: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.numeric


def clean_name(name: object) -> str:
    """Remove byte order marks and the white space around a column name."""
    if name is None:
        return ""
    return str(name).replace(BYTE_ORDER_MARK, "").strip()


def clean_names(names: Iterable[object] | None) -> list[str]:
    """Cleaned names in their order; empty and repeated ones are left out."""
    return [name for name in dict.fromkeys(map(clean_name, names or ())) if name]


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.BooleanType))


def detect_roles(schema: T.StructType, label: str, ids: Sequence[str] = ()) -> ColumnRoles:
    """Numbers and booleans are numeric features, all other types categorical ones."""
    fields = [f for f in schema.fields if f.name != label and f.name not in ids]
    return ColumnRoles(
        label=label,
        ids=tuple(ids),
        categorical=tuple(f.name for f in fields if not is_numeric(f.dataType)),
        numeric=tuple(f.name for f in fields if is_numeric(f.dataType)),
    )


def restrict_roles(
    columns: Sequence[str],
    roles: ColumnRoles,
    categorical: Iterable[object] | None = None,
    numeric: Iterable[object] | None = None,
) -> ColumnRoles:
    """Keep the wanted features that exist and are not label, id or generated."""
    label = clean_name(roles.label)
    ids = clean_names(roles.ids)
    taken = {label, INDEXED_LABEL, FEATURES, *ids}

    def usable(wanted: Iterable[object]) -> tuple[str, ...]:
        return tuple(n for n in clean_names(wanted) if n in columns and n not in taken)

    return ColumnRoles(
        label=label,
        ids=tuple(ids),
        categorical=usable(roles.categorical if categorical is None else categorical),
        numeric=usable(roles.numeric if numeric is None else numeric),
    )


def check_feature_names(roles: ColumnRoles) -> None:
    """Fitted stages look columns up by plain name and would read ``a.b`` as a field."""
    odd = [c for c in roles.features if "." in c or "`" in c]
    if odd:
        raise ValueError(f"Feature names must not hold dots or back-ticks, rename them: {odd}")


def check_reserved(columns: Sequence[str], roles: ColumnRoles) -> None:
    """Refuse input columns that the fitted stages would have to overwrite."""
    generated = {
        *RESERVED_NAMES,
        *(c + INDEX_SUFFIX for c in roles.categorical),
        *(c + SLOT_SUFFIX for c in roles.categorical),
        *(c + ONE_HOT_SUFFIX for c in roles.categorical),
        *(c + IMPUTED_SUFFIX for c in roles.numeric),
    }
    generated = {name.lower() for name in generated}
    clashes = [c for c in columns if c.lower() in generated]
    if clashes:
        raise ValueError(f"Input columns use generated names, rename them: {clashes}")


def output_columns(
    columns: Sequence[str],
    ids: Sequence[str],
    label: str | None,
    input_columns: Sequence[str] | None = None,
) -> list[str]:
    """Columns of a scored table to write out.

    ``input_columns`` keeps the whole input; otherwise ids and label are kept
    where they exist. A table with none of the wanted columns is kept whole.
    """
    kept = input_columns if input_columns is not None else [*ids, *([label] if label else [])]
    wanted = dict.fromkeys([*kept, PREDICTION, PROBABILITY, PREDICTED_LABEL])
    return [c for c in wanted if c in columns] or list(columns)
