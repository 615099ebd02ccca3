"""Value cleaning, row cleaning and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import category_sql, named, number_sql, quoted
from tablewright.roles import ColumnRoles


def cleaning_rules(categorical: Sequence[str], numeric: Sequence[str]) -> dict[str, str]:
    return {c: category_sql(c) for c in categorical} | {c: number_sql(c) for c in numeric}


def clean_values(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Categories to text without blanks, numbers to double, in one projection."""
    rules = cleaning_rules(categorical, numeric)
    return df.select(
        *[F.expr(rules[c]).alias(c) if c in rules else named(c) for c in df.columns]
    )


def cleaning_stage(roles: ColumnRoles) -> SQLTransformer:
    """The same rules as a stage, so that a saved model cleans its own input."""
    rules = cleaning_rules(roles.categorical, roles.numeric)
    replaced = ", ".join(quoted(c) for c in rules)
    cleaned = ", ".join(f"{rule} AS {quoted(c)}" for c, rule in rules.items())
    return SQLTransformer(statement=f"SELECT * EXCEPT ({replaced}), {cleaned} FROM __THIS__")


def drop_null_label(df: DataFrame, label: str) -> DataFrame:
    return df.filter(named(label).isNotNull())


def drop_duplicates(
    df: DataFrame,
    ids: Sequence[str],
    label: str,
    order_by: Sequence[str] = (),
    keep: str = "first",
    null_ids: str = "collapse",
) -> DataFrame:
    """One row per (ids, label): the first or last one by ``order_by``.

    Ties are broken by the remaining columns, so the survivor does not depend on
    the partitioning. It is a plain aggregate: each task reduces its own copies
    before the shuffle, which keeps a key with very many copies cheap. With
    ``null_ids='keep'`` rows without a complete id are never duplicates, and they
    are not shuffled at all.
    """
    present = [c for c in ids if c in df.columns]
    if not present:
        return df
    if null_ids == "keep":
        incomplete = reduce(or_, [named(c).isNull() for c in present])
        distinct = drop_duplicates(df.filter(~incomplete), present, label, order_by, keep)
        return distinct.unionByName(df.filter(incomplete))

    keys = list(dict.fromkeys([*present, label]))
    rest = [c for c in dict.fromkeys([*order_by, *df.columns]) if c not in keys]
    if not rest:
        return df.select(*map(named, keys)).distinct().select(*map(named, df.columns))
    pick = {"first": F.min, "last": F.max}[keep]
    survivors = df.groupBy(*map(named, keys)).agg(
        pick(F.struct(*[named(c).alias(f"c{i}") for i, c in enumerate(rest)])).alias("survivor")
    )
    place = {c: F.col("survivor").getField(f"c{i}") for i, c in enumerate(rest)}
    return survivors.select(*[place[c].alias(c) if c in place else named(c) for c in df.columns])
