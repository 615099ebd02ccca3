"""Header cleaning as one projection."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.roles import clean_name


def clean_header(df: DataFrame) -> DataFrame:
    """Clean the names, drop nameless columns, keep the first of equal names.

    Names that differ only in case cannot be told apart by a case-insensitive
    session, so they are refused there instead of failing at some later step.
    """
    first_position: dict[str, int] = {}
    for position, name in enumerate(map(clean_name, df.columns)):
        if name:
            first_position.setdefault(name, position)

    if df.sparkSession.conf.get("spark.sql.caseSensitive", "false") != "true":
        spellings = Counter(name.lower() for name in first_position)
        alike = [name for name in first_position if spellings[name.lower()] > 1]
        if alike:
            raise ValueError(f"Column names differ only in case: {alike}")

    by_position = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return by_position.select(*[F.col(f"c{i}").alias(name) for name, i in first_position.items()])
