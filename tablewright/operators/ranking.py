"""Places of rows in a total order, for tables that no single task could number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.sources.staging import stage

# Ranges at least, so that none holds more than a few percent of a large table.
LEAST_PARTS = 64
# Row numbers of a task as monotonically_increasing_id() gives them: the task above so many bits.
ROW_BITS = 33


def ranked(df: DataFrame, order: Sequence[Column], per: str | None = None) -> tuple[DataFrame, str]:
    """Adds ``place``, the number of rows before this one (of the same ``per``), from 0.

    Rows are dealt out by ranges of ``per`` and ``order`` and numbered where they lie; the ranges'
    sizes add up to what comes before each. ``order`` should tell all rows apart. The numbered
    rows are staged, because ranges are drawn from a sample and could differ the next time; the
    caller drops the returned path.
    """
    spark = df.sparkSession
    keys = [F.col(per), *order] if per else list(order)
    parts = max(LEAST_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = stage(
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__row__", F.monotonically_increasing_id()),
        "ranked",
    )
    numbered = spark.read.parquet(path).withColumns(
        {
            "__part__": F.shiftright("__row__", ROW_BITS),
            "__row__": F.col("__row__").bitwiseAND(F.lit((1 << ROW_BITS) - 1)),
        }
    )
    group = [per] if per else []
    sizes = numbered.groupBy("__part__", *group).agg(
        F.count(F.lit(1)).alias("__n__"), F.min("__row__").alias("__first__")
    )
    before = Window.partitionBy(*group).orderBy("__part__").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "__part__",
        *group,
        (F.coalesce(F.sum("__n__").over(before), F.lit(0)) - F.col("__first__")).alias("__start__"),
    )
    placed = numbered.join(starts, ["__part__", *group])
    return placed.select(*df.columns, (F.col("__start__") + F.col("__row__")).alias("place")), path
