"""Exact medians of many columns, and filling with them.

``exact_medians`` narrows an open interval around the wanted rank. One scan takes mergeable
quantile sketches, in groups of tasks first, so no task takes in those of all others; they propose
two borders close to the rank. A second scan counts the values below, on and between the
borders, and where few are left between them a third one picks the wanted one among these alone.
The sketches only propose; the counts decide, so the result is exact and the same for every
partitioning. As long as more than ``finish_rows`` values are left, new borders are
proposed between the old ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.columns import named
from tablewright.roles import IMPUTED_SUFFIX

FINISH_ROWS = 5_000_000
# Items of a sketch; its ranks are off by some 0.13 percent with it, and borders lie beside that.
SKETCH_ITEMS = 4096
MARGIN = 0.002
# Values of a column that one row may list.
LISTED = 100_000
DIGEST_GROUPS = 512


@dataclass(frozen=True)
class Interval:
    """Open interval known to hold the wanted value, unless it is found."""

    rank: int
    rows: int
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def holds(self, value: Column) -> Column:
        inside = value.isNotNull()
        if self.low is not None:
            inside = inside & (value > self.low)
        if self.high is not None:
            inside = inside & (value < self.high)
        return inside

    def narrowed(self, a: float, b: float, below: int, on_a: int, between: int, on_b: int) -> Interval:
        steps = [
            (below, replace(self, rows=below, high=a)),
            (on_a, replace(self, found=a)),
            (between, replace(self, rows=between, low=a, high=b)),
            (on_b, replace(self, found=b)),
        ]
        rank = self.rank
        for count, interval in steps:
            if rank <= count:
                return replace(interval, rank=rank)
            rank -= count
        above = self.rows - below - on_a - between - on_b
        return replace(self, rank=rank, rows=above, low=b)


def numbers(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Double values of the columns; NaN counts as absent."""
    values = [named(c).cast("double") for c in columns]
    return [F.when(~F.isnan(v), v) for v in values]


def exact_medians(
    df: DataFrame, columns: Sequence[str], finish_rows: int = FINISH_ROWS
) -> dict[str, float]:
    """Lower median of the present values of each column."""
    table = df.select(*[v.alias(f"v{i}") for i, v in enumerate(numbers(df, columns))])
    first = propose(table, {c: (F.col(c), 0.5) for c in table.columns})
    empty = [name for c, name in zip(table.columns, columns) if first[c][0] == 0]
    if empty:
        raise ValueError(f"No median: columns without any value: {empty}")
    state = {c: Interval(rank=(n + 1) // 2, rows=n) for c, (n, _, _) in first.items()}
    borders = {c: (low, high) for c, (_, low, high) in first.items()}
    while open_ := {c: s for c, s in state.items() if s.found is None}:
        state |= narrow(table, open_, borders)
        open_ = {c: s for c, s in state.items() if s.found is None}
        if few := {c: s for c, s in open_.items() if s.rows <= finish_rows}:
            state |= pick(table, few)
        if many := {c: s for c, s in open_.items() if c not in few}:
            proposed = propose(
                table, {c: (inside(c, s), s.rank / s.rows) for c, s in many.items()}
            )
            borders = {c: (low, high) for c, (_, low, high) in proposed.items()}
    return {name: state[f"v{i}"].found for i, name in enumerate(columns)}


def inside(name: str, interval: Interval) -> Column:
    return F.when(interval.holds(F.col(name)), F.col(name))


def propose(
    table: DataFrame, wanted: dict[str, tuple[Column, float]]
) -> dict[str, tuple[int, float | None, float | None]]:
    """One scan: number of values of each column, and two borders around a share of them."""
    values = table.select(
        (F.spark_partition_id() % DIGEST_GROUPS).alias("digest_group"),
        *[value.alias(c) for c, (value, _) in wanted.items()],
    )
    items = F.lit(SKETCH_ITEMS)
    merged = (
        values.groupBy("digest_group")
        .agg(*[F.kll_sketch_agg_double(c, items).alias(c) for c in wanted])
        .agg(*[F.kll_merge_agg_double(c, items).alias(c) for c in wanted])
    )
    n = {c: F.coalesce(F.kll_sketch_get_n_double(c), F.lit(0)) for c in wanted}
    ends = {c: F.array(F.lit(max(0.0, share - MARGIN)), F.lit(min(1.0, share + MARGIN))) for c, (_, share) in wanted.items()}
    row = merged.select(
        *[n[c].alias(f"{c}_n") for c in wanted],
        *[F.when(n[c] > 0, F.kll_sketch_get_quantile_double(c, ends[c])).alias(c) for c in wanted],
    ).first()
    return {c: (row[f"{c}_n"], *(row[c] or (None, None))) for c in wanted}


Borders = dict[str, tuple[float, float]]


def narrow(table: DataFrame, state: dict[str, Interval], borders: Borders) -> dict[str, Interval]:
    """One scan: counts below, on and between the borders.

    Where the proposal leaves few values between its borders, they are listed on the way, and
    the wanted one is known at once.
    """
    tests = {c: around_counts(inside(c, s), *borders[c]) for c, s in state.items()}
    short = [c for c, s in state.items() if 2 * MARGIN * s.rows <= LISTED]
    row = table.agg(
        *[F.count_if(test).alias(f"{c}_{i}") for c, around in tests.items() for i, test in enumerate(around)],
        *[F.collect_list(F.when(tests[c][2], F.col(c))).alias(f"{c}_between") for c in short],
    )
    place = {c: F.lit(state[c].rank) - F.col(f"{c}_0") - F.col(f"{c}_1") for c in short}
    row = row.select(
        *[f"{c}_{i}" for c in state for i in range(4)],
        *[
            F.when(
                place[c].between(1, F.col(f"{c}_2")),
                F.element_at(F.sort_array(f"{c}_between"), place[c].cast("int")),
            ).alias(f"{c}_found")
            for c in short
        ],
    ).first()
    narrowed = {
        c: s.narrowed(*borders[c], *[row[f"{c}_{i}"] for i in range(4)]) for c, s in state.items()
    }
    for c in short:
        if row[f"{c}_found"] is not None:
            narrowed[c] = replace(narrowed[c], found=row[f"{c}_found"])
    return narrowed


def around_counts(value: Column, a: float, b: float) -> list[Column]:
    """Below the first border, on it, between both, on the second one."""
    return [value < a, value == a, (value > a) & (value < b), (value == b) & F.lit(a != b)]


def pick(table: DataFrame, state: dict[str, Interval]) -> dict[str, Interval]:
    """One scan: the value at the rank among the values inside each interval."""
    cells = [
        F.when(
            s.holds(F.col(c)),
            F.struct(F.lit(c).alias("name"), F.lit(s.rank).alias("rank"), F.col(c).alias("value")),
        )
        for c, s in state.items()
    ]
    # Rows without such a value go first. A plain filter over all columns would do the same, but
    # the optimizer does not come to an end with it on wide tables.
    seen = F.greatest(F.lit(0), *[F.when(s.holds(F.col(c)), 1).otherwise(0) for c, s in state.items()])
    distinct = (
        table.filter(seen == 1)
        .select(F.inline(F.array_compact(F.array(*cells))))
        .groupBy("name", "rank", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("name").orderBy("value"))
    picked = (
        distinct.withColumn("upto", upto)
        .filter(F.col("upto") >= F.col("rank"))
        .groupBy("name")
        .agg(F.min("value").alias("value"))
        .collect()
    )
    return {name: replace(state[name], found=value) for name, value in picked}


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Add ``<c>_imputed``: the value, or the median where it is null or NaN."""
    filled = {
        c + IMPUTED_SUFFIX: F.coalesce(value, F.lit(median))
        for (c, median), value in zip(medians.items(), numbers(df, list(medians)))
    }
    return df.withColumns(filled)
