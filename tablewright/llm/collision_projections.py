"""Near-duplicate vectors by collision-counting projections.

Vectors are projected on random lines. A pair collides on a line if one lies in a window centred
on the other; pairs that collide on enough lines, at a count set by the recall wanted at the
threshold itself, are verified by their cosine.

Pairs are only counted where they may pass: some lines at a time, cut into cells, make a table of
buckets, and a pair is counted if it shares a bucket of one table at least. How many lines a table
takes grows with the logarithm of the largest number of vectors with one label, so that a vector
meets some tens of others by chance at any size; how many tables there are follows from the
recall. Equal vectors are one vector from the start, however many copies there are, and a
crowded bucket is dealt out in pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.components import components
from tablewright.llm.hashing import MIX2, ODD, mix
from tablewright.sources.staging import drop_staged, stage

BLOCK_VECTORS = 4096
# Pairs that a task looks at at a time.
PAIRS = 1 << 18
SEED = 20240917
# Places on lines are sent as whole steps, in one byte each; windows are a step wider for it.
STEP = 0.05
# Width of a cell; the lines have places of deviation one.
CELL = 1.5


def same_cell(distance: float) -> float:
    """The chance that two vectors so far apart lie in one cell of a line."""
    x = CELL / distance
    return 1.0 - math.erfc(x / math.sqrt(2.0)) - 2.0 / (math.sqrt(2.0 * math.pi) * x) * (1.0 - math.exp(-x * x / 2.0))


@dataclass(frozen=True)
class Projections:
    """Lines, the window on each, the collisions that a candidate needs, and the tables.

    For unit vectors whose cosine is ``threshold``, the difference on a line with normal
    components is normal with standard deviation sqrt(2 - 2 threshold), on every line for
    itself. So the chance to collide is known, and the number of collisions is binomial.
    ``needed`` is the largest count that such a pair reaches with the recall wanted; closer
    pairs reach it more often. With ``keys`` lines to a table, a pair misses all ``tables`` as
    rarely.
    """

    threshold: float
    n_lines: int
    window: float
    needed: int
    keys: int
    tables: int

    @staticmethod
    def calibrated(
        threshold: float,
        n_lines: int = 24,
        recall: float = 0.9999,
        window_deviations: float = 2.0,
        n_vectors: int = 1000,
    ) -> Projections:
        deviation = math.sqrt(2.0 - 2.0 * threshold)
        hit = math.erf(window_deviations / math.sqrt(2.0))
        miss_share = (1.0 - recall) / 2.0
        below, needed = 0.0, 0
        for count in range(n_lines + 1):
            below += math.comb(n_lines, count) * hit**count * (1.0 - hit) ** (n_lines - count)
            if below > miss_share:
                break
            needed = count + 1
        keys = max(1, math.ceil(math.log(max(2, n_vectors)) / -math.log(same_cell(math.sqrt(2.0)))))
        tables = math.ceil(math.log(miss_share) / math.log(1.0 - same_cell(deviation) ** keys))
        return Projections(threshold, n_lines, window_deviations * deviation, needed, keys, tables)

    def lines(self, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
        """The same random lines in every task, those of the count first, and where cells begin."""
        rng = np.random.default_rng(SEED + dimensions)
        n = self.n_lines + self.keys * self.tables
        return rng.standard_normal((dimensions, n)), rng.uniform(0.0, CELL, self.keys * self.tables)

    def places(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each unit vector: its places on the lines of the count, its bucket in each table."""
        lines, begin = self.lines(units.shape[1])
        at = units @ lines
        steps = np.clip(np.floor(at[:, : self.n_lines] / STEP), -128, 127).astype(np.int8)
        cells = np.floor((at[:, self.n_lines :] + begin) / CELL).astype(np.int64).view(np.uint64)
        cells = cells.reshape(len(units), self.tables, self.keys)
        buckets = np.broadcast_to(np.arange(self.tables, dtype=np.uint64) * ODD, cells.shape[:2]).copy()
        for k in range(self.keys):
            buckets = mix(buckets * MIX2 + cells[:, :, k] + ODD)
        return steps, buckets

    def collisions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """On how many lines the windows of places a hold the places b, row by row."""
        return (np.abs(a.astype(np.int16) - b) <= math.ceil(self.window / STEP)).sum(axis=1)


def unit_vectors(vectors: pa.Array, fine: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and unit vectors of the usable rows, some of one length at a time."""
    sizes = np.diff(vectors.offsets.to_numpy())
    ends = np.cumsum(sizes)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    for dims in np.unique(sizes[fine]).tolist():
        rows = np.flatnonzero(fine & (sizes == dims))
        for i in range(0, len(rows), 512):
            some = rows[i : i + 512]
            values = flat[(ends[some] - dims)[:, None] + np.arange(dims)]
            largest = np.abs(values).max(axis=1, initial=0.0)
            good = np.isfinite(largest) & (largest > 0.0)
            # Scaled first, so that no square overflows or vanishes.
            values = values[good] / largest[good, None]
            yield some[good], values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, id, label, dims, unit) of the vectors that may link."""
    for batch in batches:
        vectors = batch.column(3)
        fine = np.asarray(batch.column(2).is_valid()) & np.asarray(vectors.is_valid())
        for rows, units in unit_vectors(vectors, fine):
            if len(rows):
                kept = [batch.column(i).take(pa.array(rows)) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([units.shape[1]] * len(rows), pa.int64()), pa.array([u.tobytes() for u in units], pa.binary())],
                    names=["row", "id", "label", "dims", "unit"],
                )


def _buckets(rule: Projections):
    """(row, label, dims, steps, buckets): a distinct vector's places and its bucket in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for n in np.unique(dims).tolist():
                all_rows = np.flatnonzero(dims == n)
                for i in range(0, len(all_rows), 512):
                    rows = all_rows[i : i + 512]
                    data = b"".join(v.as_py() for v in batch.column(3).take(pa.array(rows)))
                    steps, buckets = rule.places(np.frombuffer(data).reshape(len(rows), n))
                    ends = pa.array(np.arange(0, buckets.size + 1, rule.tables, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(c).take(pa.array(rows)) for c in range(3)),
                            pa.array([s.tobytes() for s in steps], pa.binary()),
                            pa.ListArray.from_arrays(ends, pa.array(buckets.reshape(-1).view(np.int64))),
                        ],
                        names=["row", "label", "dims", "steps", "buckets"],
                    )

    return run


def _candidates(rule: Projections):
    """(a, b): pairs that share a bucket here and collide often enough."""

    def run(table: pa.Table) -> pa.Table:
        bucket, task = table["bucket"].to_numpy(), table["task"].to_numpy()
        rows, side = table["row"].to_numpy(), table["side"].to_numpy()
        order = np.lexsort((rows, side, task, bucket))
        bucket, task, rows, side = bucket[order], task[order], rows[order], side[order]
        steps = np.frombuffer(b"".join(table["steps"].take(pa.array(order)).to_pylist()), np.int8)
        steps = steps.reshape(len(rows), rule.n_lines)
        own = np.concatenate(([True], (np.diff(bucket) != 0) | (np.diff(task) != 0)))
        group = np.cumsum(own) - 1
        both = np.bincount(group, side) > 0  # two blocks, whose own pairs are other tasks'
        # Of equal groups next to each other every member meets those at each distance behind it.
        behind = np.append(np.flatnonzero(own)[1:], len(rows))[group] - np.arange(len(rows)) - 1
        found: list[np.ndarray] = [np.empty((0, 2), np.int64)]
        for distance in range(1, int(behind.max(initial=0)) + 1):
            at = np.flatnonzero(behind >= distance)
            behind_at = at + distance
            wanted = ~both[group[at]] | (side[at] != side[behind_at])
            at, behind_at = at[wanted], behind_at[wanted]
            for i in range(0, len(at), PAIRS):
                a, b = at[i : i + PAIRS], behind_at[i : i + PAIRS]
                enough = rule.collisions(steps[a], steps[b]) >= rule.needed
                found.append(np.column_stack((rows[a[enough]], rows[b[enough]])))
        pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return run


def _verified(threshold: float):
    """The pairs whose cosine reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, bool)
            sizes = np.array([len(v) for v in batch.column(2).to_pylist()], np.int64)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                x, y = (
                    np.frombuffer(b"".join(batch.column(c).take(pa.array(at)).to_pylist())).reshape(len(at), -1)
                    for c in (2, 3)
                )
                near[at] = np.einsum("ij,ij->i", x, y) >= threshold
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def candidate_pairs(distinct: DataFrame, rule: Projections, block_vectors: int) -> DataFrame:
    """(a, b) of the distinct vectors that share a bucket and collide on enough lines."""
    placed = distinct.select("row", "label", "dims", "unit").mapInArrow(
        _buckets(rule), "row long, label string, dims long, steps binary, buckets array<long>"
    )
    members = placed.select(
        "row", "steps", "label", "dims", F.explode("buckets").alias("cell")
    ).select("row", "steps", F.xxhash64("label", "dims", "cell").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block_vectors))
    block = F.pmod(F.xxhash64("row"), F.col("blocks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    tasks = (
        members.join(sizes, "bucket")
        .select("bucket", "row", "steps", blocks.alias("blocks"))
        .select("bucket", "row", "steps", "blocks", block.alias("block"), F.explode(every).alias("other"))
        .select(
            "bucket",
            "row",
            "steps",
            (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).alias("task"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
        )
    )
    # Many buckets to a group, as most have two or three members; a block of a crowded one is alone.
    parts = max(64, 4 * int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (
        tasks.withColumn("part", F.pmod(F.xxhash64("bucket", "task"), F.lit(parts)))
        .groupBy("part")
        .applyInArrow(_candidates(rule), "a long, b long")
        .distinct()
    )


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    recall: float = 0.9999,
    block_vectors: int = BLOCK_VECTORS,
) -> DataFrame:
    """Links of vectors with equal labels whose cosine is at least ``threshold``.

    Returns a row per row of ``vectors``: id_col, n_links, component_id (smallest id that
    links reach, itself included) and kept (whether that is the row's own id). Vectors that
    are null, empty, zero or hold null or non-finite components, and those without a label,
    link with nothing; vectors of different lengths don't link. Rows with equal ids are
    separate vectors; a null id comes after all others, and a component of rows without ids
    has none. An empty table gives no rows; other columns are not looked at.
    """
    spark = vectors.sparkSession
    staged: list[str] = []

    def kept(df: DataFrame, label: str) -> DataFrame:
        staged.append(stage(df, label))
        return spark.read.parquet(staged[-1])

    vector = F.col(vector_col).cast("array<double>")
    every = kept(
        vectors.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("id"),
            F.col(label_col).cast("string").alias("label"),
            F.when(F.forall(vector, lambda c: c.isNotNull()) & (F.size(vector) > 0), vector).alias("vector"),
        ),
        "vectors",
    )
    units = kept(every.mapInArrow(_units, "row long, id long, label string, dims long, unit binary"), "units")
    distinct = kept(
        units.groupBy("label", "dims", "unit").agg(
            F.min("row").alias("rep"), F.count("*").alias("copies"), F.min("id").alias("least")
        ),
        "distinct",
    ).withColumnRenamed("rep", "row")
    largest = distinct.groupBy("label", "dims").count().agg(F.max("count").alias("n")).first().n or 1
    rule = Projections.calibrated(threshold, recall=recall, n_vectors=largest)
    pairs = kept(candidate_pairs(distinct, rule, block_vectors), "candidates")
    own = distinct.select("row", "unit")
    links = kept(
        pairs.join(own.select(F.col("row").alias("a"), F.col("unit").alias("x")), "a")
        .join(own.select(F.col("row").alias("b"), F.col("unit").alias("y")), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(_verified(threshold), "a long, b long"),
        "links",
    )
    roots, roots_path = components(links)
    staged.append(roots_path)
    times = distinct.select(F.col("row").alias("b"), "copies")
    others = (
        links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .join(times, "b")
        .groupBy("a")
        .agg(F.sum("copies").alias("others"))
    )
    classes = (
        distinct.join(roots.withColumnRenamed("node", "row"), "row", "left")
        .join(others.withColumnRenamed("a", "row"), "row", "left")
        .select(
            "label", "dims", "unit", "least", F.coalesce("root", "row").alias("root"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = kept(classes.join(least, "root").select("label", "dims", "unit", "n_links", "component_id"), "classes")
    linked = kept(
        units.join(named, ["label", "dims", "unit"])
        .where("n_links > 0")
        .select("row", "n_links", "component_id"),
        "linked",
    )
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    out = stage(
        every.select("row", "id")
        .join(linked, "row", "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        ),
        "near_vectors",
    )
    for path in staged:
        drop_staged(spark, path)
    return spark.read.parquet(out)
