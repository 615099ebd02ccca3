"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.sources.staging import drop_staged, stage


def components(links: DataFrame, label: str = "components") -> tuple[DataFrame, str]:
    """(node, root) with the smallest node that links reach, for every linked node.

    Rounds of two steps, each an aggregate with map-side combine: every node points its
    larger neighbours to its smallest one, then the smaller ones and itself. Stars stay
    as they are, so the rounds end when the links no longer change; their number grows
    with the logarithm of the longest chain. A round is written to the shared folder.
    Returns the staged path as well, to be dropped by the caller.
    """
    spark = links.sparkSession
    links = links.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    path = stage(links.distinct(), label)
    while True:
        now = spark.read.parquet(path)
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        # Large step: larger neighbours of a node point to the smallest of it and its neighbours.
        root = least.select("a", F.least("a", "low").alias("low"))
        large = (
            both.join(root, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        ).distinct()
        # Small step: a node and its smaller neighbours point to the smallest of them.
        first = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(first, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
            .where("a != b")
            .distinct()
        )
        after = stage(small, label)
        done = spark.read.parquet(after)
        same = _digest(done) == _digest(now)
        drop_staged(spark, path)
        path = after
        if same:
            return done.select(F.col("a").alias("node"), F.col("b").alias("root")), path


def _digest(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("sum"),
        F.bit_xor(F.xxhash64("a", "b")).alias("bits"),
    ).first()
    return tuple(row)
