"""Train / test split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import (
    HASH_BITS,
    PORTABLE_BITS,
    key_hash,
    named,
    portable_hash,
    share_of_hashes,
)
from tablewright.roles import SPLIT_PART

TRAIN = "train"
TEST = "test"


def check_test_size(test_size: float) -> None:
    if not 0 < test_size < 1:
        raise ValueError("test_size has to lie strictly between 0 and 1.")


def split_key(df: DataFrame, ids: Sequence[str]) -> list[Column]:
    """What identifies a row for the split.

    Whole numbers count as long, whatever width they were read with. Rows with a
    null id (and all rows of a table without ids) are told apart by a hash of
    their whole content, otherwise they would land on one side together.
    """
    content = F.xxhash64(*map(named, df.columns))
    present = [f for f in df.schema.fields if f.name in ids]
    if not present:
        return [content]
    keys = [
        named(f.name).cast("long" if isinstance(f.dataType, T.IntegralType) else "string")
        for f in sorted(present, key=lambda f: list(ids).index(f.name))
    ]
    incomplete = reduce(or_, [k.isNull() for k in keys])
    return [*keys, F.when(incomplete, content)]


def hash_split(
    df: DataFrame,
    ids: Sequence[str],
    test_size: float,
    seed: int,
    output: str = SPLIT_PART,
    portable: bool = False,
) -> DataFrame:
    """Mark each row as train or test from its key alone: no shuffle, repeatable.

    Rows with the same id stay on the same side.
    """
    check_test_size(test_size)
    key = split_key(df, ids)
    if portable:
        number = portable_hash(key, seed)
        border = 2**PORTABLE_BITS - share_of_hashes(test_size, PORTABLE_BITS)
    else:
        number = key_hash(key, seed)
        border = 2 ** (HASH_BITS - 1) - share_of_hashes(test_size, HASH_BITS)
    return df.withColumn(output, F.when(number < F.lit(border), TRAIN).otherwise(TEST))


def random_split(df: DataFrame, test_size: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split; its rows depend on the partitioning."""
    check_test_size(test_size)
    train, test = df.randomSplit([1 - test_size, test_size], seed=seed)
    return train, test
