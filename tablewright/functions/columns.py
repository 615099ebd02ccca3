"""Column expressions for cleaning, hashing and text output.

The cleaning rules are SQL text because the same rule serves a DataFrame and
the ``SQLTransformer`` that travels with a fitted model.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for an absent category.
MISSING = "missing"

# Bits of the two hashes that a split compares with its border.
HASH_BITS = 64
PORTABLE_BITS = 60


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """A top-level column by its exact name, dots included."""
    return F.col(quoted(name))


def category_sql(name: str) -> str:
    """Text of a category; null, empty and space-only values become ``missing``."""
    text = f"CAST({quoted(name)} AS STRING)"
    return f"coalesce(CASE WHEN trim({text}) <> '' THEN {text} END, '{MISSING}')"


def number_sql(name: str) -> str:
    """Double value; text that is no number becomes null."""
    return f"try_cast({quoted(name)} AS DOUBLE)"


def probability_text(column: Column) -> Column:
    """Class probabilities (vector) as comma-joined text."""
    return F.concat_ws(",", vector_to_array(column))


def key_hash(keys: Sequence[Column], seed: int) -> Column:
    """A whole number of 64 bits, with sign, from a row's key values and the seed."""
    return F.xxhash64(F.lit(seed), *keys)


def portable_hash(keys: Sequence[Column], seed: int) -> Column:
    """60 bits without sign from md5, which other engines have too; several times slower."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, PORTABLE_BITS // 4), 16, 10).cast("long")


def share_of_hashes(share: float, bits: int) -> int:
    """How many of 2**bits hashes make up a share: neither none nor all of them."""
    return min(max(round(Fraction(share) * 2**bits), 1), 2**bits - 1)
