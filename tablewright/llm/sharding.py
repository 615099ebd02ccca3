"""Jump consistent hashing of stable keys to shards, in DataFrame expressions only.

A key walks through the shard numbers: at each jump a number drawn from the key and the
jump's count decides how far it goes, and the last stop below the number of shards is the
shard. With one shard more, a key either stops where it did or in the new shard, which
takes 1/(n+1) of the keys. There is no ring table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 100_000
LEAST_BLOCKS = 32
DRAW_RANGE = 2**32


def draw(key: Column, jump: Column | int) -> Column:
    """Uniform in (0, 1] from a key and the count of its jump: the first 32 bits of an md5."""
    digits = F.md5(F.concat_ws(":", key, F.lit(jump).cast("string") if isinstance(jump, int) else jump.cast("string")))
    return (F.conv(F.substring(digits, 1, 8), 16, 10).cast("long") + 1) / F.lit(float(DRAW_RANGE))


def jump_shards(key: Column, counts: list[int]) -> list[Column]:
    """The shard of a key (text) for each number of shards in ``counts``.

    One walk serves them all: it runs to the largest count and notes the last stop below
    each. A walk has at most as many jumps as there are shards, about ln(n) on average;
    the others leave the state as it is.
    """
    most = max(counts)
    start = F.struct(
        F.lit(0).cast("long").alias("at"), *(F.lit(0).cast("long").alias(f"s{n}") for n in counts)
    )

    def step(state: Column, jump: Column) -> Column:
        on = state["at"] < most
        to = F.when(on, F.floor((state["at"] + 1) / draw(key, jump))).otherwise(state["at"])
        return F.struct(
            to.cast("long").alias("at"),
            *(F.when(to < n, to).otherwise(state[f"s{n}"]).cast("long").alias(f"s{n}") for n in counts),
        )

    walk = F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step)
    return [walk[f"s{n}"].cast("int") for n in counts]


def slots(rows: DataFrame, shard_col: str, order: list[str], blocks: int) -> DataFrame:
    """``rows`` with ``slot``: gapless from 0 within each shard.

    Rows of a shard are numbered within blocks by a hash of the row; a block starts after
    the rows of the blocks before it, by a running sum over the small table of counts. So
    no task holds a whole shard.
    """
    from pyspark.sql import Window

    blocked = rows.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    counts = blocked.groupBy(shard_col, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard_col).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = counts.select(
        shard_col, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(shard_col, "_block").orderBy(*order)
    numbered = blocked.withColumn("_at", F.row_number().over(inside) - 1)
    joined = numbered.join(starts, [shard_col, "_block"])
    return joined.withColumn("slot", (F.col("_start") + F.col("_at")).cast("long")).drop(
        "_block", "_start", "_at"
    )


def shard_rows(
    docs: DataFrame,
    n_shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Puts every document into a shard by its id and the number of shards.

    Returns id_col, size (UTF-8 bytes of the text and 16), text_crc32, law (``key``),
    shard, slot (gapless from 0 in its shard) and grown_shard (with one shard more). A
    null text has no bytes; a null id is a key of its own, so all rows without an id go to
    one shard; rows with equal ids share a shard and have slots of their own. An empty
    table gives no rows. Other columns are not looked at. Only ids, sizes and checksums
    are shuffled, never texts.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    n = docs.count()
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        key.alias("_key"),
    )
    shard, grown = jump_shards(F.col("_key"), [n_shards, n_shards + 1])
    rows = rows.withColumns({"shard": shard, "grown_shard": grown}).drop("_key")
    blocks = max(LEAST_BLOCKS, -(-n // (block_rows * n_shards)))
    numbered = slots(rows, "shard", [id_col, "text_crc32", "size"], blocks)
    return numbered.select(
        id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
