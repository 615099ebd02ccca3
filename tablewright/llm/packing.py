"""Shortest-pack-first over the length histogram.

Documents are cut at multiples of the sequence length; full pieces are sequences of their
own. The remainders are packed by their histogram alone: lengths are placed longest
first, each into the packing patterns with the most room, and only counts of patterns are
kept. Patterns then meet documents by rank: the i-th remainder of a length belongs to the
i-th place for that length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.bpe import encode, encoding, load_added, load_model, load_vocabulary
from tablewright.sources.staging import drop_staged, stage

PIECES = "id long, start long, length long, ids_crc32 long, doc_tokens long"
SPREAD_ROWS = 5_000
LEAST_SPREAD = 64


def pack_lengths(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Packing patterns (lengths in a sequence, number of such sequences).

    Longest first; a length goes to the pattern with the fewest tokens that still has room
    for it, which is the one with the most room. If there are more pieces than sequences of
    that pattern, the pattern is used up and the next one is taken; if fewer, the rest of it
    stays as it was. Without room anywhere a new pattern begins. The work and the number of
    patterns depend on the number of lengths, not on that of documents.
    """
    by_room: dict[int, list[tuple[list[int], int]]] = {}
    rooms: list[int] = []

    def put(pattern: list[int], count: int, room: int) -> None:
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        placed = []
        while left:
            if not rooms or rooms[-1] < length:
                placed.append(([length], left, capacity - length))
                left = 0
                # New sequences take further pieces of this length as well.
                pattern, count, room = placed[-1]
                if room >= length and count > 1:
                    placed.pop()
                    each = capacity // length
                    whole, rest = divmod(count, each)
                    if whole:
                        placed.append(([length] * each, whole, capacity - each * length))
                    if rest:
                        placed.append(([length] * rest, 1, capacity - rest * length))
                break
            room = rooms[-1]
            pattern, count = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(bisect_left(rooms, room))
            most = room // length
            each = min(most, left)
            used = min(count, left // each)
            placed.append((pattern + [length] * each, used, room - each * length))
            left -= used * each
            if count > used:
                put(pattern, count - used, room)
        for pattern, count, room in placed:
            put(pattern, count, room)
    return [entry for room in rooms for entry in by_room[room]]


class Places:
    """Where the i-th remainder of each length goes: sorted bounds of ranks per length."""

    def __init__(self, patterns: list[tuple[list[int], int]], first: int):
        rows: dict[int, list[tuple[int, int, int]]] = {}
        taken: dict[int, int] = {}
        at = first
        for lengths, count in patterns:
            offset = 0
            for length in lengths:
                rank = taken.get(length, 0)
                rows.setdefault(length, []).append((rank, at, offset))
                taken[length] = rank + count
                offset += length
            at += count
        self.n_sequences = at
        table = [(length, *row) for length in sorted(rows) for row in rows[length]]
        self.length, self.rank, self.sequence, self.offset = (
            np.array([row[i] for row in table], np.int64) for i in range(4)
        )
        self.begins = {int(k): int(i) for i, k in enumerate(self.length) if i == 0 or self.length[i - 1] != k}
        self.ends = {int(k): i + 1 for i, k in enumerate(self.length)}

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset for remainders given by length and rank."""
        sequence = np.empty(len(lengths), np.int64)
        offset = np.empty(len(lengths), np.int64)
        for length in np.unique(lengths).tolist():
            here = lengths == length
            a, b = self.begins[length], self.ends[length]
            row = a + np.searchsorted(self.rank[a:b], ranks[here], "right") - 1
            sequence[here] = self.sequence[row] + ranks[here] - self.rank[row]
            offset[here] = self.offset[row]
        return sequence, offset


def cut_pieces(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    capacity: int,
    end_id: int,
    id_col: str,
    text_col: str,
) -> DataFrame:
    """A row per piece of at most ``capacity`` ids; every document's ids end with ``end_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(vocabulary_path)
        encoder = encoding(load_vocabulary(vocabulary_path, model), pattern)
        added = load_added(vocabulary_path, model)
        del model
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.concatenate((encode(encoder, text.as_py() or "", added), end))
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    rows.append((key.as_py(), start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[i] for row in rows], pa.int64()) for i in range(5)],
                    names=[field.split()[0] for field in PIECES.split(", ")],
                )

    named = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return named.mapInArrow(run, PIECES)


def ranked(rows: DataFrame, group: str, spread: int) -> DataFrame:
    """``rows`` with ``rank``: gapless from 0 in every group, however large a group is.

    Rows are numbered within a group's parts by hash, and a part starts after the parts
    before it, by a running sum over the small table of counts.
    """
    parts = rows.withColumn(
        "_part", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(spread)).cast("int")
    )
    counts = parts.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from")
    )
    inside = Window.partitionBy(group, "_part").orderBy("id", "start", "ids_crc32")
    return (
        parts.withColumn("_at", F.row_number().over(inside) - 1)
        .join(starts, [group, "_part"])
        .withColumn("rank", F.col("_from") + F.col("_at"))
        .drop("_part", "_from", "_at")
    )


def packed(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    capacity: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Packs the ids of all documents into sequences of at most ``capacity`` tokens.

    Returns a row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id,
    offset. A null or empty text is a document of the end id alone; a null id is a document
    like others; repeated rows are packed each. An empty table gives no rows. Other columns
    are not looked at. Texts are tokenised once, where they lie; what is shuffled are piece
    rows, and what the driver holds are a histogram of ``capacity`` counts and its patterns.
    """
    spark = docs.sparkSession
    pieces_path = stage(
        cut_pieces(docs, vocabulary_path, pattern, capacity, end_id, id_col, text_col), "pieces"
    )
    pieces = spark.read.parquet(pieces_path)
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    full = histogram.pop(capacity, 0)
    places = Places(pack_lengths(histogram, capacity), full)
    most = max([full, *histogram.values()])
    spread = max(LEAST_SPREAD, -(-most // SPREAD_ROWS))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            lengths, ranks = rows["length"].to_numpy(), rows["rank"].to_numpy()
            whole = lengths == capacity
            sequence, offset = ranks.copy(), np.zeros(len(rows), np.int64)
            if (~whole).any():
                sequence[~whole], offset[~whole] = places.of(lengths[~whole], ranks[~whole])
            yield rows.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    # Null ids would turn whole numbers into floating ones, so they travel as a mark.
    known = ranked(pieces, "length", spread).select(
        F.coalesce("id", F.lit(0)).alias("id"),
        F.col("id").isNull().alias("no_id"),
        "start", "length", "ids_crc32", "doc_tokens",
        F.col("rank").cast("long").alias("rank"),
    )
    out_path = stage(
        known.mapInPandas(
            place,
            "id long, no_id boolean, start long, length long, ids_crc32 long, doc_tokens long, "
            "sequence_id long, offset long",
        ),
        "packed",
    )
    drop_staged(spark, pieces_path)
    return spark.read.parquet(out_path).select(
        F.expr("if(no_id, null, id)").alias(id_col),
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    )
