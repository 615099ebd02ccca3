"""Threshold-scaled sketches: every shingle hash below a fixed fraction of the hash range.

Each sketch is a sample of its document's shingles by one rule, so two of them merge by union and
estimate containment whatever the sizes of their documents. A short text, of which the fraction
would keep next to nothing, has it doubled until enough is kept; sketches of two fractions are
compared, and merged, at the smaller one. A hash of the whole text tells equal from like.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.hashing import byte_grams, span_hashes

SHINGLE_BYTES = 16
HASH_BITS = 40
ONE_IN = 8
# The fraction is doubled for texts that keep fewer hashes.
LEAST_KEPT = 64
PART_BYTES = 8 << 20
MAX_PARTS = 20_000
NO_ID = -(2**63)
OUT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


@dataclass(frozen=True)
class Sketch:
    """The sorted distinct hashes below 1 / ``one_in`` of their range, and the text's own hash
    (None for several texts together)."""

    hashes: np.ndarray
    one_in: int
    whole: bytes | None

    def at(self, one_in: int) -> np.ndarray:
        """The hashes that a smaller fraction would have kept."""
        return self.hashes[: np.searchsorted(self.hashes, (1 << HASH_BITS) // one_in)]


def sketch(data: bytes, one_in: int = ONE_IN) -> Sketch:
    """The sketch of a text.

    Shingles are all strings of 16 bytes; a shorter text is one shingle, an empty text has
    none. So a sketch grows with its document, and one with fewer than LEAST_KEPT hashes has
    all shingles.
    """
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    if len(raw) >= SHINGLE_BYTES:
        hashes = byte_grams(raw, SHINGLE_BYTES)
    elif len(raw):
        hashes = span_hashes(raw, np.array([0]), np.array([len(raw)]))
    else:
        hashes = np.empty(0, np.uint64)
    hashes = hashes >> np.uint64(64 - HASH_BITS)
    while True:
        kept = np.unique(hashes[hashes < np.uint64((1 << HASH_BITS) // one_in)])
        if one_in == 1 or len(kept) >= LEAST_KEPT:
            return Sketch(kept, one_in, hashlib.blake2b(data, digest_size=8).digest())
        one_in //= 2


def as_text(kept: Sketch) -> str:
    """The fraction, the text's hash and the hashes in order, five bytes each, in base 64."""
    hashes = kept.hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()
    whole = "" if kept.whole is None else base64.b64encode(kept.whole).decode()
    return f"{kept.one_in}:{whole}:{base64.b64encode(hashes).decode()}"


def from_text(fingerprint: str) -> Sketch:
    one_in, whole, hashes = fingerprint.split(":")
    five = np.frombuffer(base64.b64decode(hashes), np.uint8).reshape(-1, 5)
    eight = np.hstack([np.zeros((len(five), 3), np.uint8), five])
    kept = np.ascontiguousarray(eight).view(">u8").reshape(-1).astype(np.uint64)
    return Sketch(kept, int(one_in), base64.b64decode(whole) if whole else None)


def merged(a: Sketch, b: Sketch) -> Sketch:
    """The sketch of two documents taken together."""
    one_in = max(a.one_in, b.one_in)
    return Sketch(np.union1d(a.at(one_in), b.at(one_in)), one_in, None)


def _shared(a: Sketch, b: Sketch) -> tuple[int, int, int]:
    """Hashes in both, in a and in b, at a fraction that both have."""
    one_in = max(a.one_in, b.one_in)
    x, y = a.at(one_in), b.at(one_in)
    return len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)


def containment(a: Sketch, b: Sketch) -> float:
    """Estimated share of a's shingles that are in b; 0 where a's sketch is empty."""
    both, n, _ = _shared(a, b)
    return both / n if n else 0.0


def likeness(a: Sketch, b: Sketch) -> float:
    """The larger of the two containments, which is that of the smaller sketch.

    Equal texts, empty ones too, have 1. Unequal ones have less, even where all hashes kept of
    one are in the other; where nothing is kept of one, 0.
    """
    if a.whole is not None and a.whole == b.whole:
        return 1.0
    both, n, m = _shared(a, b)
    return both / max(min(n, m), both + 1) if n and m else 0.0


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = ONE_IN
) -> DataFrame:
    """id_col, n_chars and the fingerprint of every whole text (null: empty), without shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([as_text(sketch(t.encode(), one_in)) for t in texts], pa.string()),
                ],
                names=[id_col, "n_chars", "fingerprint"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_chars long, fingerprint string"
    )


def neighbour_parts(docs: DataFrame, id_col: str, text_col: str, part_bytes: int) -> DataFrame:
    """(part, id, key, text, lent): documents by descending id, in parts of bounded size.

    Each part also holds, lent, the first document of the part after it (after the last
    part: of the first), so that a document and the next one always lie in one part. Parts
    are ranges of ids between quantiles. There are at most MAX_PARTS, so what the driver
    holds of them is bounded; beyond that parts grow, and tasks read them as streams.
    Texts are shuffled once. Documents without an id come last.
    """
    named = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    total = named.agg(F.sum(F.octet_length("text")).alias("bytes")).first()
    n_parts = min(max(1, -(-(total.bytes or 0) // part_bytes)), MAX_PARTS)
    shares = [i / n_parts for i in range(1, n_parts)]
    marks = named.agg(F.percentile_approx("key", shares, 10 * n_parts)).first()[0] if shares else []
    marks = np.unique(np.array(marks or [], np.int64))

    @F.pandas_udf("int")
    def part_of(keys: pd.Series) -> pd.Series:
        return pd.Series(len(marks) - np.searchsorted(marks, keys.to_numpy(), "right"))

    dealt = named.withColumn("part", part_of("key"))
    heads = dealt.groupBy("part").agg(F.max("key").alias("key")).orderBy("part").collect()
    head_keys = np.array([h.key for h in heads][::-1], np.int64)
    borrowers = np.array([heads[i - 1].part for i in range(len(heads))][::-1], np.int64)

    @F.pandas_udf("int")
    def borrower_of(keys: pd.Series) -> pd.Series:
        at = np.searchsorted(head_keys, keys.to_numpy()).clip(max=max(0, len(head_keys) - 1))
        return pd.Series(np.where(head_keys[at] == keys, borrowers[at], -1))

    first = F.max(F.struct("text", "id", "key"))
    lent = (
        named.withColumn("part", borrower_of("key"))
        .where("part >= 0")
        .groupBy("part")
        .agg(first.alias("first"))
        .select("part", "first.id", "first.key", "first.text", F.lit(True).alias("lent"))
    )
    return dealt.withColumn("lent", F.lit(False)).unionByName(lent)


def edit_pairs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    one_in: int = ONE_IN,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as
    many (or all) of the next document by descending id; after the last comes the first.
    Equal ids are ordered by text; a null id comes last, a null text is empty. One row per
    row of ``docs``: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. A single document is its own next one. Other columns are not
    looked at.
    """
    parts = neighbour_parts(docs, id_col, text_col, part_bytes)
    # Lent rows come after all rows of their part.
    ordered = parts.repartition("part").sortWithinPartitions(
        "part", "lent", F.col("key").desc(), F.col("text").desc()
    )
    ordered = ordered.select("part", "id", "text", "lent")

    def rows(batches) -> Iterator[tuple]:
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                yield tuple(c[i].as_py() for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, before = [], None
        for part, key, text, lent in rows(batches):
            own = sketch(text.encode(), one_in)
            if before is not None and before[0] == part:
                made.append(compare(before, text, own))
            before = None if lent else (part, key, text, own)
            if len(made) >= 500:
                yield table(made)
                made = []
        if made:
            yield table(made)

    def compare(before: tuple, following: str, following_sketch: np.ndarray) -> tuple:
        _, key, text, own = before
        half = len(text) // 2
        edited = (text[: len(text) - half] + following[:half]).encode()
        other = sketch(edited, one_in)
        return (
            key,
            len(text),
            hashlib.sha256(edited).hexdigest(),
            as_text(own),
            as_text(other),
            likeness(own, other),
            likeness(own, following_sketch),
        )

    def table(made: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = ["id", *(f.split()[0] for f in OUT.split(", "))]
        return pa.RecordBatch.from_arrays(
            [pa.array([m[i] for m in made], kinds[i]) for i in range(len(kinds))], names=names
        )

    return ordered.mapInArrow(run, f"id long, {OUT}").withColumnRenamed("id", id_col)
