"""Byte-level BPE with the tiktoken library and a local rank file.

The rank file is read where the tasks run; its path is a parameter. A long text is cut
only where no match of the split pattern can reach across, so its ids are those of the
whole text, while the memory of one call stays bounded.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_CHARS = 1 << 16
ROUND_TRIP = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks: a file of base64 tokens with ranks, one to a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def load_model(path: str) -> dict:
    """The JSON file of a tokenizer, without its merges, which follow from the ranks."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    model["model"].pop("merges", None)
    return model


def load_vocabulary(path: str, model: dict | None = None) -> dict[bytes, int]:
    """The same from the JSON file of a byte-level BPE tokenizer, without its added tokens.

    There every byte is written as one printable character: itself if it prints in
    Latin-1, else the next code point from 256 on.
    """
    model = model or load_model(path)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    added = {token["content"] for token in model.get("added_tokens", ())}
    return {
        bytes(byte_of[c] for c in token): rank
        for token, rank in model["model"]["vocab"].items()
        if token not in added
    }


def load_added(path: str, model: dict | None = None) -> dict[str, int]:
    """Added tokens of such a JSON file and their ids; they are found in texts as they stand."""
    tokens = (model or load_model(path)).get("added_tokens", ())
    for token in tokens:
        if token.get("lstrip") or token.get("rstrip") or token.get("single_word"):
            raise ValueError(f"added token {token['content']!r} takes its surroundings into account")
    return {token["content"]: token["id"] for token in tokens}


def encoding(ranks: dict[bytes, int], pattern: str):
    import tiktoken

    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Cuts a text before single spaces that stand between characters that are no spaces.

    There every match ends before the space or starts with it. Without such a place
    within reach the piece grows until there is one or the text ends.
    """
    start, n = 0, len(text)
    while n - start > limit:
        at = start + limit
        while True:
            at = text.find(" ", at)
            if at < 0 or at + 1 >= n:
                at = n
                break
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                break
            at += 1
        yield text[start:at]
        start = at
    if start < n:
        yield text[start:]


def encode(encoder, text: str, added: dict[str, int] | None = None) -> np.ndarray:
    """Ids of a whole text as unsigned 32-bit integers.

    A text is cut at the ``added`` tokens in it first, at each place the longest.
    """
    if added and any(token in text for token in added):
        longest = sorted(added, key=len, reverse=True)
        cut = re.split("(" + "|".join(map(re.escape, longest)) + ")", text)
        return np.concatenate(
            [
                np.array([added[part]], "<u4") if i % 2 else encode(encoder, part)
                for i, part in enumerate(cut)
            ]
        )
    if len(text) <= PIECE_CHARS:
        return np.array(encoder.encode_ordinary(text), dtype="<u4")
    parts = [np.array(encoder.encode_ordinary(p), dtype="<u4") for p in safe_pieces(text)]
    return np.concatenate(parts)


def decode(encoder, ids: np.ndarray, step: int = 1 << 16) -> bytes:
    """The raw bytes of ids; a character may span two of them, so no text is made."""
    return b"".join(
        encoder.decode_bytes(ids[i : i + step].tolist()) for i in range(0, len(ids), step)
    )


def map_ids(
    docs: DataFrame,
    text_col: str,
    schema: str,
    load: Callable[[], object],
    per_text: Callable[[object, str], tuple],
) -> DataFrame:
    """Other columns of ``docs``, with what ``per_text`` gives for each text (null: empty)."""
    keep = [c for c in docs.columns if c != text_col]
    names = [field.split()[0] for field in schema.split(", ")]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = load()
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col))
            made = [per_text(tool, t.as_py() or "") for t in texts]
            columns = [batch.column(batch.schema.names.index(c)) for c in keep]
            columns += [pa.array([row[i] for row in made]) for i in range(len(names))]
            if made:
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    return docs.mapInArrow(run, f"{kept}, {schema}" if kept else schema)


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encodes every whole text and decodes the ids again.

    Returns id_col, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers)
    and decoded_sha256. One row per row of ``docs``: a null or empty text has no ids and
    the digests of no bytes; a null id stays null; repeated rows stay repeated. Other
    columns of ``docs`` are not looked at. No shuffle, nothing kept between rows.
    """

    def load():
        return encoding(load_ranks(ranks_path), pattern)

    def per_text(encoder, text: str) -> tuple:
        ids = encode(encoder, text)
        return (
            len(ids),
            hashlib.sha256(ids.tobytes()).hexdigest(),
            hashlib.sha256(decode(encoder, ids)).hexdigest(),
        )

    return map_ids(docs.select(id_col, text_col), text_col, ROUND_TRIP, load, per_text)


def token_ids(
    docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out_col: str = "ids"
) -> DataFrame:
    """``docs`` with the ids of every text as an array column in place of the text."""

    def load():
        return encoding(load_ranks(ranks_path), pattern)

    def per_text(encoder, text: str) -> tuple:
        return (encode(encoder, text).astype(np.int64).tolist(),)

    return map_ids(docs, text_col, f"{out_col} array<bigint>", load, per_text)


def decoded_bytes(
    docs: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", out_col: str = "body"
) -> DataFrame:
    """``docs`` with a binary column of the raw bytes behind an array of ids (null: empty)."""
    named = docs.withColumn(ids_col, F.col(ids_col).cast("array<bigint>"))
    keep = [c for c in docs.columns if c != ids_col]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(load_ranks(ranks_path), pattern)
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            bodies = [
                decode(encoder, np.array(row.as_py() or [], np.int64)) for row in columns[ids_col]
            ]
            yield pa.RecordBatch.from_arrays(
                [columns[c] for c in keep] + [pa.array(bodies, pa.binary())], names=[*keep, out_col]
            )

    return named.mapInArrow(run, f"{kept}, {out_col} binary" if kept else f"{out_col} binary")
