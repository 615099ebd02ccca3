"""Repeated word passages by prefix-partitioned suffix trees.

Suffixes are split by prefixes of varying length into groups that fit a bound; over each
group the top of its suffix tree is built level by level, and inner nodes at the depth
of the window are the passages that occur more than once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablewright.llm.chunks import BODY, CHUNK_BYTES, Chunks, chunks_in
from tablewright.llm.passages import Windows, covered, repeated_ranges
from tablewright.sources.staging import drop_staged, stage

WIDTH = 35
GRAM = 12
GROUP_SUFFIXES = 1 << 18
KEPT = "id long, n_words long, n_removed long, kept_sha256 string"


def prefix_groups(
    words: np.ndarray, suffixes: np.ndarray, depth: int, bound: int
) -> Iterator[tuple[int, np.ndarray]]:
    """(prefix length, suffixes): groups by prefix of at most ``bound`` suffixes.

    A prefix whose suffixes exceed the bound is made a word longer, up to ``depth`` words;
    then its suffixes are equal as far as it matters. Neighbouring prefixes that fit the
    bound together make one group, with what they share as its prefix. Prefixes with one
    suffix are left out.
    """
    waiting = [(0, suffixes)]
    while waiting:
        length, group = waiting.pop()
        if len(group) <= bound or length == depth:
            yield length, group
            continue
        group = group[np.argsort(words[group + length], kind="stable")]
        word = words[group + length]
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        begin = end = None
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(group)], strict=True):
            if b - a > bound:
                waiting.append((length + 1, group[a:b]))
            elif b - a > 1:
                if begin is not None and (end != a or b - begin > bound):
                    yield length, group[begin:end]
                    begin = None
                begin, end = (a if begin is None else begin), b
        if begin is not None:
            yield length, group[begin:end]


def deep_nodes(
    words: np.ndarray, pairs: np.ndarray, suffixes: np.ndarray, known: int, depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, node): the suffixes below inner nodes of ``depth`` words, and which node.

    The tree is built from its root, whose edge has the ``known`` words that all suffixes
    share: every inner node's suffixes are parted by their next words, two at a time where
    so many are left; a part with one suffix is a leaf and needs no more work. What reaches
    the depth are the inner nodes there.
    """
    node = np.zeros(len(suffixes), np.int64)
    at = known
    while at < depth and len(suffixes):
        two = depth - at > 1
        edge = pairs[suffixes + at] if two else words[suffixes + at]
        order = np.argsort((node.astype(np.uint64) << np.uint64(32)) | edge.astype(np.uint64))
        suffixes, node, edge = suffixes[order], node[order], edge[order]
        new = np.concatenate(([True], (node[1:] != node[:-1]) | (edge[1:] != edge[:-1])))
        sizes = np.diff(np.concatenate((np.flatnonzero(new), [len(new)])))
        inner = np.repeat(sizes > 1, sizes)
        node = (np.cumsum(new) - 1)[inner]
        suffixes = suffixes[inner]
        node = np.unique(node, return_inverse=True)[1] if len(node) else node
        at += 2 if two else 1
    return suffixes, node


def find_repeats(width: int, bound: int = GROUP_SUFFIXES):
    """For cuts of words: windows that start at more than one place among them."""

    def find(cuts: list[bytes], copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids: dict[bytes, int] = {}
        number = ids.setdefault
        texts = [[number(w, len(ids)) for w in cut.split()] for cut in cuts]
        sizes = np.array([len(t) for t in texts], np.int64)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        words = np.fromiter((w for t in texts for w in t), np.int64, int(edges[-1]))
        pair = words[:-1] * (len(ids) + 1) + words[1:]
        pairs = np.append(np.unique(pair, return_inverse=True)[1], 0)
        cut = np.repeat(np.arange(len(cuts)), sizes)
        suffixes = np.flatnonzero(np.arange(len(words)) + width <= edges[cut + 1])
        repeated = np.zeros(len(words), bool)
        for known, group in prefix_groups(words, suffixes, width, bound):
            below, _ = deep_nodes(words, pairs, group, known, width)
            repeated[below] = True
        return repeated[suffixes], sizes - width + 1

    return find


def _cleaned(chunk, row: dict) -> Iterator[tuple]:
    """(id, words, removed, digest of the kept words, kept text) of a chunk's documents.

    Where no word goes, the text stays as it was.
    """
    texts = chunk.texts()
    words = [t.split() for t in texts]
    edges = np.cumsum([0, *(len(w) for w in words)]).tolist()
    gone = covered(row["ranges"], edges[-1])
    for key, text, own, a, b in zip(chunk.ids, texts, words, edges[:-1], edges[1:], strict=True):
        removed = int(gone[a:b].sum())
        left = b" ".join(compress(own, (~gone[a:b]).tolist()) if removed else own)
        yield key, b - a, removed, hashlib.sha256(left).hexdigest(), left if removed else text


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk, row in chunks_in(batches):
        key, words, removed, digest, _ = zip(*_cleaned(chunk, row), strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key, pa.int64()),
                pa.array(words, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(digest, pa.string()),
            ],
            names=["id", "n_words", "n_removed", "kept_sha256"],
        )


def _documents(text_col: str, chars_col: str | None, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, row in chunks_in(batches):
            rest = chunk.rest(row).combine_chunks()
            columns = {name: rest[name].combine_chunks() for name in rest.column_names}
            _, _, removed, _, left = zip(*_cleaned(chunk, row), strict=True)
            texts = [t.decode() for t in left]
            columns[text_col] = pa.array(texts, pa.string())
            if chars_col in columns:
                # Counts of texts that stay as they were stay too.
                columns[chars_col] = pa.array(
                    [len(t) if r else n for t, r, n in zip(texts, removed, columns[chars_col].to_pylist(), strict=True)],
                    columns[chars_col].type,
                )
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return run


def _ranges(chunks: Chunks, width: int) -> DataFrame:
    windows = Windows(width=width, gram=min(GRAM, width), words=True)
    return chunks.with_messages(
        repeated_ranges(chunks, windows, find_repeats(width), first_only=False)
    )


def cleaned_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str | None = "n_chars",
    width: int = WIDTH,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``docs`` with its columns as they were, but texts without their repeated words.

    Rules are those of ``without_repeats``. A text that loses words is the kept ones joined
    by one space, and ``chars_col``, where there is one, its new number of code points; other
    texts are unchanged, except that a null text becomes the empty one. No row goes.
    """
    spark = docs.sparkSession
    chunks = Chunks(docs, id_col, text_col, chunk_bytes, whole=True)
    path = stage(
        _ranges(chunks, width)
        .select(*BODY, "rest", "ranges")
        .mapInArrow(_documents(text_col, chars_col, docs.columns), docs.schema),
        "cleaned",
    )
    chunks.drop()
    return spark.read.parquet(path)


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Words covered by a window of ``width`` words that occurs anywhere else are removed.

    Words are runs of bytes other than space and 0x09 to 0x0D, taken as they are. Anywhere
    else may be in the same document; every occurrence is removed, and windows are judged on
    the input. Returns a row per row of ``docs``: id_col, n_words, n_removed and kept_sha256
    (of the kept words joined by one space). A null text has no words, a null id is kept,
    repeated rows repeat each other. An empty table gives no rows; other columns are not
    looked at.
    """
    spark = docs.sparkSession
    chunks = Chunks(docs, id_col, text_col, chunk_bytes)
    path = stage(_ranges(chunks, width).select(*BODY, "ranges").mapInArrow(_digests, KEPT), "kept")
    chunks.drop()
    return spark.read.parquet(path).withColumnRenamed("id", id_col)
