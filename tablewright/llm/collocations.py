"""Phrases whose words occur together more often than apart, found with mergeable counters.

Words are counted in pieces of text (between marks of punctuation and line ends), per language.
A phrase must occur ``least`` times, so few of the n-grams matter, but which ones is known only
after counting. Two passes over the staged text:

1. Every chunk counts the hashes of its distinct n-grams of one to five words and sends them,
   packed, to the hash partitions that own them. A partition folds what it gets into one
   Misra-Gries summary. Its capacity exceeds the partition's mass (n-gram occurrences) divided
   by ``least``, so all that the summary takes off a counter is less than ``least`` and no
   frequent n-gram is lost, however the counts are spread. Each chunk is told which of its hashes
   may be frequent.
2. Every chunk counts these n-grams by their words and sends phrases and counts, packed, to the
   hash partitions again, which add them up and keep the frequent ones.

Hashes only propose; a phrase's counts never depend on them. A phrase travels once per chunk, and
hashing deals out the phrases of a language, so one that makes up a third of the text is no hot
group.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.chunks import BODY, Chunk, Chunks, chunks_in
from tablewright.llm.hashing import MIX2, ODD, mix
from tablewright.sources.staging import drop_staged, stage

LONGEST = 5
CHUNK_BYTES = 4 << 20
# Text of a partition's n-grams: some ten million of them.
PARTITION_BYTES = 8 << 20
# The summaries hold so many times what the guarantee needs; less is taken off each counter then.
CAPACITY_FACTOR = 2
FOLD_ENTRIES = 1 << 20
SALTS = 64
UNKNOWN_LANG = "und"

# Bytes as the words take them: A-Z lower-cased, ends of pieces as line feeds, tabs as spaces.
TABLE = bytes(
    10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b
    for b in range(256)
)
NO_WORD, PIECE_END = 0, 1
ZERO = np.uint64(0)

COUNTS = "`group` long, chunk long, n long, mass long, hashes binary, counts binary"
ANSWERS = "chunk long, `group` long, n long, hashes binary"
PACKED = "lang string, `group` long, n long, n_bytes long, phrases binary, counts binary"
PHRASES = "lang string, words int, phrase string, n long"


class Words:
    """The words of some texts as numbers, exact within one chunk, and hashes of their n-grams."""

    def __init__(self, chunk: Chunk, langs: list[str | None]):
        import xxhash

        number: dict[bytes, int] = defaultdict(count(PIECE_END + 1).__next__)
        number[b""], number[b"\n"] = NO_WORD, PIECE_END
        texts: dict[str, list[bytes]] = defaultdict(list)
        for lang, text in zip(langs, chunk.texts(), strict=True):
            texts[UNKNOWN_LANG if lang is None else lang].append(text)
        self.ids: dict[str, np.ndarray] = {}
        for lang, some in sorted(texts.items()):
            parts = [self._numbers(b"\n".join(some), number)]
            parts.append(np.full(1, PIECE_END, np.int32))
            self.ids[lang] = np.concatenate(parts)
        self.vocabulary = list(number)
        self.hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.vocabulary], np.uint64)

    @staticmethod
    def _numbers(text: bytes, number: dict[bytes, int]) -> np.ndarray:
        plain = text.translate(TABLE)
        parts, done = [np.empty(0, np.int32)], 0
        # Some text at a time: the words themselves live only for a moment.
        while done < len(plain):
            end = plain.find(b"\n", done + (1 << 18)) + 1 or len(plain)
            words = plain[done:end].replace(b"\n", b" \n ").split(b" ")
            got = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
            parts.append(got[got != NO_WORD])
            done = end
        return np.concatenate(parts)

    def n_words(self, lang: str) -> int:
        return int((self.ids[lang] != PIECE_END).sum())

    def grams(self, lang: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, starts and 64-bit keys of the n-grams of each length."""
        import xxhash

        ids = self.ids[lang]
        own = self.hashes[ids]
        seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        at = np.flatnonzero(ids != PIECE_END)
        keys = mix(own[at] ^ seed)
        for length in range(1, LONGEST + 1):
            if length > 1:
                # The text ends with PIECE_END, so at + length - 1 stays inside.
                on = ids[at + (length - 1)] != PIECE_END
                at, keys = at[on], keys[on]
                keys = mix(keys * MIX2 + own[at + (length - 1)] + ODD)
            yield length, at, keys

    def phrase(self, ids: np.ndarray) -> bytes:
        return b" ".join([self.vocabulary[i] for i in ids.tolist()])


def key_bits(n_bytes: int) -> int:
    """Bits of an n-gram's key: four or more keys for each n-gram that so much text can have."""
    return min(64, max(16, (LONGEST * n_bytes).bit_length() + 1))


def chunk_counts(words: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct keys of a chunk's n-grams and how often each occurs."""
    shift = np.uint64(64 - bits)
    keys = [keys >> shift for lang in words.ids for _, _, keys in words.grams(lang)]
    keys = np.concatenate([np.empty(0, np.uint64), *keys])
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
    return keys[first], np.diff(np.append(first, len(keys)))


def _edges(keys: np.ndarray, bits: int, group_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups that sorted keys belong to, and where each begins (with the end of the last)."""
    groups = keys >> np.uint64(bits - group_bits)
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1]))[: len(keys)])
    return groups[first].astype(np.int64), np.append(first, len(keys))


def squeeze(values: np.ndarray) -> bytes:
    """Small whole numbers, byte plane by byte plane, compressed."""
    import zstandard

    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expand(data: bytes, n: int) -> np.ndarray:
    import zstandard

    plain = zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, 8 * n))
    planes = np.frombuffer(plain, np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(n)


class MisraGries:
    """Counters for the frequent ones of many keys, mergeable, with an exact bound of the error.

    ``taken`` is what any counter may lack: below mass / (capacity + 1) whatever the order in
    which summaries are merged, because each unit of it took one from capacity + 1 counters.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys = np.empty(0, np.uint64)
        self.counts = np.empty(0, np.int64)
        self.taken = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        keys = np.concatenate([self.keys, keys])
        counts = np.concatenate([self.counts, counts])
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
        keys = keys[first]
        counts = np.add.reduceat(counts[order], first) if len(first) else counts[:0]
        if len(keys) > self.capacity:
            least = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.taken += least
            counts = counts - least
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def at_least(self, least: int) -> np.ndarray:
        """The sorted keys that may have occurred so often; all that have are among them."""
        return self.keys[self.counts + self.taken >= least]


def _count_rows(bits: int, group_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, row in chunks_in(batches):
            words = Words(chunk, chunk.rest(row).column("lang").to_pylist())
            keys, counts = chunk_counts(words, bits)
            groups, edges = _edges(keys, bits, group_bits)
            spans = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if len(groups) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(groups),
                    pa.array([chunk.number] * len(groups), pa.int64()),
                    pa.array([b - a for a, b in spans], pa.int64()),
                    pa.array([int(counts[a:b].sum()) for a, b in spans], pa.int64()),
                    pa.array(
                        [squeeze(np.diff(keys[a:b], prepend=ZERO)) for a, b in spans], pa.binary()
                    ),
                    pa.array([squeeze(counts[a:b]) for a, b in spans], pa.binary()),
                ],
                names=["group", "chunk", "n", "mass", "hashes", "counts"],
            )

    return run


def _frequent(least: int):
    def run(table: pa.Table) -> pa.Table:
        """One hash partition: folds all chunks' counts into a summary and answers each chunk."""
        rows = table.to_pylist()
        mass = sum(row["mass"] for row in rows)
        summary = MisraGries(CAPACITY_FACTOR * (mass // least + 1))
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for i, row in enumerate(rows):
            waiting.append((_sorted_keys(row), expand(row["counts"], row["n"]).astype(np.int64)))
            size += row["n"]
            if size >= max(FOLD_ENTRIES, summary.capacity) or i + 1 == len(rows):
                summary.merge(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
                waiting, size = [], 0
        frequent = summary.at_least(least)
        answers = []
        for row in rows:
            keys = _sorted_keys(row)
            found = keys[_isin(keys, frequent)]
            if len(found):
                answers.append((row["chunk"], row["group"], len(found), squeeze(np.diff(found, prepend=ZERO))))
        chunks, groups, sizes, hashes = zip(*answers, strict=True) if answers else [()] * 4
        return pa.table(
            {
                "chunk": pa.array(chunks, pa.int64()),
                "group": pa.array(groups, pa.int64()),
                "n": pa.array(sizes, pa.int64()),
                "hashes": pa.array(hashes, pa.binary()),
            }
        )

    return run


def _sorted_keys(row: dict) -> np.ndarray:
    return np.cumsum(expand(row["hashes"], row["n"]), dtype=np.uint64)


def _isin(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are among the sorted known ones; a small table sorts most of the others out."""
    if not len(known):
        return np.zeros(len(keys), bool)
    size = 1 << max(16, (16 * len(known)).bit_length())
    mask = np.uint64(size - 1)
    table = np.zeros(size, bool)
    table[(mix(known) & mask).astype(np.int64)] = True
    out = table[(mix(keys) & mask).astype(np.int64)]
    maybe = np.flatnonzero(out)
    place = np.searchsorted(known, keys[maybe])
    place[place == len(known)] = 0
    out[maybe] = known[place] == keys[maybe]
    return out


def _phrase_rows(bits: int, group_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=1).compress
        shift = np.uint64(64 - bits)
        for chunk, row in chunks_in(batches):
            words = Words(chunk, chunk.rest(row).column("lang").to_pylist())
            answers = sorted(row["answers"] or [], key=lambda a: a["group"])
            frequent = np.concatenate([np.empty(0, np.uint64), *map(_sorted_keys, answers)])
            rows = []
            for lang, ids in words.ids.items():
                found: dict[int, tuple[list[bytes], list[int]]] = defaultdict(lambda: ([], []))
                # All words of the language go, without a phrase, to any one group.
                found[chunk.number % (1 << group_bits)] = ([b""], [words.n_words(lang)])
                for length, at, full in words.grams(lang):
                    keys = full >> shift
                    on = _isin(keys, frequent)
                    groups = (keys >> np.uint64(bits - group_bits)).astype(np.int64)
                    for start, n in _same_words(ids, length, at[on], full[on], groups[on]):
                        phrases, counts = found[start[1]]
                        phrases.append(words.phrase(ids[start[0] : start[0] + length]))
                        counts.append(n)
                rows += [(lang, group, *of) for group, of in found.items()]
            texts = [b"\n".join(phrases) for _, _, phrases, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang for lang, *_ in rows], pa.string()),
                    pa.array([group for _, group, _, _ in rows], pa.int64()),
                    pa.array([len(counts) for *_, counts in rows], pa.int64()),
                    pa.array([len(text) for text in texts], pa.int64()),
                    pa.array([compress(text) for text in texts], pa.binary()),
                    pa.array([squeeze(np.array(counts, np.uint64)) for *_, counts in rows], pa.binary()),
                ],
                names=["lang", "group", "n", "n_bytes", "phrases", "counts"],
            )

    return run


def _exact_counts(least: int):
    def run(table: pa.Table) -> pa.Table:
        """One language's phrases of one hash partition, their counts added up."""
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        total: dict[bytes, int] = defaultdict(int)
        for row in table.to_pylist():
            text = decompress(row["phrases"], max_output_size=max(1, row["n_bytes"]))
            counts = expand(row["counts"], row["n"]).tolist()
            for phrase, n in zip(text.split(b"\n"), counts, strict=True):
                total[phrase] += n
        kept = [(phrase, n) for phrase, n in total.items() if n >= least or not phrase]
        return pa.table(
            {
                "lang": pa.array([table.column("lang")[0].as_py()] * len(kept), pa.string()),
                "words": pa.array([phrase.count(b" ") + 1 if phrase else 0 for phrase, _ in kept], pa.int32()),
                "phrase": pa.array([phrase.decode("utf-8", "replace") for phrase, _ in kept], pa.string()),
                "n": pa.array([n for _, n in kept], pa.int64()),
            }
        )

    return run


def _same_words(
    ids: np.ndarray, length: int, at: np.ndarray, keys: np.ndarray, groups: np.ndarray
) -> Iterator[tuple[tuple[int, int], int]]:
    """A start, with its group, and the number of occurrences of each n-gram, by its words."""
    if not len(at):
        return
    order = np.argsort(keys, kind="stable")
    at, keys, groups = at[order], keys[order], groups[order]
    first = np.concatenate(([True], keys[1:] != keys[:-1]))
    run = np.cumsum(first) - 1
    head = at[first]
    same = np.ones(len(at), bool)
    for k in range(length):
        same &= ids[at + k] == ids[head[run] + k]
    counts = np.bincount(run[same], minlength=len(head)).tolist()
    yield from zip(zip(head.tolist(), groups[first].tolist(), strict=True), counts, strict=True)
    # Other n-grams with a hash in common, if there ever are any.
    rest: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for i, group in zip(at[~same].tolist(), groups[~same].tolist(), strict=True):
        rest[ids[i : i + length].tobytes()].append((i, group))
    yield from ((places[0], len(places)) for places in rest.values())


def phrase_counts(
    docs: DataFrame, least: int = 100, text_col: str = "text", lang_col: str = "lang"
) -> tuple[DataFrame, str]:
    """(lang, words, phrase, n): exact counts of all n-grams that occur ``least`` times.

    Rows with ``words`` 0 have shares of the number of all words of the language. Staged; the path
    is returned too, to be dropped by the caller.
    """
    rows = docs.select(
        F.lit(0).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    chunks = Chunks(rows, "id", "text", CHUNK_BYTES, whole=True)
    try:
        bits = key_bits(chunks.n_bytes)
        group_bits = min(bits, (chunks.n_bytes // PARTITION_BYTES).bit_length())
        sent = chunks.scan().select(*BODY, "rest").mapInArrow(_count_rows(bits, group_bits), COUNTS)
        answers = (
            sent.groupBy("group")
            .applyInArrow(_frequent(least), ANSWERS)
            .groupBy("chunk")
            .agg(F.collect_list(F.struct("group", "n", "hashes")).alias("answers"))
        )
        found = (
            chunks.with_messages(answers)
            .select(*BODY, "rest", "answers")
            .mapInArrow(_phrase_rows(bits, group_bits), PACKED)
            .groupBy("lang", "group")
            .applyInArrow(_exact_counts(least), PHRASES)
        )
        path = stage(found, "phrases")
    finally:
        chunks.drop()
    return docs.sparkSession.read.parquet(path), path


def _part(words: str, begin: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def collocations(
    docs: DataFrame,
    least: int = 100,
    share: int = 100,
    top: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The first ``top`` phrases of every language by how much their words belong together.

    A phrase of two to five words that occurs ``least`` times or more is cut after each word;
    its score is the least floor(1000 * a * n / (l * r)), with a, l and r the counts of the
    phrase and of the two parts and n all words of the language. Phrases that lie in a longer
    one with at least ``share`` percent of their count go, whether or not that one stays.

    Null texts and texts without words give nothing, a null language is ``und``, a table
    without frequent phrases gives no row. Repeated rows count each time. Equal scores go by
    count and then by the phrase's bytes. Only the two named columns are read.
    """
    spark = docs.sparkSession
    table, path = phrase_counts(docs, least, text_col, lang_col)
    try:
        known = table.where("words > 0").select("lang", "phrase", "words", F.col("n").alias("a"))
        total = table.where("words = 0").groupBy("lang").agg(F.sum("n").alias("n"))
        phrases = known.where("words > 1").withColumn("parts", F.split("phrase", " "))
        k, words = F.col("k"), F.col("words")
        cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), words - 1))).select(
            "lang",
            "phrase",
            "a",
            "k",
            _part("parts", F.lit(1), k).alias("first"),
            _part("parts", k + 1, words - k).alias("rest"),
        )
        first = known.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
        rest = known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
        whole = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
        scored = (
            cuts.join(first, ["lang", "first"])
            .join(rest, ["lang", "rest"])
            .join(total, "lang")
            .select(
                "lang", "phrase", "a", "k", "l", "r", "n",
                (F.lit(1000).cast("decimal(4,0)") * (whole["a"] * whole["n"])).alias("over"),
                (whole["l"] * whole["r"]).alias("under"),
            )
            .withColumn("score", F.expr("over div under"))
            .groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
        )
        # Between a phrase and a longer one around it lie others whose counts lie between theirs:
        # those with one word more tell enough.
        inner = phrases.where("words > 2").select(
            "lang",
            F.explode(
                F.array(_part("parts", F.lit(1), words - 1), _part("parts", F.lit(2), words - 1))
            ).alias("phrase"),
            "a",
        )
        around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        left = scored.join(around, ["lang", "phrase"], "left").where(
            F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))
        )
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        salted = left.withColumn("salt", F.abs(F.hash("phrase")) % SALTS)
        some = Window.partitionBy("lang", "salt").orderBy(*order)
        near = salted.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
        every = Window.partitionBy("lang").orderBy(*order)
        best = (
            near.withColumn("rank", F.row_number().over(every).cast("long"))
            .where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        )
        out = stage(best, "collocations")
    finally:
        drop_staged(spark, path)
    return spark.read.parquet(out)
