"""Finds where windows of text may repeat and brings those places together.

A window is W successive units (bytes or words) of one document. Every window names one
of its k-unit strings, the one with the least hash (the leftmost of equals), its anchor.
Equal windows have equal anchors at the same offset, so a window can only repeat if its
anchor does. Three exchanges, none of which moves whole texts:

1. Every chunk sends the hashes of its distinct anchors, four bytes each, and in how many
   different texts it has them, to the group of the hash. A group answers with two bits per hash: also seen in another
   chunk or not, and hot or not. A false yes only costs work.
2. Around anchors that repeat, a chunk cuts the text of all windows naming them. Equal cuts
   of a chunk travel once. The cuts of an anchor meet in one group, which finds the windows
   that repeat by the operator's own method. Windows at a hot anchor go one by one, by their
   first and last grams as well, so the contexts of a common string are dealt out.
3. The ranges of repeated windows return to their chunks.

So what a task holds of one anchor is bounded by its distinct cuts and the number of
chunks, not by how often a passage occurs, and a string in very many contexts is split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.chunks import BODY, Chunk, Chunks, chunks_in
from tablewright.llm.hashing import ODD, byte_grams, grams, mix, span_hashes, word_spans

BLOCK_UNITS = 1 << 16
BATCH_BYTES = 2 << 20
GROUP_BYTES = 32 << 20
LEAST_GROUPS = 256
# Different texts around an anchor, added up over chunks, from which on it is hot.
HOT_RUNS = 2000
CUTS = (
    "`group` long, chunk long, lengths binary, anchors binary, ranks binary, copies binary, "
    "places binary, starts binary, ends binary, text binary"
)
RANGES = "chunk long, starts binary, ends binary"


@dataclass(frozen=True)
class Windows:
    """Windows of ``width`` units with anchors of ``gram`` units; units are words or bytes."""

    width: int
    gram: int
    words: bool


class Units:
    """The units of a chunk: where they are in ``body``, and the documents' first ones."""

    def __init__(self, chunk: Chunk, windows: Windows):
        self.windows = windows
        if windows.words:
            texts = [b" ".join(text.split()) for text in chunk.texts()]
            self.body = b" ".join(texts)
            self.data = np.frombuffer(self.body, np.uint8)
            self.starts, self.ends = word_spans(self.data)
            at = np.cumsum([0, *(len(t) + 1 for t in texts)])
            self.edges = np.searchsorted(self.starts, at)
        else:
            self.body = chunk.body
            self.data = np.frombuffer(self.body, np.uint8)
            self.starts = self.ends = None
            self.edges = chunk.edges
        self.n = int(self.edges[-1])

    def gram_hashes(self, a: int, b: int) -> np.ndarray:
        """Hashes of the grams that lie in units a to b."""
        if not self.windows.words:
            return byte_grams(self.data[a:b], self.windows.gram)
        if b - a < self.windows.gram:
            return np.empty(0, np.uint64)
        low, high = int(self.starts[a]), int(self.ends[b - 1])
        words = span_hashes(self.data[low:high], self.starts[a:b] - low, self.ends[a:b] - low)
        return grams(words, self.windows.gram)

    def cut(self, a: int, b: int) -> bytes:
        if self.starts is None:
            return self.body[a:b]
        return self.body[int(self.starts[a]) : int(self.ends[b - 1])]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor hash, its unit, first and end window of every run with one anchor."""
        width, gram = self.windows.width, self.windows.gram
        span = width - gram + 1
        found = []
        lengths = np.diff(self.edges)
        for a in range(0, self.n, BLOCK_UNITS):
            b = min(a + BLOCK_UNITS, self.n)
            hashes = self.gram_hashes(a, min(self.n, b + width - 1))
            if len(hashes) < span:
                continue
            least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
            done = 1
            while done < span:
                step = min(done, span - done)
                least = np.minimum(least[:-step], least[step:])
                done += step
            # A window must end in its document: leave out the last width - 1 units of each.
            lost = np.zeros(len(least) + 1, np.int32)
            first = np.clip(self.edges[1:] - np.minimum(lengths, width - 1) - a, 0, len(least))
            last = np.clip(self.edges[1:] - a, 0, len(least))
            np.add.at(lost, first, 1)
            np.add.at(lost, last, -1)
            ok = np.cumsum(lost[:-1]) == 0
            ok[b - a :] = False
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            anchor = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            turn = np.flatnonzero(np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(at) != 1))))
            end = np.concatenate((turn[1:], [len(at)])) - 1
            found.append((hashes[anchor[turn]], anchor[turn] + a, at[turn] + a, at[end] + a + 1))
        if not found:
            none = np.empty(0, np.int64)
            return np.empty(0, np.uint64), none, none, none
        h, anchor, begin, end = (np.concatenate(x) for x in zip(*found, strict=True))
        # Anchors are least hashes, so their high bits are small: spread them again.
        return mix(h ^ np.uint64(0x9E3779B97F4A7C15)), anchor, begin, end


    def split(
        self, hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each window by itself, with its first and last gram in its name: if all of its other
        grams are common ones, these are not, unless the whole window is."""
        width = self.windows.width
        span = width - self.windows.gram + 1
        names, firsts = [], []
        for name, a, b in zip(hashes, begins.tolist(), ends.tolist(), strict=True):
            seen = self.gram_hashes(a, b + width - 1)
            names.append(mix(name ^ mix(seen[: b - a]) ^ mix(seen[span - 1 :] + ODD)))
            firsts.append(np.arange(a, b))
        first = np.concatenate(firsts)
        return np.concatenate(names), first, first + 1

    def contexts(self, hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct anchors, and how many different texts the runs of each have."""
        stops = ends + self.windows.width - 1
        if self.starts is None:
            low, high = begins, stops
        else:
            low, high = self.starts[begins], self.ends[stops - 1]
        if not len(low):
            return hashes, np.empty(0, np.int64)
        # Told apart by their first and last eight bytes.
        padded = np.concatenate((self.data, np.zeros(8, np.uint8)))
        eight = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
        text = eight[low] * ODD ^ eight[np.maximum(high - 8, low)]
        order = np.lexsort((text, hashes))
        names, text = hashes[order], text[order]
        fresh = np.concatenate(([True], (names[1:] != names[:-1]) | (text[1:] != text[:-1])))[: len(names)]
        return np.unique(names[fresh], return_counts=True)


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(who, which): count[i] successive numbers from first[i] on, for every i."""
    who = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
    return who, first[who] + inside


def _raw(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def _anchor_rows(windows: Windows, n_groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=1).compress
        for chunk, _ in chunks_in(batches):
            units = Units(chunk, windows)
            found, _, begins, ends = units.runs()
            hashes, runs = units.contexts(found, begins, ends)
            runs = runs.clip(max=np.iinfo(np.uint16).max)
            group = hashes % np.uint64(n_groups)
            order = np.argsort(group, kind="stable")
            names, first = np.unique(group[order], return_index=True)
            parts = np.split((hashes >> np.uint64(32))[order], first[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names.astype(np.int64)),
                    pa.array(np.full(len(names), chunk.number, np.int64)),
                    pa.array([_raw(p, "<u4") for p in parts[: len(names)]], pa.binary()),
                    # Nearly all anchors have one run.
                    pa.array([compress(_raw(p, "<u2")) for p in np.split(runs[order], first[1:])[: len(names)]], pa.binary()),
                ],
                names=["group", "chunk", "hashes", "runs"],
            )

    return run


def _seen_elsewhere(hot_runs: int):
    def run(table: pa.Table) -> pa.Table:
        """Two bits per hash of each chunk: whether another chunk has it too, whether it is hot."""
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        lists = [np.frombuffer(h.as_py(), "<u4") for h in table["hashes"]]
        runs = [
            np.frombuffer(decompress(r.as_py(), max_output_size=max(1, 2 * len(h))), "<u2")
            for r, h in zip(table["runs"], lists, strict=True)
        ]
        values, at, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        often = counts > 1
        hot = np.bincount(at, np.concatenate(runs), len(values)) >= hot_runs
        bits, warm = [], []
        for part in lists:
            place = np.searchsorted(values, part)
            bits.append(np.packbits(often[place]).tobytes())
            warm.append(np.packbits(hot[place]).tobytes() if hot[place].any() else b"")
        return pa.table(
            {
                "chunk": table["chunk"],
                "group": table["group"],
                "bits": pa.array(bits, pa.binary()),
                "hot": pa.array(warm, pa.binary()),
            }
        )

    return run


def _cut_rows(windows: Windows, n_groups: int, first_only: bool):
    width = windows.width

    def rows_of(chunk: Chunk, answers: list[dict]) -> pa.RecordBatch | None:
        units = Units(chunk, windows)
        hashes, _, begins, ends = units.runs()
        known, counts = np.unique(hashes, return_counts=True)
        # Two runs of one place (cut at a block's border) count as a repeat; that is harmless.
        flags, hot = counts > 1, np.zeros(len(known), bool)
        group = known % np.uint64(n_groups)
        order = np.argsort(group, kind="stable")
        names, first = np.unique(group[order], return_index=True)
        said = {a["group"]: a for a in answers or ()}
        for name, part in zip(names.tolist(), np.split(order, first[1:]), strict=False):
            if name in said:
                for flag, bits in ((flags, said[name]["bits"]), (hot, said[name]["hot"])):
                    if bits:
                        flag[part] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=len(part)).astype(bool)
        place = np.searchsorted(known, hashes)
        run = flags[place]
        if not run.any():
            return None
        warm = run & hot[place]
        if warm.any():
            parted = units.split(hashes[warm], begins[warm], ends[warm])
            cold = run & ~warm
            hashes, begins, ends = (
                np.concatenate((own[cold], more)) for own, more in zip((hashes, begins, ends), parted, strict=True)
            )
        else:
            hashes, begins, ends = hashes[run], begins[run], ends[run]
        ends = ends + width - 1
        # Equal cuts of the chunk, exactly; equal cuts have equal anchors.
        numbers: dict[bytes, int] = {}
        number = numbers.setdefault
        of_run = np.array(
            [
                number(units.cut(a, b), len(numbers))
                for a, b in zip(begins.tolist(), ends.tolist(), strict=True)
            ]
        )
        texts = list(numbers)
        _, first = np.unique(of_run, return_index=True)
        anchor = hashes[first]
        if first_only:
            ranks = chunk.ranks[np.searchsorted(units.edges, begins, "right") - 1]
            rank = np.full(len(texts), np.iinfo(np.int64).max)
            np.minimum.at(rank, of_run, ranks)
            settled = ranks != rank[of_run]
        else:
            rank = np.bincount(of_run)
            settled = rank[of_run] > 1
        group = (anchor % np.uint64(n_groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        names, at = np.unique(group[order], return_index=True)
        parts = np.split(order, at[1:])
        # Runs in the order of the cuts they belong to.
        place = np.empty(len(texts), np.int64)
        place[order] = np.arange(len(texts))
        by_cut = np.argsort(place[of_run], kind="stable")
        open_, closed = by_cut[~settled[by_cut]], by_cut[settled[by_cut]]
        copies = np.bincount(of_run[open_], minlength=len(texts))
        lengths = np.array([len(t) for t in texts])

        def by_group(values: np.ndarray, kind: str) -> pa.Array:
            return pa.array([_raw(values[p], kind) for p in parts], pa.binary())

        def by_run(values: np.ndarray, runs: np.ndarray) -> pa.Array:
            cut_at = np.searchsorted(group[of_run[runs]], names)
            return pa.array([_raw(v, "<i8") for v in np.split(values[runs], cut_at[1:])], pa.binary())

        return pa.RecordBatch.from_arrays(
            [
                pa.array(names),
                pa.array(np.full(len(names), chunk.number)),
                by_group(lengths, "<i4"),
                by_group(anchor >> np.uint64(32), "<u4"),
                by_group(rank, "<i8"),
                by_group(copies, "<i4"),
                by_run(begins, open_),
                by_run(begins, closed),
                by_run(ends, closed),
                pa.array([b"".join([texts[i] for i in p.tolist()]) for p in parts], pa.binary()),
            ],
            names=["group", "chunk", "lengths", "anchors", "ranks", "copies", "places", "starts", "ends", "text"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, row in chunks_in(batches):
            made = rows_of(chunk, row["answers"])
            if made is not None:
                yield made

    return run


#: Texts of distinct cuts and the smallest document (or number of copies) of each; gives
#: which of their windows repeat, all in a row, and the number of windows of each cut.
Finder = Callable[[list[bytes], np.ndarray], tuple[np.ndarray, np.ndarray]]


def _settle(windows: Windows, find: Finder, first_only: bool):
    width = windows.width

    def run(table: pa.Table) -> pa.Table:
        column = lambda name, kind: [np.frombuffer(v.as_py(), kind) for v in table[name]]
        lengths, anchors, ranks = column("lengths", "<i4"), column("anchors", "<u4"), column("ranks", "<i8")
        row = np.repeat(np.arange(len(lengths)), [len(x) for x in lengths])
        length, anchor, rank = (np.concatenate(x) for x in (lengths, anchors, ranks))
        copy = np.concatenate(column("copies", "<i4")).astype(np.int64)
        place = np.concatenate(column("places", "<i8"))
        place_at = np.cumsum(copy) - copy
        text = b"".join(v.as_py() for v in table["text"])
        end = np.cumsum(length, dtype=np.int64)
        begin = end - length
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def settle(cuts: list[bytes], of: np.ndarray, member: np.ndarray) -> None:
            """Ranges of one batch: its distinct cuts, and which one each member has."""
            if first_only:
                value = np.full(len(cuts), np.iinfo(np.int64).max)
                np.minimum.at(value, of, rank[member])
                whole = rank[member] > value[of]
            else:
                value = np.bincount(of, rank[member], len(cuts)).astype(np.int64)
                whole = value[of] > 1
            repeats, sizes = find(cuts, value)
            # Runs of repeated windows, each within its cut.
            cut = np.repeat(np.arange(len(cuts)), sizes)
            turn = np.diff(cut, prepend=-1, append=len(cuts)) != 0
            before = np.concatenate(([False], repeats)) & ~turn
            after = np.concatenate((repeats, [False])) & ~turn
            inside = np.concatenate((repeats, [False]))
            starts = np.flatnonzero(inside & ~before)
            ends = np.flatnonzero(np.concatenate(([False], repeats)) & ~after)
            zero = np.cumsum(sizes) - sizes
            run_cut = cut[starts]
            run_begin, run_end = starts - zero[run_cut], ends - zero[run_cut] + width - 1
            n_runs = np.bincount(run_cut, minlength=len(cuts))
            run_at = np.cumsum(n_runs) - n_runs
            # Every open copy of a member takes the whole cut, or the runs of its windows.
            who, which = _spread(place_at[member], copy[member])
            at, full = place[which], whole[who]
            found.append((row[member[who[full]]], at[full], at[full] + sizes[of[who[full]]] + width - 1))
            who, at = who[~full], at[~full]
            mine, runs = _spread(run_at[of[who]], n_runs[of[who]])
            found.append((row[member[who[mine]]], at[mine] + run_begin[runs], at[mine] + run_end[runs]))

        # Cuts of one anchor go into one batch.
        order = np.argsort(anchor, kind="stable")
        bounds = np.flatnonzero(np.diff(anchor[order], prepend=-1)).tolist()
        numbers: dict[bytes, int] = {}
        of: list[int] = []
        done = size = 0
        spans = list(zip(begin[order].tolist(), end[order].tolist(), strict=True))
        for a, b in zip(bounds, [*bounds[1:], len(order)], strict=True):
            for x, y in spans[a:b]:
                known = len(numbers)
                of.append(numbers.setdefault(text[x:y], known))
                size += y - x if len(numbers) > known else 0
            if size >= BATCH_BYTES or b == len(order):
                settle(list(numbers), np.array(of, np.int64), order[done:b])
                numbers, of, done, size = {}, [], b, 0
        who, start, stop = (np.concatenate(x) for x in zip(*found, strict=True))
        by_row = np.argsort(who, kind="stable")
        split = np.searchsorted(who[by_row], np.arange(1, len(lengths)))
        merged = [
            pa.array(
                [
                    _raw(np.concatenate((old, new)), "<i8")
                    for old, new in zip(column(name, "<i8"), np.split(values[by_row], split), strict=True)
                ],
                pa.binary(),
            )
            for name, values in (("starts", start), ("ends", stop))
        ]
        return pa.table({"chunk": table["chunk"], "starts": merged[0], "ends": merged[1]})

    return run


def repeated_ranges(chunks: Chunks, windows: Windows, find: Finder, first_only: bool) -> DataFrame:
    """(chunk, ranges): ranges of units, counted from the chunk's start, that repeats cover.

    With ``first_only`` windows of the document with the smallest id stay, else all
    windows that occur twice count. A chunk without repeats has no row.
    """
    # So many that no task gets several times the groups of another by chance.
    n_groups = chunks.groups(GROUP_BYTES, least=LEAST_GROUPS)
    answers = (
        chunks.scan()
        .select(*BODY)
        .mapInArrow(_anchor_rows(windows, n_groups), "`group` long, chunk long, hashes binary, runs binary")
        .groupBy("group")
        .applyInArrow(_seen_elsewhere(HOT_RUNS), "chunk long, `group` long, bits binary, hot binary")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("group", "bits", "hot")).alias("answers"))
    )
    return (
        chunks.with_messages(answers)
        .select(*BODY, "answers")
        .mapInArrow(_cut_rows(windows, n_groups, first_only), CUTS)
        .groupBy("group")
        .applyInArrow(_settle(windows, find, first_only), RANGES)
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("starts", "ends")).alias("ranges"))
    )


def covered(ranges: list[dict] | None, n: int) -> np.ndarray:
    """Which of a chunk's n units the ranges cover."""
    edge = np.zeros(n + 1, np.int32)
    for r in ranges or ():
        np.add.at(edge, np.frombuffer(r["starts"], "<i8"), 1)
        np.add.at(edge, np.frombuffer(r["ends"], "<i8"), -1)
    return np.cumsum(edge[:-1]) > 0
