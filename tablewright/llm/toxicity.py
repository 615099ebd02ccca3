"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are words and the beginnings of words, so that inflected forms share what is
learnt of their stem. The log-odds of a token between toxic and other documents have a
Dirichlet prior from the counts of the whole corpus; what counts is their lower bound.
Documents are counted, not occurrences, because one text may repeat a line many times. One
linear scan of a text finds all maximal segments of the summed scores. How high segments
get in harmless text, by chance, has an exponential tail; its rate and level are measured
on harmless training documents and turn a segment into surprise. A document's surprise,
summed over its significant segments, becomes a probability by a logistic curve. For both,
every training document is scored with the tokens of the other folds, at every size of the sample,
so that chance is seen as in new text; new text is scored with the tokens of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tablewright.llm.hashing import span_hashes
from tablewright.sources.staging import drop_staged, stage

#: Bound of the fit: training documents.
MAX_TRAINING = 200_000
#: Tokens that a task gathers before it adds them up.
MERGE_TOKENS = 500_000
MIN_DOCUMENTS = 2
PRIOR_DOCUMENTS = 10.0
PRIOR_EACH = 0.5
DEVIATIONS = 2.5
LEAST_SCORE = 0.5
DRIFT = 0.05
#: Parts of the training documents, each scored without its own labels.
FOLDS = 4
#: Bins of segment scores for each doubling; a bin keeps its count and its sum.
BINS_A_DOUBLING = 64
#: So many segments of rate one count beside the observed ones.
PRIOR_SEGMENTS = 5.0
#: A segment is significant if so few as high or higher are due to chance in a text.
SIGNIFICANT = 0.01
BATCH_BYTES = 1 << 16

STEMS = (4, 5, 6)
SALTS = (0, 0x9E37, 0x79B9, 0x7F4A)
# Letters and digits, and all bytes of characters beyond ASCII.
IN_WORD = np.zeros(256, bool)
IN_WORD[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True


def blocks_of(texts: Iterator[str | None]) -> Iterator[list[bytes]]:
    """Lower-cased texts, some at a time, so that arrays over their bytes stay small."""
    block, size = [], 0
    for text in texts:
        data = (text or "").lower().encode()
        if block and size + len(data) > BATCH_BYTES:
            yield block
            block, size = [], 0
        block.append(data)
        size += len(data)
    if block:
        yield block


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(words x 4 hashes, bounds of the texts): each word whole and its stems, 0 where it is
    no longer than the stem."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    edge = np.diff(np.concatenate(([0], IN_WORD[data].view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    bounds = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    out = np.zeros((len(starts), 1 + len(STEMS)), np.uint64)
    if len(starts):
        out[:, 0] = span_hashes(data, starts, ends) ^ np.uint64(SALTS[0])
        for column, stem in enumerate(STEMS, 1):
            long = ends - starts > stem
            out[long, column] = span_hashes(data, starts[long], starts[long] + stem) ^ np.uint64(
                SALTS[column]
            )
    return out, bounds


@dataclass(frozen=True)
class Lexicon:
    """Sorted token hashes and their scores, with a small table to rule most tokens out."""

    tokens: np.ndarray
    scores: np.ndarray

    @cached_property
    def seen(self) -> np.ndarray:
        out = np.zeros(1 << 20, bool)
        out[self.tokens >> np.uint64(44)] = True
        return out

    def index(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the tokens, or -1."""
        if not len(self.tokens):
            return np.full(len(hashes), -1)
        out = np.full(len(hashes), -1)
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(44)])
        at = np.searchsorted(self.tokens, hashes[maybe]).clip(max=len(self.tokens) - 1)
        out[maybe] = np.where(self.tokens[at] == hashes[maybe], at, -1)
        return out

    def word_scores(self, hashes: np.ndarray) -> np.ndarray:
        """The highest score of a word's tokens, 0 without any."""
        at = self.index(hashes.ravel())
        if not len(self.scores):
            return np.zeros(len(hashes))
        return np.where(at >= 0, self.scores[at], 0.0).reshape(hashes.shape).max(axis=1, initial=0.0)


def maximal_segments(
    places: list[int], scores: list[float], drift: float
) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, end, score) in one scan.

    Every word between the scoring ones costs ``drift``. Candidates lie on a stack with the
    running sums before and behind them. A new one looks for the last candidate whose sum
    before is lower; if that one's sum behind is lower too, both and what is between
    become one candidate, which is looked at again.
    """
    stack: list[tuple[float, float, int, int]] = []
    total, after = 0.0, 0
    for place, score in zip(places, scores, strict=True):
        total -= drift * (place - after)
        left, first = total, place
        total += score
        after = place + 1
        right, end = total, after
        while True:
            at = len(stack) - 1
            while at >= 0 and stack[at][0] >= left:
                at -= 1
            if at < 0 or stack[at][1] >= right:
                stack.append((left, right, first, end))
                break
            left, first = stack[at][0], stack[at][2]
            del stack[at:]
    return [(first, end, right - left) for left, right, first, end in stack]


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    drift: float
    rate: float
    level: float
    intercept: float
    slope: float

    def segments(self, hashes: np.ndarray) -> list[tuple[int, int, float]]:
        scores = self.lexicon.word_scores(hashes)
        places = np.flatnonzero(scores > 0)
        return maximal_segments(places.tolist(), scores[places].tolist(), self.drift)

    def surprise(self, segments: list[tuple[int, int, float]], n_words: int) -> float:
        """Summed over significant segments: how far the logarithm of the number of segments so
        high that are due to chance lies below that of SIGNIFICANT."""
        chance = self.level + np.log(max(1, n_words)) - np.log(SIGNIFICANT)
        return float(sum(max(0.0, self.rate * score - chance) for _, _, score in segments))

    def probability(self, surprise: float) -> float:
        z = self.intercept + self.slope * np.log1p(surprise)
        return float(1.0 / (1.0 + np.exp(-z)))


def held_out(id_column: Column) -> Column:
    """Whether the CRC-32 of the id as text is divisible by five; a null id counts as blank."""
    return (F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 5) == 0


def training_labels(
    labels: DataFrame, id_col: str, label_col: str, most: int = MAX_TRAINING
) -> DataFrame:
    """(id, toxic): at most ``most`` labelled ids, by hash; 1 where any of an id's rows is 1."""
    return (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .where(~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).cast("long").alias("_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("_toxic"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(most)
    )


def _training_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of labelled documents of each fold with the numbers of toxic and of harmless ones
    that have them; a token may have several rows of a fold."""
    found: list[list[np.ndarray]] = [[] for _ in range(FOLDS)]
    counts: list[list[np.ndarray]] = [[] for _ in range(FOLDS)]
    size = 0

    def merged(fold: int) -> tuple[np.ndarray, np.ndarray]:
        if not found[fold]:
            return np.empty(0, np.uint64), np.empty((0, 2), np.int64)
        known, at = np.unique(np.concatenate(found[fold]), return_inverse=True)
        columns = np.concatenate(counts[fold])
        return known, np.stack([np.bincount(at, c, len(known)).astype(np.int64) for c in columns.T], axis=1)

    def rows(fold: int, known: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(known), 100_000):
            part = n[i : i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(known[i : i + 100_000].view(np.int64)),
                    pa.array(np.full(len(part), fold, np.int32)),
                    pa.array(part[:, 0]),
                    pa.array(part[:, 1]),
                ],
                names=["token", "fold", "toxic", "clean"],
            )

    for batch in batches:
        labels, folds = iter(batch.column(1).to_pylist()), iter(batch.column(2).to_pylist())
        for texts in blocks_of(t.as_py() for t in batch.column(0)):
            hashes, bounds = tokens_of(texts)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = np.unique(hashes[a:b])
                own, fold = own[own != 0], next(folds)
                found[fold].append(own)
                kind = [[1, 0]] if next(labels) == 1 else [[0, 1]]
                counts[fold].append(np.tile(np.array(kind, np.int64), (len(own), 1)))
                size += len(own)
            if size > MERGE_TOKENS:
                together = [merged(fold) for fold in range(FOLDS)]
                size = sum(len(known) for known, _ in together)
                if size > MERGE_TOKENS:
                    for fold, (known, n) in enumerate(together):
                        yield from rows(fold, known, n)
                    found, counts = [[] for _ in range(FOLDS)], [[] for _ in range(FOLDS)]
                else:
                    found, counts = [[known] for known, _ in together], [[n] for _, n in together]
                size = 0
    for fold in range(FOLDS):
        yield from rows(fold, *merged(fold))


def may_reach(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Whether the lower bound of tokens comes up to LEAST_SCORE for any share of the corpus.

    A token's prior lies between PRIOR_EACH and that with PRIOR_DOCUMENTS; the bound is smooth
    in it, so close steps and a small margin miss no token.
    """
    out = np.zeros(len(toxic), bool)
    for prior in np.geomspace(PRIOR_EACH, PRIOR_EACH + PRIOR_DOCUMENTS, 64):
        every = (prior - PRIOR_EACH) / PRIOR_DOCUMENTS
        out |= lower_log_odds(toxic, clean, every, n_toxic, n_clean, 1.0) >= LEAST_SCORE - 0.05
    return out


def _telling(toxic_sizes: list[float], clean_sizes: list[float]):
    """The tokens that may reach LEAST_SCORE in all folds together or without any one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, clean = (
                np.stack([batch.column(first + f).to_numpy().astype(np.float64) for f in range(FOLDS)])
                for first in (1, 1 + FOLDS)
            )
            keep = np.zeros(batch.num_rows, bool)
            for left_out in (None, *range(FOLDS)):
                used = [f for f in range(FOLDS) if f != left_out]
                n_toxic, n_clean = (sum(sizes[f] for f in used) for sizes in (toxic_sizes, clean_sizes))
                own = toxic[used].sum(axis=0)
                keep |= may_reach(own, clean[used].sum(axis=0), n_toxic, n_clean) & (own >= MIN_DOCUMENTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column(0).to_numpy()[keep], pa.int64())], names=["token"]
            )

    return run


#: Documents that a token is counted in: all, then the toxic and the harmless ones of each fold.
COUNTED = ("every", *(f"{kind}{fold}" for fold in range(FOLDS) for kind in ("toxic", "clean")))


def _token_counts(tokens: np.ndarray):
    """Documents with each token, as in COUNTED; all documents at -1 and their words at -2."""
    lexicon = Lexicon(tokens, np.zeros(len(tokens)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, m = len(tokens) + 1, len(COUNTED)
        total = np.zeros((n, m), np.int64)
        words = np.zeros(m, np.int64)
        for batch in batches:
            labels, folds = iter(batch.column(1).to_pylist()), iter(batch.column(2).to_pylist())
            for texts in blocks_of(t.as_py() for t in batch.column(0)):
                hashes, bounds = tokens_of(texts)
                marks = [(next(labels), next(folds)) for _ in texts]
                kind = np.array([0 if y is None else 2 * fold + (1 if y == 1 else 2) for y, fold in marks])
                at = lexicon.index(hashes.ravel())
                document = np.repeat(np.arange(len(texts)), np.diff(bounds) * hashes.shape[1])
                once = np.unique(document[at >= 0] * n + at[at >= 0])
                once = np.concatenate((once, np.arange(len(texts)) * n + n - 1))
                places, times = np.unique(once % n, return_counts=True)
                total[places, 0] += times
                words += np.bincount(kind, np.diff(bounds), m).astype(np.int64)
                own = kind[once // n]
                cells, times = np.unique((once % n * m + own)[own > 0], return_counts=True)
                total.reshape(-1)[cells] += times
        words[0] = words.sum()
        total = np.vstack((total, words))
        names = np.array([*range(len(tokens)), -1, -2])
        some = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[some]), *(pa.array(total[some, c]) for c in range(m))],
            names=["place", *COUNTED],
        )

    return run


def lower_log_odds(
    toxic: np.ndarray, clean: np.ndarray, every: np.ndarray, n_toxic: float, n_clean: float, n_every: float
) -> np.ndarray:
    """Log-odds of tokens between two kinds of documents, less DEVIATIONS standard deviations.

    Each token's prior is its share of the corpus times PRIOR_DOCUMENTS, and PRIOR_EACH.
    """
    prior = PRIOR_EACH + PRIOR_DOCUMENTS * every / max(1.0, n_every)
    a, b = toxic + prior, clean + prior
    no_a = np.maximum(n_toxic + PRIOR_DOCUMENTS + 2 * PRIOR_EACH - a, PRIOR_EACH)
    no_b = np.maximum(n_clean + PRIOR_DOCUMENTS + 2 * PRIOR_EACH - b, PRIOR_EACH)
    odds = np.log(a / no_a) - np.log(b / no_b)
    return odds - DEVIATIONS * np.sqrt(1.0 / a + 1.0 / b + 1.0 / no_a + 1.0 / no_b)


def _training_segments(models: list[Model]):
    """(toxic, words, scores): segments of every training document by the model of its fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            labels, folds = iter(batch.column(1).to_pylist()), iter(batch.column(2).to_pylist())
            for texts in blocks_of(t.as_py() for t in batch.column(0)):
                hashes, bounds = tokens_of(texts)
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    scores = [s for _, _, s in models[next(folds)].segments(hashes[a:b])]
                    rows.append((next(labels), b - a, scores))
            if rows:
                toxic, words, scores = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(toxic, pa.int32()), pa.array(words, pa.int64()), pa.array(scores, pa.list_(pa.float64()))],
                    names=["toxic", "words", "scores"],
                )

    return run


def fit_tail(
    scores: np.ndarray, n_words: int, counts: np.ndarray | None = None, sums: np.ndarray | None = None
) -> tuple[float, float]:
    """(rate, level) of segments in harmless text: n words hold about
    exp(level - rate * score) * n segments of that score or more.

    Above their median the scores of harmless segments are taken as exponential, with
    PRIOR_SEGMENTS of rate one beside them; half a segment is added to the level. With
    ``counts`` and ``sums`` the scores are the lower ends of bins.
    """
    counts = np.ones(len(scores)) if counts is None else counts
    sums = scores if sums is None else sums
    order = np.argsort(scores)
    scores, counts, sums = scores[order], counts[order], sums[order]
    n = counts.sum()
    base = float(scores[np.searchsorted(np.cumsum(counts), n / 2)]) if n else 0.0
    above, total = counts[scores >= base].sum(), sums[scores >= base].sum()
    rate = (above + PRIOR_SEGMENTS) / max(total - base * above + PRIOR_SEGMENTS, 1e-6)
    rate = float(np.clip(rate, 0.05, 5.0))
    return rate, float(np.log((above + 0.5) / max(1, n_words)) + rate * base)


def harmless_tail(segments: DataFrame) -> tuple[float, float]:
    """``fit_tail`` from a histogram: what reaches the driver does not grow with the texts."""
    clean = segments.where("toxic = 0")
    words = clean.agg(F.sum("words").alias("n")).first().n or 0
    histogram = (
        clean.select(F.explode("scores").alias("score"))
        .groupBy(F.floor(F.log2("score") * BINS_A_DOUBLING).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"))
        .collect()
    )
    bins = np.array([row.bin for row in histogram], np.float64)
    counts, sums = (np.array([row[c] for row in histogram], np.float64) for c in ("n", "total"))
    return fit_tail(2.0 ** (bins / BINS_A_DOUBLING), words, counts, sums)


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> tuple[float, float]:
    """Intercept and slope by Newton's method, with a small penalty on both."""
    design = np.column_stack((np.ones(len(x)), x))
    beta = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + penalty * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + penalty * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Learns from the labelled documents that are not held out, and the whole corpus.

    The training sample has at most MAX_TRAINING documents, of equal texts one; the lexicon
    has all tokens of MIN_DOCUMENTS toxic ones whose lower bound reaches LEAST_SCORE; those that
    cannot reach it are left out on the executors. Corpus counts cover all documents. The sample
    falls into FOLDS folds; each one's documents are scored by the lexicon of the others for the
    tail and the curve, and all of them make the lexicon of new text. Without labels of both
    kinds every probability is about the share of toxic labels, near 0 without any.

    The driver holds the tokens that may tell with their counts, the histogram of segment scores
    and one number for each training document, whatever the length of the texts.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    sample = F.broadcast(training_labels(labels, id_col, label_col))
    path = stage(
        named.join(sample, "_id")
        .groupBy(F.xxhash64("_text").alias("h"), F.length("_text").alias("n"))
        .agg(F.min("_id").alias("_id"), F.max("_toxic").alias("_toxic"))
        .select("_id", "_toxic", F.pmod("h", F.lit(FOLDS)).cast("int").alias("_fold")),
        "training",
    )
    sample = F.broadcast(spark.read.parquet(path))
    training = named.join(sample, "_id").dropna(subset=["_text"]).select("_text", "_toxic", "_fold")
    sizes = {(r._toxic, r._fold): float(r.n) for r in training.groupBy("_toxic", "_fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    kinds = [[sizes.get((kind, fold), 0.0) for fold in range(FOLDS)] for kind in (1, 0)]
    top = (
        training.mapInArrow(_training_tokens, "token long, fold int, toxic long, clean long")
        .groupBy("token")
        .agg(
            *(
                F.sum(F.when(F.col("fold") == fold, F.col(kind)).otherwise(0)).alias(f"{kind}{fold}")
                for kind in ("toxic", "clean")
                for fold in range(FOLDS)
            )
        )
        .where(sum((F.col(f"toxic{fold}") for fold in range(FOLDS)), F.lit(0)) >= MIN_DOCUMENTS)
        .mapInArrow(_telling(*kinds), "token long")
        .toPandas()
    )
    tokens = np.sort(top["token"].to_numpy(np.int64).view(np.uint64))
    counted = (
        named.join(sample, "_id", "left")
        .select("_text", "_toxic", "_fold")
        .mapInArrow(_token_counts(tokens), "place long, " + ", ".join(f"{c} long" for c in COUNTED))
        .groupBy("place")
        .agg(*(F.sum(c).alias(c) for c in COUNTED))
        .toPandas()
        .set_index("place")
        .reindex([*range(len(tokens)), -1, -2], fill_value=0)
    )

    def draft(left_out: int | None) -> Model:
        """What the other folds say: their lexicon and drift, without tail and curve."""
        used = [fold for fold in range(FOLDS) if fold != left_out]
        every = counted["every"].to_numpy(np.float64)
        toxic, clean = (
            counted[[f"{kind}{fold}" for fold in used]].sum(axis=1).to_numpy(np.float64)
            for kind in ("toxic", "clean")
        )
        bound = lower_log_odds(toxic[:-2], clean[:-2], every[:-2], toxic[-2], clean[-2], every[-2])
        chosen = (bound >= LEAST_SCORE) & (toxic[:-2] >= MIN_DOCUMENTS)
        # Harmless text must lose more by words than it gains by tokens.
        gain = float((clean[:-2] * bound)[chosen].sum() / max(1.0, clean[-1]))
        return Model(Lexicon(tokens[chosen], bound[chosen]), max(DRIFT, 2.0 * gain), 1.0, 0.0, 0.0, 1.0)

    folds = [draft(fold) for fold in range(FOLDS)]
    scored_path = stage(
        training.mapInArrow(_training_segments(folds), "toxic int, words long, scores array<double>"), "segments"
    )
    segments = spark.read.parquet(scored_path)
    rate, level = harmless_tail(segments)
    chance = F.lit(level - float(np.log(SIGNIFICANT))) + F.log(F.greatest(F.col("words"), F.lit(1)).cast("double"))
    surprise = F.aggregate(
        "scores", F.lit(0.0), lambda total, s: total + F.greatest(F.lit(0.0), F.lit(rate) * s - F.col("_chance"))
    )
    rows = segments.withColumn("_chance", chance).select("toxic", F.log1p(surprise).alias("x")).toPandas()
    drop_staged(spark, scored_path)
    drop_staged(spark, path)
    final = draft(None)
    y = (rows["toxic"].to_numpy() == 1).astype(np.float64)
    if len(np.unique(y)) < 2:
        share = float(y.mean()) if len(y) else 0.0
        odds = np.log((share * len(y) + 0.01) / ((1 - share) * len(y) + 0.01)) if len(y) else -5.0
        return Model(final.lexicon, final.drift, rate, level, float(odds), 0.0)
    intercept, slope = fit_logistic(rows["x"].to_numpy(np.float64), y)
    return Model(final.lexicon, final.drift, rate, level, intercept, max(0.0, slope))


def with_toxicity(docs: DataFrame, model: Model, text_col: str, score_name: str) -> DataFrame:
    """``docs`` with one more column, a struct of the probability and the significant
    segments (first word, end, surprise) of every whole text; null counts as empty."""
    kind = "score double, segments array<struct<first:bigint,end:bigint,surprise:double>>"
    schema = StructType([*docs.schema.fields, StructField(score_name, StructType.fromDDL(kind))])
    arrow = pa.struct(
        [
            ("score", pa.float64()),
            (
                "segments",
                pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("surprise", pa.float64())])),
            ),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for texts in blocks_of(t.as_py() for t in batch.column(batch.schema.names.index(text_col))):
                hashes, bounds = tokens_of(texts)
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    segments = model.segments(hashes[a:b])
                    spans = [
                        {"first": first, "end": end, "surprise": model.surprise([(first, end, s)], b - a)}
                        for first, end, s in segments
                    ]
                    total = sum(s["surprise"] for s in spans)
                    found.append(
                        {"score": model.probability(total), "segments": [s for s in spans if s["surprise"] > 0]}
                    )
            if found:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found, arrow)], names=[*batch.schema.names, score_name]
                )

    return docs.mapInArrow(run, schema)


def scored(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """id_col, held_out, score, predicted and segments of every row of ``docs``.

    A score depends on the text alone. Null and empty texts are scored as texts without
    words. A null id counts as held out; repeated rows are scored alike. An empty table
    gives no rows; other columns are not looked at.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    found = with_toxicity(docs.select(id_col, text_col), model, text_col, "_found")
    return found.select(
        id_col,
        held_out(F.col(id_col)).alias("held_out"),
        F.col("_found.score").alias("score"),
        (F.col("_found.score") >= 0.5).cast("int").alias("predicted"),
        F.col("_found.segments").alias("segments"),
    )


def harmless(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """The rows of ``docs`` whose score is below a half, with their columns as they were."""
    model = fit(docs, labels, id_col, text_col, label_col)
    name = f"_toxicity_{uuid4().hex}"
    return with_toxicity(docs, model, text_col, name).where(F.col(name)["score"] < 0.5).drop(name)
