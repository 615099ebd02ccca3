import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tablewright.llm import toxicity
from tablewright.llm.toxicity import fit_logistic, fit_tail, harmless, maximal_segments, scored, tokens_of
from tests.llm.support import hard_documents, sentence, table


def plain_segments(values):
    """Maximal segments by their definition: the best segment, then those left and right of it."""
    best, at = 0.0, None
    for i in range(len(values)):
        total = 0.0
        for j in range(i, len(values)):
            total += values[j]
            if total > best + 1e-12:
                best, at = total, (i, j + 1)
    if at is None:
        return []
    a, b = at
    left = plain_segments(values[:a])
    right = [(i + b, j + b, s) for i, j, s in plain_segments(values[b:])]
    return [*left, (a, b, best), *right]


def test_segments_against_definition():
    rng = random.Random(7)
    for _ in range(200):
        n = rng.randrange(1, 30)
        scores = [rng.choice([0, 0, 0, 1.37, 0.5, 2.21]) * rng.uniform(0.5, 1.5) for _ in range(n)]
        places = [i for i, s in enumerate(scores) if s > 0]
        drift = 0.31
        values = [s if s > 0 else -drift for s in scores]
        got = maximal_segments(places, [scores[i] for i in places], drift)
        expected = plain_segments(values)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for *_, s in got], [s for *_, s in expected])


def test_tokens_are_words_and_stems():
    hashes, bounds = tokens_of([b"idiotic idiots, idiot!", b"", "größe".encode()])
    assert bounds.tolist() == [0, 3, 3, 4]
    assert len(set(hashes[:3, 2].tolist())) == 2  # five bytes of the first two, none of the third
    assert hashes[0, 2] == hashes[1, 2] != 0
    assert hashes[2, 2] == 0
    assert len(set(hashes[:3, 0].tolist())) == 3


def test_tail_and_curve():
    rng = np.random.default_rng(1)
    rate, level = fit_tail(rng.exponential(0.5, 4000), 400_000)
    assert rate == pytest.approx(2.0, rel=0.1)
    assert np.exp(level) * 400_000 == pytest.approx(4000, rel=0.2)
    x = rng.normal(size=5000)
    y = (rng.random(5000) < 1 / (1 + np.exp(-(1.0 + 2.0 * x)))).astype(float)
    intercept, slope = fit_logistic(x, y)
    assert intercept == pytest.approx(1.0, abs=0.2) and slope == pytest.approx(2.0, abs=0.3)


def test_tail_from_a_histogram(spark):
    rng = np.random.default_rng(2)
    scores = rng.exponential(0.5, 3000) + 0.01
    rows = [(0, 100, part.tolist()) for part in np.array_split(scores, 40)] + [(1, 50, [99.0]), (0, 7, [])]
    segments = spark.createDataFrame(rows, "toxic int, words long, scores array<double>")
    rate, level = toxicity.harmless_tail(segments)
    expected = fit_tail(scores, 4007)
    assert rate == pytest.approx(expected[0], rel=0.03) and level == pytest.approx(expected[1], abs=0.05)


def test_no_switch_at_any_size():
    """One segment more or less changes the tail a little, from none on."""
    rng = np.random.default_rng(3)
    scores = rng.exponential(0.4, 60)
    fits = [fit_tail(scores[:n], 10_000) for n in range(61)]
    assert fits[0] == (1.0, pytest.approx(np.log(0.5 / 10_000)))
    assert max(abs(np.log(a[0] / b[0])) for a, b in zip(fits[:-1], fits[1:])) < 0.35


def test_few_labels_are_all_learnt_from(spark):
    """Seven toxic documents: too few to set some apart, enough for folds."""
    rng = random.Random(8)
    rows = [(i, sentence(rng, 40) + (" vilest rotter" if i < 16 else "")) for i in range(160)]
    known = [i for i in range(160) if zlib.crc32(str(i).encode()) % 5]
    toxic = [i for i in known if i < 16][:7]
    labels = [(i, int(i in toxic)) for i in known if i in toxic or i >= 16]
    got = {r.doc_id: r.predicted for r in scored(table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert [got[i] for i in range(160)] == [int(i < 16) for i in range(160)]


BAD = ("scoundrelly", "scoundrelish", "scoundreled", "vilest", "rotter", "rotters")


def corpus(seed, n):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.randrange(20, 120)).split()
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, int(toxic)))
    return rows, labels, [any(w in BAD for w in text.split()) for _, text in rows]


def test_held_out_accuracy(spark):
    rows, labels, truth = corpus(3, 900)
    got = scored(table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    right = [r.predicted == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(right) > 0.97
    text = dict(rows)
    for r in got:
        if r.predicted:
            words = text[r.doc_id].split()
            assert any(w in BAD for s in r.segments for w in words[s.first : s.end])


def test_no_token_that_tells_is_left_out(spark):
    rng = np.random.default_rng(5)
    toxic = rng.integers(2, 60, 4000).astype(float)
    clean, every = rng.integers(0, 3000, 4000).astype(float), rng.integers(0, 10**6, 4000).astype(float)
    reached = toxicity.lower_log_odds(toxic, clean, every, 11e3, 135e3, 1e6) >= toxicity.LEAST_SCORE
    assert reached.any() and not (reached & ~toxicity.may_reach(toxic, clean, 11e3, 135e3)).any()
    # More stems and words in toxic texts than 65536, each more frequent than the one that tells.
    filler = " ".join(f"w{i:06d}q{i % 977}" for i in range(70_000))
    rows = [(i * 5 + 1, filler + f" n{i}" + (" zyxwv" if i % 2 else "")) for i in range(32)]
    rows += [(2000 + i, f"harmless words number {i} zzz") for i in range(400)]
    toxic_ids = {i * 5 + 1 for i in range(32)}
    labels = [(i, int(i in toxic_ids)) for i, _ in rows]
    model = toxicity.fit(table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    hashes, _ = tokens_of([b"zyxwv"])
    assert model.lexicon.word_scores(hashes)[0] > 0


def test_all_segments_of_a_long_text_count():
    hashes, _ = tokens_of([b"rotter"])
    model = toxicity.Model(toxicity.Lexicon(hashes[0, :1], np.ones(1)), 0.5, 1.0, 0.0, 0.0, 1.0)
    text = ("rotter and then some harmless words " * 300).strip()
    batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array([0], pa.int32()), pa.array([0], pa.int32())], names=["_text", "_toxic", "_fold"])
    (rows,) = toxicity._training_segments([model])(iter([batch]))
    assert rows.column(2).to_pylist() == [[1.0] * 300]


def test_held_out_labels_are_not_learnt(spark):
    rows, labels, _ = corpus(4, 300)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (
        {r.doc_id: r.score for r in scored(table(spark, rows), spark.createDataFrame(x, "doc_id long, toxic int")).collect()}
        for x in (labels, turned)
    )
    assert a == b


def test_hard_documents_and_no_labels(spark):
    rows = [*hard_documents(), (None, "a b c"), (3, "again")]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    nulls = spark.createDataFrame([(None, 1), (4, None)], "doc_id long, toxic int")
    one = spark.createDataFrame([(i, 0) for i in range(60)], "doc_id long, toxic int")
    for labels in (none, nulls, one):
        got = scored(table(spark, rows), labels).collect()
        assert len(got) == len(rows) and all(r.predicted == 0 for r in got)
    assert scored(table(spark, []), one).collect() == []


def test_harmless_keeps_rows_whole(spark):
    rows, labels, truth = corpus(5, 600)
    docs = table(spark, rows)
    kept = harmless(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert kept.schema == docs.schema
    whole = {r.doc_id: r for r in docs.collect()}
    got = kept.collect()
    assert all(whole[r.doc_id] == r for r in got)
    left = {r.doc_id for r in got}
    assert np.mean([truth[i] != (i in left) for i in range(len(rows))]) > 0.97
    assert toxicity.MAX_TRAINING == 200_000
