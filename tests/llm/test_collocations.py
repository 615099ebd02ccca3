import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm import collocations as C
from tablewright.llm.collocations import MisraGries, collocations, expand, phrase_counts, squeeze
from tablewright.sources.staging import drop_staged
from tests.llm.support import CLASHES, hard_texts


def plain_grams(rows):
    grams, total = Counter(), Counter()
    upper = {c: c + 32 for c in range(65, 91)}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(upper)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for m in range(1, 6):
                grams.update((lang, *words[i : i + m]) for i in range(len(words) - m + 1))
    return grams, total


def plain(rows, least, share, top):
    grams, total = plain_grams(rows)
    often = {g: a for g, a in grams.items() if a >= least}
    found = []
    for (lang, *words), a in often.items():
        if len(words) < 2:
            continue
        if any(
            g[0] == lang and len(g) > len(words) + 1 and 100 * b >= share * a
            and any(list(g[i : i + len(words)]) == words for i in range(1, len(g) - len(words) + 1))
            for g, b in often.items()
        ):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = grams[lang, *words[:k]], grams[lang, *words[k:]]
            cuts.append((floor(Fraction(1000 * a * total[lang], left * right)), k, left, right))
        score, _, left, right = min(cuts)
        found.append((lang, score, a, " ".join(words), left, right, total[lang]))
    out = []
    for lang in sorted({f[0] for f in found}):
        mine = sorted((f for f in found if f[0] == lang), key=lambda f: (-f[1], -f[2], f[3].encode()))
        out += [(f[0], i, f[3], f[2], f[4], f[5], f[6], f[1]) for i, f in enumerate(mine[:top], 1)]
    return sorted(out)


def corpus():
    rng = random.Random(5)
    texts = hard_texts(5)
    texts += ["New York, new YORK\tnew york; in \x0bnew  york!", "a a a a a a. a a", "naïve Ça naïve Ça\rÇa"] * 4
    texts += [" ".join(rng.choice(("red", "fox", "den", "tail")) for _ in range(60)) for _ in range(15)]
    # One passage in a third of all rows.
    texts += ["the quick brown fox jumps over it"] * (len(texts) // 2)
    return [(rng.choice(("en", "en", "de", None, "und", "")), t) for t in texts]


def frame(spark, rows):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("lang", "text", *CLASHES, "phrase", "words", "n")])
    full = [(*row, *["x" if i % 2 else None] * (len(CLASHES) + 3)) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, schema).repartition(3)


@pytest.mark.parametrize(("least", "share", "top"), [(4, 100, 2000), (3, 60, 7), (10**6, 100, 5)])
def test_against_plain_python(spark, monkeypatch, least, share, top):
    monkeypatch.setattr(C, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(C, "PARTITION_BYTES", 30_000)
    monkeypatch.setattr(C, "FOLD_ENTRIES", 500)
    rows = corpus()
    found = collocations(frame(spark, rows), least, share, top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {f.dataType for f in found.schema if f.name not in ("lang", "phrase")} == {T.LongType()}
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, least, share, top)


def test_counts_do_not_depend_on_hashes(spark, monkeypatch):
    """With keys of very few bits nearly every n-gram is proposed; the counts stay exact."""
    monkeypatch.setattr(C, "key_bits", lambda n_bytes: 6)
    rows = corpus()
    table, path = phrase_counts(frame(spark, rows), 5)
    found = {(r.lang, r.phrase): r.n for r in table.where("words > 0").collect()}
    totals = Counter()
    for r in table.where("words = 0").collect():
        totals[r.lang] += r.n
    drop_staged(spark, path)
    grams, total = plain_grams(rows)
    assert found == {(g[0], " ".join(g[1:])): a for g, a in grams.items() if a >= 5}
    assert +totals == +total


def test_same_hash_of_other_words():
    ids = np.array([2, 3, 2, 4, 2, 3, 1], np.int32)
    found = C._same_words(ids, 2, np.array([0, 2, 4]), np.zeros(3, np.uint64), np.array([5, 5, 5]))
    assert sorted(found) == [((0, 5), 2), ((2, 5), 1)]


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_summaries_lose_no_frequent_key(parts):
    """Any order of merging: nothing that occurs mass / capacity times or more is lost."""
    rng = np.random.default_rng(parts)
    keys = np.concatenate([rng.zipf(1.3, 20_000) % 5000, np.full(9000, 77)]).astype(np.uint64)
    rng.shuffle(keys)
    least = 120
    summary = MisraGries(len(keys) // least + 1)
    for some in np.array_split(keys, parts):
        summary.merge(*np.unique(some, return_counts=True))
    names, counts = np.unique(keys, return_counts=True)
    assert summary.taken < least and len(summary.keys) <= summary.capacity
    assert set(names[counts >= least].tolist()) <= set(summary.at_least(least).tolist())
    assert (counts[np.searchsorted(names, summary.keys)] >= summary.counts).all()


def test_packed_numbers_round_trip():
    for values in ([], [0], [1, 255, 256, 2**40, 2**64 - 1]):
        values = np.array(values, np.uint64)
        assert expand(squeeze(values), len(values)).tolist() == values.tolist()


def test_no_rows_and_no_words(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations(empty, 1).count() == 0
    blank = spark.createDataFrame([(None, None), ("", "en"), (" .,; \t", "en"), ("word", "en")], "text string, lang string")
    assert collocations(blank, 1).count() == 0
    one = spark.createDataFrame([("a b", None)], "text string, lang string")
    assert [tuple(r) for r in collocations(one, 1).collect()] == [("und", 1, "a b", 1, 1, 1, 2, 2000)]


def test_products_beyond_64_bits(spark):
    """The score's products are taken as 38-digit decimals."""
    row = spark.range(1).select(
        F.expr("cast(1000 as decimal(4,0)) * (cast(9000000000000 as decimal(19,0)) * cast(8000000000001 as decimal(19,0)))").alias("over"),
        F.expr("cast(9000000000000 as decimal(19,0)) * cast(7000000000000 as decimal(19,0))").alias("under"),
    ).selectExpr("over div under as q").first()
    assert row.q == 1000 * 9000000000000 * 8000000000001 // (9000000000000 * 7000000000000)
