import hashlib
import random
from collections import Counter

import numpy as np

from tablewright.llm.suffix_tree import GROUP_SUFFIXES, WIDTH, cleaned_documents, find_repeats, prefix_groups, without_repeats
from tests.llm.support import hard_documents, removed_words, sentence, table


def test_groups_hold_all_repeated_prefixes():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 4, 500)
    suffixes = np.arange(480)
    for bound in (3, 20, 1000):
        groups = list(prefix_groups(words, suffixes, 10, bound))
        place = {}
        for number, (length, group) in enumerate(groups):
            assert len(group) <= bound or length == 10
            assert len({tuple(words[i : i + length]) for i in group.tolist()}) == 1
            place.update({i: number for i in group.tolist()})
        heads = Counter(tuple(words[i : i + 10]) for i in range(480))
        for i in range(480):
            head = tuple(words[i : i + 10])
            if heads[head] > 1:
                assert place[i] == place[next(j for j in range(480) if tuple(words[j : j + 10]) == head)]


def test_cuts_against_plain_search():
    rng = random.Random(3)
    parts = [" ".join(rng.choice("abcde") for _ in range(9)) for _ in range(6)]
    cuts = list({" ".join(rng.choice(parts) for _ in range(rng.randrange(4, 8))).encode() for _ in range(40)})
    count = Counter(tuple(c.split()[i : i + 35]) for c in cuts for i in range(len(c.split()) - 34))
    for bound in (2, 10**6):
        repeats, sizes = find_repeats(35, bound)(cuts, np.ones(len(cuts)))
        for cut, found in zip(cuts, np.split(repeats, np.cumsum(sizes)[:-1]), strict=True):
            words = cut.split()
            assert found.tolist() == [count[tuple(words[i : i + 35])] > 1 for i in range(len(words) - 34)]


def held_against_plain_search(spark, rows, **more):
    got = sorted(
        (r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256)
        for r in without_repeats(table(spark, rows), **more).collect()
    )
    expected = []
    for key, texts in removed_words(rows).items():
        for words, gone in texts:
            kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
            expected.append((key or 0, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(expected)


def test_hard_documents(spark):
    held_against_plain_search(spark, hard_documents(), chunk_bytes=4000)


def test_blocks_batches_and_ids(spark, monkeypatch):
    from tablewright.llm import passages

    monkeypatch.setattr(passages, "BLOCK_UNITS", 90)
    monkeypatch.setattr(passages, "BATCH_BYTES", 500)
    rows = hard_documents(2)
    rows += [(None, rows[5][1]), (None, None), (3, rows[9][1])]
    held_against_plain_search(spark, rows, chunk_bytes=30_000)


def test_one_string_in_many_contexts(spark, monkeypatch):
    from tablewright.llm import passages

    rng = random.Random(9)
    hot = " ".join(f"common{i}" for i in range(14))
    rows = [(i, sentence(rng, 30) + " " + hot + " " + sentence(rng, 30)) for i in range(90)]
    rows += [(500 + i, rows[i][1]) for i in range(0, 90, 9)]
    monkeypatch.setattr(passages, "HOT_RUNS", 20)
    monkeypatch.setattr(passages, "GROUP_BYTES", 1 << 9)
    held_against_plain_search(spark, rows, chunk_bytes=9000)


def test_prefixes_part_suffixes_with_production_bounds():
    """More suffixes than a group may have: prefixes of words split them."""
    rng = np.random.default_rng(4)
    words = rng.integers(0, 3000, 900_000)
    suffixes = np.arange(len(words) - WIDTH)
    groups = list(prefix_groups(words, suffixes, WIDTH, GROUP_SUFFIXES))
    assert len(groups) > 3 and max(len(group) for _, group in groups) <= GROUP_SUFFIXES


def test_documents_keep_their_columns(spark):
    rows = hard_documents()
    docs = table(spark, rows)
    got = cleaned_documents(docs, chars_col="missing", chunk_bytes=5000)
    assert got.schema == docs.schema
    whole = {r.doc_id: r.asDict() for r in docs.collect()}
    expected = removed_words(rows)
    for r in got.collect():
        [(words, gone)] = expected[r.doc_id]
        text = whole[r.doc_id]["text"] or ""
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        assert r.asDict() == whole[r.doc_id] | {"text": kept if any(gone) else text}


def test_number_of_characters_follows(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"é {passage}", 7), (2, passage, None), (3, "short", 5)]
    got = cleaned_documents(spark.createDataFrame(rows, "doc_id long, text string, n_chars long"))
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got.collect()) == [(1, "é", 1), (2, "", 0), (3, "short", 5)]


def test_no_rows(spark):
    assert without_repeats(table(spark, [])).collect() == []
    assert cleaned_documents(table(spark, [])).collect() == []
