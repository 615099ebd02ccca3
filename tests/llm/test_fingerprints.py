import hashlib
import random

import numpy as np

from tablewright.llm.fingerprints import (
    as_text,
    containment,
    edit_pairs,
    fingerprints,
    from_text,
    likeness,
    merged,
    sketch,
)
from tests.llm.support import hard_documents, sentence, table


def test_containment_is_estimated():
    rng = random.Random(1)
    part = sentence(rng, 3000).encode()
    whole = part + b" " + sentence(rng, 30_000).encode()
    other = sentence(rng, 3000).encode()
    a, b, c = sketch(part), sketch(whole), sketch(other)
    assert containment(a, b) > 0.99 and likeness(a, b) > 0.99
    assert abs(containment(b, a) - len(part) / len(whole)) < 0.04
    half = sketch(part[: len(part) // 2] + other[len(other) // 2 :])
    assert abs(containment(half, a) - 0.5) < 0.08
    assert abs(len(a.hashes) - len(part) / 8) < len(part) / 50


def test_sketches_merge():
    rng = random.Random(2)
    left, right = sentence(rng, 500).encode(), sentence(rng, 900).encode()
    both = merged(sketch(left), sketch(right))
    joined = sketch(left + right)
    # Only shingles across the seam are new.
    kept = set(both.hashes.tolist())
    assert kept <= set(joined.hashes.tolist()) and len(joined.hashes) - len(kept) <= 15
    for one in (both, joined, sketch(b"short"), sketch(b"")):
        again = from_text(as_text(one))
        assert (again.hashes == one.hashes).all()
        assert (again.one_in, again.whole) == (one.one_in, one.whole)


def test_alike_at_the_ends():
    none, some, other = sketch(b""), sketch(b"hello there"), sketch(b"goodbye")
    assert [likeness(*pair) for pair in ((none, none), (none, some), (some, some), (some, other))] == [1, 0, 1, 0]
    assert none.hashes.tolist() == []
    # All shingles of one are in the other, but the texts differ.
    assert likeness(sketch(b"abc" * 40), sketch(b"abc" * 50)) == 0.75
    assert likeness(sketch(b"a longer text with a tail"), sketch(b"a longer text with a tail, and more")) < 1


def exact_likeness(a, b):
    x, y = ({t[i : i + 16] for i in range(max(1, len(t) - 15))} if t else set() for t in (a.encode(), b.encode()))
    return len(x & y) / min(len(x), len(y)) if x and y else float(a == b)


def test_against_exact_containment(spark):
    """All documents of a table, short and long: the estimate and its error."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(text, reverse=True)
    errors, ones = [], 0
    for r in edit_pairs(docs).collect():
        own, following = text[r.doc_id], text[order[(order.index(r.doc_id) + 1) % len(order)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        for got, other in ((r.near_edited, edited), (r.near_next, following)):
            errors.append(abs(got - exact_likeness(own, other)))
            ones += got == 1.0 and own != other
    assert ones == 0
    assert np.mean(errors) < 0.03 and np.quantile(errors, 0.95) < 0.1


def held_against_plain_walk(spark, rows, **more):
    got = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in edit_pairs(table(spark, rows), **more).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    assert len(got) == len(rows)
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[(key, len(text), hashlib.sha256(edited.encode()).hexdigest())]
        a, b, c = (sketch(t.encode()) for t in (text, edited, following))
        assert (r.fingerprint, r.edited_fingerprint) == (as_text(a), as_text(b))
        assert (r.near_edited, r.near_next) == (likeness(a, b), likeness(a, c))


def test_hard_documents(spark):
    held_against_plain_walk(spark, hard_documents())
    held_against_plain_walk(spark, [*hard_documents(), (None, "nobody"), (3, "again"), (40, "one")], part_bytes=3000)


def test_one_document(spark):
    held_against_plain_walk(spark, [(5, "a text that follows itself")])


def test_no_rows(spark):
    assert edit_pairs(table(spark, [])).collect() == []
    assert fingerprints(table(spark, [])).collect() == []


def test_equal_texts(spark):
    got = fingerprints(table(spark, [(1, "x" * 99), (2, "x" * 99), (3, None)])).collect()
    found = {r.doc_id: (r.n_chars, r.fingerprint) for r in got}
    assert found[1] == found[2] and found[3] == (0, as_text(sketch(b"")))
