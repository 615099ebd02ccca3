import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablewright.llm import packing
from tablewright.llm.bpe import encode, encoding, load_vocabulary
from tablewright.llm.packing import Places, pack_lengths, packed
from tests.llm.support import hard_documents, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 40), max_size=25))
def test_patterns_hold_every_piece(histogram):
    patterns = pack_lengths(histogram, 64)
    placed = Counter()
    for lengths, count in patterns:
        assert sum(lengths) <= 64 and count > 0
        for length in lengths:
            placed[length] += count
    assert placed == Counter(histogram)
    places = Places(patterns, 5)
    used = defaultdict(list)
    for length, n in histogram.items():
        sequence, offset = places.of(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            used[s].append((o, length))
    assert sorted(used) == list(range(5, 5 + sum(count for _, count in patterns)))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_little_padding():
    rng = random.Random(1)
    histogram = Counter(rng.randrange(1, 1024) for _ in range(20_000))
    n = sum(count for _, count in pack_lengths(histogram, 1024))
    assert sum(k * v for k, v in histogram.items()) / (n * 1024) > 0.99


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(VOCABULARY)
    made.encode_special_tokens = True
    return made


def test_ids_are_those_of_tokenizers(tokenizer):
    encoder = encoding(load_vocabulary(VOCABULARY), public_tokenizers.PATTERN)
    rng = random.Random(2)
    texts = [t or "" for _, t in hard_documents()] + ["<|endoftext|> a", "I'm  we'll\n\n\tx 12½   y\u0085z"]
    letters = [chr(rng.choice([rng.randrange(0x250), rng.randrange(0xD800), rng.randrange(0x10000, 0x20000)])) for _ in range(4000)]
    texts += ["".join(rng.choice(letters + [" "] * 400) for _ in range(200)) for _ in range(100)]
    for text in texts:
        assert encode(encoder, text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def held_against_tokenizer(spark, tokenizer, rows, capacity=1024, **more):
    got = packed(table(spark, rows), VOCABULARY, public_tokenizers.PATTERN, capacity, **more).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = defaultdict(list)
    for key, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for start in range(0, len(ids), capacity):
            part = ids[start : start + capacity]
            expected[key].append((start, len(part), zlib.crc32(part.tobytes()), len(ids)))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_hard_documents(spark, tokenizer):
    held_against_tokenizer(spark, tokenizer, [*hard_documents(), (None, "null id"), (3, "again"), (None, None)])


def test_added_tokens(spark):
    rows = [
        (1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>"), (3, "x<|endoftext|>y  <|endoftext|>  z"),
        (4, "<|endoftext|"), (5, "word " * 20_000 + "<|endoftext|>" + " word" * 20_000),
    ]
    held_against_tokenizer(spark, Tokenizer.from_file(VOCABULARY), rows)


def test_hot_lengths(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SPREAD_ROWS", 3)
    monkeypatch.setattr(packing, "LEAST_SPREAD", 2)
    rows = [(i, "one two three") for i in range(150)] + [(200 + i, "word " * i) for i in range(90)]
    held_against_tokenizer(spark, tokenizer, rows, capacity=16)


def test_no_rows(spark):
    assert packed(table(spark, []), VOCABULARY, public_tokenizers.PATTERN).collect() == []
