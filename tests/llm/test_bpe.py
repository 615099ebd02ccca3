import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tablewright.llm import bpe
from tests.llm.support import hard_documents, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoding(bpe.load_ranks(RANKS), public_tokenizers.PATTERN)


def texts(seed):
    rng = random.Random(seed)
    kinds = ["a", "don't we'll ", " ", "  ", "\n", "\t ", " ", "é", "東", "😀", "12", "...", "'s", "x y"]
    return ["".join(rng.choice(kinds) for _ in range(rng.randrange(400))) for _ in range(60)]


def test_pieces_have_the_ids_of_the_whole(encoder, monkeypatch):
    for limit in (1, 7, 50):
        monkeypatch.setattr(bpe, "PIECE_CHARS", limit)
        for text in texts(limit):
            parts = list(bpe.safe_pieces(text, limit))
            assert "".join(parts) == text and all(parts)
            ids = [i for p in parts for i in encoder.encode_ordinary(p)]
            assert ids == encoder.encode_ordinary(text)
            assert bpe.decode(encoder, np.array(ids, "<u4"), step=3) == text.encode()


def test_round_trip(spark, encoder):
    rows = [*hard_documents(), (None, "null id"), (3, "again"), *enumerate(texts(9), start=500)]
    rows.append((900, "long " * 40_000))
    got = sorted(
        tuple(r) for r in bpe.round_trip(table(spark, rows), RANKS, public_tokenizers.PATTERN).na.fill(-1, "doc_id").collect()
    )
    expected = []
    for key, text in rows:
        ids = np.array(encoder.encode_ordinary(text or ""), "<u4")
        expected.append(
            (
                -1 if key is None else key,
                len(ids),
                hashlib.sha256(ids.tobytes()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest(),
            )
        )
    assert got == sorted(expected)


def test_ids_and_bytes(spark, encoder):
    docs = table(spark, [(1, "naïve 東京"), (2, None), (3, "")]).select("doc_id", "text", "key")
    ids = bpe.token_ids(docs, RANKS, public_tokenizers.PATTERN)
    assert ids.columns == ["doc_id", "key", "ids"]
    back = bpe.decoded_bytes(ids, RANKS, public_tokenizers.PATTERN)
    got = {r.doc_id: bytes(r.body).decode() for r in back.collect()}
    assert got == {1: "naïve 東京", 2: "", 3: ""}
    # A part of a character's bytes decodes as it is.
    first = ids.where("doc_id = 1").select(F.slice("ids", 1, 3).alias("ids"))
    [row] = bpe.decoded_bytes(first, RANKS, public_tokenizers.PATTERN).collect()
    assert "naïve 東京".encode().startswith(bytes(row.body))


def test_no_rows(spark):
    assert bpe.round_trip(table(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []
