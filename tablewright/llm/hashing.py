"""64-bit hashes of byte, word and shingle windows, vectorised over a block of text."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xFF51AFD7ED558CCD)
MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
STEP = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)

# So much text at a time that arrays over its bytes stay in a core's cache.
BLOCK_BYTES = 1 << 16

# The separators of the contract's words: space and 0x09 to 0x0D, as bytes.split() has them.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of x over all bits; one to one."""
    x = (x ^ (x >> np.uint64(33))) * MIX1
    x ^= x >> np.uint64(33)
    x *= MIX2
    x ^= x >> np.uint64(33)
    return x


_KNOWN_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers, kept for the next block of text."""
    if len(_KNOWN_POWERS.get(base, ())) < n:
        out = np.full(max(n, 1 << 17), np.uint64(base), dtype=np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        _KNOWN_POWERS[base] = out
    return _KNOWN_POWERS[base][:n]


def byte_grams(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes at every position, k from 8 to 16: two words read at any offset."""
    n = len(data) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    data = np.ascontiguousarray(data)
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data.data, strides=(1,))
    head = words[:n] * ODD
    head ^= head >> np.uint64(32)
    head += words[k - 8 : k - 8 + n] * MIX1
    return mix(head)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word."""
    edge = np.diff(np.concatenate(([1], SPACES[data].view(np.int8), [1])))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every byte span, by differences of one running sum."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * _powers(STEP, len(data)), out=sums[1:])
    back = _powers(pow(STEP, -1, 2**64), len(data) + 1)
    spans = (sums[ends] - sums[starts]) * back[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * ODD)


def grams(items: np.ndarray, k: int) -> np.ndarray:
    """Hash of k successive items at every position."""
    n = len(items) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = items[:n].copy()
    for i in range(1, k):
        out *= MIX2
        out ^= out >> np.uint64(29)
        out += items[i : i + n]
    return mix(out)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of every text.

    A text with fewer than k words gives its whole word sequence as one shingle, a text
    without words the empty set.
    """
    out: list[np.ndarray] = []
    some: list[bytes] = []
    size = 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= BLOCK_BYTES:
            out += _shingle_sets(some, k)
            some, size = [], 0
    return out + _shingle_sets(some, k)


def _shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, ends = word_spans(data)
    words = span_hashes(data, starts, ends) if len(starts) else np.empty(0, np.uint64)
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(starts, edges).tolist()
    rolled = grams(words, k)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a > k:
            own = np.sort(rolled[a : b - k + 1])
            fresh = own[1:] != own[:-1]
            out.append(own if fresh.all() else own[np.concatenate(([True], fresh))])
        elif b - a == k:
            out.append(rolled[a : a + 1])
        elif b > a:
            out.append(mix(grams(words[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
