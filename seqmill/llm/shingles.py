"""Whole texts to sets of word shingles, hashed to 64 bits, a chunk of texts at a time."""

from __future__ import annotations

import numpy as np

#: Words are runs of bytes that are none of these.
BLANKS = b" \t\n\x0b\x0c\r"
#: Bytes that are hashed at once, up to the end of a word.
SEGMENT = 1 << 19
_U = np.uint64
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE_PLAIN = _BYTE.copy()
_BYTE[65:91] = _BYTE[97:123]  # A-Z are lower-cased, other letters are not
_BLANK = np.isin(np.arange(256), np.frombuffer(BLANKS, np.uint8))
_P = _U(0x9E3779B97F4A7C15)
_P_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, p in enumerate((_P, _P_INVERSE)):
            x = np.full(n, p, np.uint64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text position of every word."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    hashes, starts, a = [], [], 0
    while a < len(data):
        b = a + SEGMENT
        while b < len(data) and not (blank := _BLANK[data[b - 1 : b + SEGMENT]]).any():
            b += SEGMENT
        b = b + int(blank.argmax()) if b < len(data) else len(data)  # after a blank
        h, start = _hashes(data[a:b])
        hashes.append(h)
        starts.append(start + a)
        a = b
    return np.concatenate(hashes), np.searchsorted(ends, np.concatenate(starts), side="right")


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of bytes that end with a blank."""
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    start, stop = edge[::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=total[1:])
    return mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64)), start


def sets(texts: list[str], size: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, text by text and ascending, and where each text's begin (one entry more than texts).

    A text of fewer words than ``size`` has its whole sequence as one shingle; one without words has none.
    """
    h, doc = word_hashes(texts)
    n_words = np.bincount(doc, minlength=len(texts))
    # a shingle begins at each word that has size - 1 words after it, or at the first word of a short text
    at = np.concatenate([[0], np.cumsum(n_words)])
    left = at[1:][doc] - np.arange(len(h))
    first = np.arange(len(h)) == at[:-1][doc]
    begins = (left >= size) | (first & (left < size))
    value = np.zeros(len(h), np.uint64)
    for k in range(size):
        own = left > k
        value[own] += mix(h[np.flatnonzero(own) + k] * _U(2 * k + 1) + _U(k * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
    value[begins & (left < size)] += _U(0x5851F42D4C957F2D)
    value, doc = mix(value[begins]), doc[begins]
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[fresh], doc[fresh]
    return value, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
