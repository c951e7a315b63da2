"""K-mers of sequences, and sequences and references that meet in tiles by them.

A k-mer is k bytes of the upper-case sequence. Queries and references are dealt
to tiles of bounded letters, and tiles meet in pairs, so a task holds two tiles
however many there are of either.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of a tile of references, whose k-mers are indexed, and of one of queries.
REF_LETTERS, QUERY_LETTERS = 1 << 20, 1 << 22
#: Letters that a sequence counts for at least, so that short ones don't crowd a tile.
LEAST_LETTERS = 1024


def windows(seq: str, k: int) -> np.ndarray:
    """All k-mers in order, as numbers where they fit in 64 bits, else as byte strings."""
    raw = np.frombuffer(seq.upper().encode(), np.uint8)
    n = max(len(raw) - k + 1, 0)
    wide = np.zeros((n, max(k, 8)), np.uint8)
    if n:
        wide[:, :k] = np.lib.stride_tricks.sliding_window_view(raw, k)
    return wide.view(np.uint64 if k <= 8 else f"S{k}").reshape(n)


def words(seq: str, k: int) -> np.ndarray:
    """Sorted distinct k-mers; none of a sequence that is shorter than k."""
    return np.unique(windows(seq, k))


class Postings:
    """Which of some references have a k-mer."""

    def __init__(self, seqs: list[str], k: int):
        own = [words(s, k) for s in seqs]
        which = np.repeat(np.arange(len(own)), [len(w) for w in own])
        flat = np.concatenate(own) if own else windows("", k)
        order = np.argsort(flat, kind="stable")
        self.flat, self.which, self.n = flat[order], which[order], len(own)

    def hits(self, ask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a place in ``ask`` and a reference that has the k-mer there."""
        low, high = np.searchsorted(self.flat, ask, "left"), np.searchsorted(self.flat, ask, "right")
        many = high - low
        row = np.repeat(np.arange(len(ask)), many)
        at = np.arange(len(row)) + np.repeat(low - (np.cumsum(many) - many), many)
        return row, self.which[at]

    def shared(self, ask: np.ndarray) -> np.ndarray:
        """How many of the k-mers each reference has."""
        return np.bincount(self.hits(ask)[1], minlength=self.n)


def meet(query: DataFrame, refs: DataFrame, key: str, ref: str, query_letters: int = QUERY_LETTERS, ref_letters: int = REF_LETTERS):
    """``query(key, seq)`` and ``refs(ref, seq)`` grouped together by each pair of tiles that they are in, for ``applyInPandas``."""
    one = F.lit(0).alias("_b")
    weigh = lambda x, most, name: x.groupBy(one).agg(F.ceil(F.sum(F.greatest(F.length("seq"), F.lit(LEAST_LETTERS)).cast("long")) / most).cast("int").alias(name))
    tiles = F.broadcast(weigh(query, query_letters, "_i").join(weigh(refs, ref_letters, "_j"), "_b"))  # one row
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = query.select(one, key, "seq").join(tiles, "_b").select(own(key, "_i").alias("i"), every("_j").alias("j"), key, "seq")
    right = refs.select(one, ref, "seq").join(tiles, "_b").select(every("_i").alias("i"), own(ref, "_j").alias("j"), *[F.col(c).alias(c) for c in (ref, "seq")])  # names of its own, as both may be of one table
    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j"))
