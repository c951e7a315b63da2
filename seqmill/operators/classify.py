"""Taxonomic assignment by k-mers: the reference that shares most of a sample of k-mers, again and again."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.taxa import DEFAULT
from . import kmers
from .taxonomy import path_probabilities


def draws(seq: str, own: int, rounds: int, words: int) -> np.ndarray:
    """Places among a sequence's ``own`` k-mers that each round draws; they follow from the sequence, so equal sequences agree."""
    return np.random.default_rng(zlib.crc32(seq.encode())).integers(0, own, (rounds, words))


def _best(seq: str, postings: kmers.Postings, k: int, rounds: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The most drawn k-mers that a reference has, by round, and the first reference that has them."""
    own = kmers.words(seq, k)
    drawn, place = np.unique(draws(seq, len(own), rounds, words), return_inverse=True)
    times = np.zeros((rounds, len(drawn)), np.float32)
    np.add.at(times, (np.repeat(np.arange(rounds), words), place.ravel()), 1)
    has = np.zeros((len(drawn), postings.n), np.float32)
    has[postings.hits(own[drawn])] = 1
    count = times @ has
    first = count.argmax(1)
    return count[np.arange(rounds), first].astype(np.int32), first


def classify(query: DataFrame, refs: DataFrame, k: int = 8, rounds: int = 100, words: int = 32, least: float = 0.0, ranks: tuple[str, ...] = DEFAULT.ranks, query_letters: int = kmers.QUERY_LETTERS, ref_letters: int = kmers.REF_LETTERS) -> DataFrame:
    """``seq_id, rank, parent_taxonomy, taxon, prob`` of every row of ``query(seq_id, seq)``.

    ``refs`` has ``ref_id``, one row each, ``seq`` and ``path``, the taxa complete to the tip, in any number. A round goes
    to the reference with most of its k-mers, ties to the smaller id, and a path's probability is its share of the rounds;
    a round that no reference has a k-mer of goes to none. Different texts are classified once. Both sides meet in tiles,
    of which each gives the best of a round, and the best of those is the round's. Sequences that are null or shorter
    than ``k`` have no rows, and such references win nothing.
    """
    long = F.octet_length("seq") >= k
    texts = query.select(F.col("seq").cast("string").alias("seq")).filter(long).distinct().withColumn("key", F.md5("seq"))
    known = refs.select("ref_id", F.col("seq").cast("string").alias("seq")).filter(long)
    kind = dict(refs.dtypes)["ref_id"]

    def kernel(asked, there):
        import pandas as pd

        there = there.sort_values("ref_id")
        ids, postings, keys, parts = there.ref_id.to_numpy(), kmers.Postings(there.seq.tolist(), k), [], [np.zeros((3, 0), np.int64)]
        for key, seq in zip(asked.key, asked.seq, strict=True):
            if len(ids):
                count, first = _best(seq, postings, k, rounds, words)
                at = np.flatnonzero(count)
                keys += [key] * len(at)
                parts.append(np.stack([at, count[at], first[at]]))
        at, count, first = np.concatenate(parts, 1)
        return pd.DataFrame({"key": pd.Series(keys, dtype=object), "round": at, "shared": count, "ref_id": ids[first]})

    met = kmers.meet(texts, known, "key", "ref_id", query_letters, ref_letters)
    found = met.applyInPandas(kernel, f"key string, round int, shared int, ref_id {kind}")
    won = found.groupBy("key", "round").agg(F.min(F.struct(-F.col("shared"), "ref_id")).alias("w")).select("key", F.col("w.ref_id").alias("ref_id"))
    shares = won.groupBy("key", "ref_id").count().join(refs.select("ref_id", "path"), "ref_id").groupBy("key", "path").agg((F.sum("count") / rounds).alias("prob"))
    paths = query.select("seq_id", F.md5(F.col("seq").cast("string")).alias("key")).join(shares, "key").select("seq_id", "path", "prob")
    return path_probabilities(paths, ranks, least=least)
