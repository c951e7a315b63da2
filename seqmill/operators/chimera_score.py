"""Chimeras against references by votes, mismatches, lost and added letters allowed.

The score is the published one of reference-based chimera detection: a query, a
parent that makes its left and a parent that makes its right are aligned, and
each place where they are not all equal votes. ``yes`` is a place where the query
is like its side's parent and not like the other, ``no`` one where it is like the
other, and one like neither abstains. A side has ``yes / (weight * (no + pseudo)
+ abstained)``, and the score is the product of both sides.

Parents are searched by parts: a query is cut in four, and the references with
most of each part's k-mers are candidates. All pairs of candidates are tried at
all crossings.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kmers

#: The published weight of a no, its pseudo count, and the least score.
WEIGHT, PSEUDO, LEAST = 8.0, 1.4, 0.28
#: Scores of an alignment: an equal letter, another letter, a gap of one letter.
MATCH, MISMATCH, GAP = 2, -4, -6
#: Places on either side of the commonest diagonal.
BAND = 48
_LOW = -(1 << 28)


def diagonal(query: str, ref: str, k: int) -> int:
    """How much further on in the reference most of the k-mers are that both have once; nearest to none of equal ones."""
    ends = []
    for s in (query, ref):
        w, first, many = np.unique(kmers.windows(s, k), return_index=True, return_counts=True)
        ends.append((w[many == 1], first[many == 1]))
    _, a, b = np.intersect1d(ends[0][0], ends[1][0], assume_unique=True, return_indices=True)
    if not len(a):
        return 0
    d, many = np.unique(ends[1][1][b] - ends[0][1][a], return_counts=True)
    return int(min(d[many == many.max()].tolist(), key=lambda x: (abs(x), x)))


def align(query: str, refs: list[str], diagonals: list[int], band: int = BAND) -> tuple[np.ndarray, np.ndarray]:
    """Which letters of the query each reference equals, and which have a gap or an end at or beside them.

    The best alignments inside the band, ends free; of equal ones letters against letters, then a letter that the
    reference lacks. References are aligned side by side, a letter of the query at a time.
    """
    q = np.frombuffer(query.upper().encode(), np.uint8)
    n, c, width = len(q), len(refs), 2 * band + 1
    raw = [np.frombuffer(r.upper().encode(), np.uint8) for r in refs]
    size = np.array([len(r) for r in raw])
    letters = np.zeros((c, int(size.max(initial=0)) + 1), np.uint8)
    for row, r in zip(letters, raw, strict=True):
        row[: len(r)] = r
    low = np.asarray(diagonals)[:, None] - band + np.arange(width)  # places in the reference, less those in the query
    rows, over = np.arange(c), -GAP * np.arange(width)
    steps = np.zeros((n + 1, c, width), np.uint8)  # 0 begin, 1 both, 2 the query alone, 3 the reference alone
    score = np.where((low >= 0) & (low <= size[:, None]), 0, _LOW)
    best, end_i, end_b = np.full(c, _LOW), np.zeros(c, int), np.zeros(c, int)

    def ends(score, at, i):
        """Alignments that end here, at the query's end or the reference's."""
        nonlocal best, end_i, end_b
        here = np.where((at == size[:, None]) | ((i == n) & (at >= 0) & (at <= size[:, None])), score, _LOW)
        b = here.argmax(1)
        top = here[rows, b]
        better = top > best
        best, end_i, end_b = np.where(better, top, best), np.where(better, i, end_i), np.where(better, b, end_b)

    ends(score, low, 0)
    for i in range(1, n + 1):
        at = low + i
        inside = (at >= 1) & (at <= size[:, None])
        equal = letters[rows[:, None], np.clip(at - 1, 0, letters.shape[1] - 1)] == q[i - 1]
        both = score + np.where(equal, MATCH, MISMATCH)
        alone = np.concatenate([score[:, 1:] + GAP, np.full((c, 1), _LOW)], 1)
        step = np.where(both >= alone, 1, 2).astype(np.uint8)
        new = np.where(inside, np.maximum(both, alone), _LOW)
        first = at == 0
        new, step = np.where(first, 0, new), np.where(first, np.uint8(0), step)
        run = np.maximum.accumulate(new + over, 1) - over
        run = np.where(inside, run, new)
        step = np.where(run > new, np.uint8(3), step)
        steps[i], score = step, run
        ends(score, at, i)
    same, gap = np.zeros((c, n), bool), np.ones((c, n), bool)
    beside = np.zeros((c, n + 1), bool)  # whether the reference has a letter of its own before this place of the query
    i, b, going = end_i.copy(), end_b.copy(), np.ones(c, bool)
    while going.any():
        step = np.where(going & (i > 0), steps[i, rows, b], 0)
        going = step > 0
        r = np.flatnonzero(step == 1)
        at = low[r, b[r]] + i[r] - 1
        same[r, i[r] - 1] = letters[r, at] == q[i[r] - 1]
        gap[r, i[r] - 1] = False
        i[r] -= 1
        r = np.flatnonzero(step == 2)
        i[r], b[r] = i[r] - 1, b[r] + 1
        r = np.flatnonzero(step == 3)
        b[r] -= 1
        beside[r, i[r]] = True
    gap |= beside[:, :-1] | beside[:, 1:]
    return same, gap


def votes(same: np.ndarray, gap: np.ndarray, least_votes: int = 3, least_gain: float = 0.8) -> tuple[float, int, int, int]:
    """The best score, its left and right parent and the crossing, the first of equal ones; 0 and -1 where there is none.

    Letters at or beside a gap don't vote. Each side has ``least_votes`` votes, abstentions included, and more yes than
    no. The two parents together have ``least_gain`` percent of the letters more than any candidate by itself.
    """
    c, n = same.shape
    none = (0.0, -1, -1, -1)
    if c < 2 or not n:
        return none
    alone = same.sum(1).max()
    wide = np.pad(gap, ((0, 0), (1, 1)))
    near = wide[:, :-2] | wide[:, 1:-1] | wide[:, 2:]
    told = np.flatnonzero(~same.all(0))  # where all are equal there is no vote and no difference
    m, free = same[:, told], ~near[:, told]
    if not len(told):
        return none
    sums = lambda x: np.concatenate([np.zeros((*x.shape[:-1], 1), np.int32), np.cumsum(x, -1, dtype=np.int32)], -1)
    equal, block, best = sums(m), max(1, (1 << 20) // len(told)), none
    for a in range(c):
        for at in range(0, c, block):
            other = slice(at, min(at + block, c))
            vote = free[a] & free[other]
            like, unlike, neither = sums(vote & m[a] & ~m[other]), sums(vote & ~m[a] & m[other]), sums(vote & ~m[a] & ~m[other])
            rest = lambda x: x[:, -1:] - x
            left, right = (like, unlike, neither), (rest(unlike), rest(like), rest(neither))
            gain = equal[a] + rest(equal[other]) + (n - len(told)) - alone
            good = gain * 100 >= least_gain * n
            for yes, no, out in (left, right):
                good &= (yes > no) & (yes + no + out >= least_votes)
            if good.any():
                one, two = (yes / (WEIGHT * (no + PSEUDO) + out) for yes, no, out in (left, right))
                h = np.where(good, np.round(one * two, 12), 0)  # equal products by other factors tie
                b, x = np.unravel_index(int(h.argmax()), h.shape)
                if h[b, x] > best[0]:
                    best = (float(h[b, x]), a, at + int(b), int(told[x - 1]) + 1 if x else 0)
    return best


def score(query: str, refs: list[str], k: int = 8, band: int = BAND, least_votes: int = 3, least_gain: float = 0.8) -> tuple[float, int, int, int]:
    """``votes`` of a query over its candidates, as many aligned at a time as 64 MB of steps take."""
    at_once = max(1, (64 << 20) // ((2 * band + 1) * (len(query) + 1)))
    parts = [align(query, refs[i : i + at_once], [diagonal(query, r, k) for r in refs[i : i + at_once]], band) for i in range(0, len(refs), at_once)]
    return votes(*(np.concatenate(x) for x in zip(*parts, strict=True)), least_votes, least_gain) if parts else (0.0, -1, -1, -1)


def reference_scores(seqs: DataFrame, refs: DataFrame, k: int = 8, most: int = 4, least: float = LEAST, least_votes: int = 3, least_gain: float = 0.8, band: int = BAND, query_letters: int = kmers.QUERY_LETTERS, ref_letters: int = kmers.REF_LETTERS) -> DataFrame:
    """``seq_idx, score, left_ref, right_ref, crossing, is_chimera`` of every row of ``seqs(seq_idx, seq)`` against ``refs(ref_id, seq)``.

    ``crossing`` is the letters of the query before the right parent's, the fewest of equally good ones. Each of a query's
    four parts has the ``most`` references with most of its k-mers as candidates, ties to the smaller id; queries and
    references, of any number of either, meet in tiles, whose best are compared. Different texts are scored once. A query
    that one reference explains as well as two is none, nor is one that is null, empty or shorter than ``4 * k``: its
    score is 0. References that are null or shorter than ``k`` are left out; ``ref_id`` is a key.
    """
    texts = seqs.select(F.col("seq").cast("string").alias("seq")).filter(F.octet_length("seq") >= 4 * k).distinct().withColumn("key", F.md5("seq"))
    known = refs.select("ref_id", F.col("seq").cast("string").alias("seq")).filter(F.octet_length("seq") >= k)
    kind = dict(refs.dtypes)["ref_id"]

    def candidates(asked, there):
        import pandas as pd

        there = there.sort_values("ref_id")
        ids, postings, keys, parts = there.ref_id.to_numpy(), kmers.Postings(there.seq.tolist(), k), [], [np.zeros((3, 0), np.int64)]
        for key, seq in zip(asked.key, asked.seq, strict=True):
            every = kmers.windows(seq, k)
            for part, some in enumerate(np.array_split(every, 4)):
                count = postings.shared(np.unique(some))
                top = np.argsort(-count, kind="stable")[:most]
                top = top[count[top] > 0]
                keys += [key] * len(top)
                parts.append(np.stack([np.full(len(top), part), count[top], top]))
        part, count, top = np.concatenate(parts, 1)
        return pd.DataFrame({"key": pd.Series(keys, dtype=object), "part": part, "shared": count, "ref_id": ids[top]})

    met = kmers.meet(texts, known, "key", "ref_id", query_letters, ref_letters)
    found = met.applyInPandas(candidates, f"key string, part int, shared long, ref_id {kind}")
    place = F.row_number().over(Window.partitionBy("key", "part").orderBy(F.desc("shared"), "ref_id"))
    near = found.withColumn("_place", place).filter(F.col("_place") <= most).select("key", "ref_id").distinct()
    lists = near.join(known, "ref_id").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("ref_id", "seq"))).alias("refs"))  # at most 4 * most
    asked = texts.join(lists, "key").select("key", "seq", F.col("refs.ref_id").alias("ids"), F.col("refs.seq").alias("refs"))
    spread = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = asked.repartition(spread, F.xxhash64("key"))  # few bytes, much work: by another hash than the lists, or it would be left out and put together

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = [(key, *score(seq, list(there), k, band, least_votes, least_gain)) for key, seq, there in zip(pdf.key, pdf.seq, pdf.refs, strict=True)]
            yield pd.DataFrame(out, columns=["key", "score", "a", "b", "crossing"]).assign(ids=pdf.ids.to_numpy())

    scored = asked.mapInPandas(run, f"key string, score double, a int, b int, crossing int, ids array<{kind}>").filter("a >= 0")
    scored = scored.select("key", "score", F.get("ids", "a").alias("left_ref"), F.get("ids", "b").alias("right_ref"), "crossing")
    out = seqs.select("seq_idx", F.md5(F.col("seq").cast("string")).alias("key")).join(scored, "key", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    return out.select("seq_idx", "score", "left_ref", "right_ref", "crossing", (F.col("score") >= least).alias("is_chimera"))
