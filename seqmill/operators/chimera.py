"""Chimeras: sequences made of the beginning of one more abundant sequence and the end of another."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _matrix(seqs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of sequences as rows, zeros behind them, and their lengths."""
    raw = [s.encode() for s in seqs]
    size = np.array([len(r) for r in raw], np.int64)
    out = np.zeros((len(raw), int(size.max(initial=0))), np.uint8)
    for i, r in enumerate(raw):
        out[i, : len(r)] = np.frombuffer(r, np.uint8)
    return out, size


def overlaps(child: str, parents: np.ndarray, size: np.ndarray, max_shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the child that each parent matches from the left and from the right.

    A parent is moved by the shift that matches most letters, the nearer to none
    of equal ones, and its free ends count as matches.
    """
    a = np.frombuffer(child.encode(), np.uint8)
    n, k = len(a), len(parents)
    most, left, right = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
    wide = np.zeros((k, max(parents.shape[1], n) + 2 * max_shift), np.uint8)
    wide[:, max_shift : max_shift + parents.shape[1]] = parents
    at = np.arange(n)
    for shift in sorted(range(-max_shift, max_shift + 1), key=lambda s: (abs(s), -s)):
        inside = (at[None] >= shift) & (at[None] < (size + shift)[:, None])
        same = (wide[:, max_shift - shift : max_shift - shift + n] == a) & inside
        count = same.sum(1)
        off = inside & ~same
        some = off.any(1)
        first, last = off.argmax(1), n - 1 - off[:, ::-1].argmax(1)
        better = count > most
        most = np.where(better, count, most)
        left = np.where(better, np.where(some, first, n), left)
        right = np.where(better, np.where(some, n - 1 - last, n), right)
    return left, right


#: Texts whose ends a worker keeps, and letters of them together; beyond that it begins anew.
KNOWN, KNOWN_LETTERS = 2_048, 1 << 22


class Ends:
    """Ends of texts that other texts make, kept from group to group of a worker, as samples have many texts in common.

    What is kept is a table of the texts met, children by parents, so its size is bounded whatever is asked; ends depend
    on the two texts and the shift alone.
    """

    def __init__(self, max_shift: int, most: int = KNOWN, letters: int = KNOWN_LETTERS):
        self.max_shift, self.most, self.room = max_shift, most, letters
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.letters = 0
        self.ends = np.full((2, 0, 0), -1, np.int32)

    def of(self, children: list[str], parents: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters from the left and from the right, children by parents; texts of each side are different ones."""
        new = [t for t in dict.fromkeys([*children, *parents]) if t not in self.at]
        if len(self.at) + len(new) > self.most or self.letters + sum(map(len, new)) > self.room:
            self.clear()
            new = list(dict.fromkeys([*children, *parents]))
            if len(new) > self.most or sum(map(len, new)) > self.room:  # too many to keep
                made = _matrix(parents)
                found = [overlaps(c, *made, self.max_shift) for c in children]
                return np.stack([x for x, _ in found]), np.stack([y for _, y in found])
        for t in new:
            self.at[t] = len(self.at)
            self.letters += len(t)
        if (n := len(self.at)) > self.ends.shape[1]:
            wider = np.full((2, size := min(self.most, max(256, 2 * n)), size), -1, np.int32)
            wider[:, : self.ends.shape[1], : self.ends.shape[1]] = self.ends
            self.ends = wider
        i, j = (np.array([self.at[t] for t in side]) for side in (children, parents))
        open_ = self.ends[0][np.ix_(i, j)] < 0
        for row in np.flatnonzero(open_.any(1)):
            some = np.flatnonzero(open_[row])
            self.ends[:, i[row], j[some]] = overlaps(children[row], *_matrix([parents[x] for x in some]), self.max_shift)
        return self.ends[0][np.ix_(i, j)], self.ends[1][np.ix_(i, j)]


#: What this worker keeps, by shift.
_ENDS: dict[int, Ends] = {}


def _judge(n: int, left: np.ndarray, right: np.ndarray, one_off: bool, min_one_off_distance: int) -> bool:
    part = (left < n) & (right < n)  # a parent that makes all of the child doesn't make it a chimera
    if not part.any():
        return False
    a, b = int(left[part].max()), int(right[part].max())
    # one mismatch may lie between the two ends, if both parents differ enough from the child
    return a + b >= n or one_off and a + b + 1 >= n and n - a >= min_one_off_distance and n - b >= min_one_off_distance


def is_bimera(child: str, parents: list[str], one_off: bool = False, min_one_off_distance: int = 4, max_shift: int = 16) -> bool:
    """Whether the child is the left of one parent and the right of another, without mismatch, or with one where ``one_off``."""
    return _made_of(child, _matrix(parents), one_off, min_one_off_distance, max_shift)


def _made_of(child: str, parents: tuple[np.ndarray, np.ndarray], one_off: bool = False, min_one_off_distance: int = 4, max_shift: int = 16) -> bool:
    if not child or not len(parents[0]):
        return False
    return _judge(len(child), *overlaps(child, *parents, max_shift), one_off, min_one_off_distance)


def _dealt(side: DataFrame) -> DataFrame:
    """A side of a join that is hashed in tasks, never sent whole."""
    return side.hint("shuffle_hash")


def _ends(children: DataFrame, parents: DataFrame, fold: float, max_shift: int, tile: int) -> DataFrame:
    """``sample, seq_idx, n, a, b``: the most letters of each child that a parent makes from its left and from its right.

    Parents have more than ``fold`` times the child's count, and none that makes all of the child is one. Both sides of a
    sample are dealt to tiles by a hash and tiles meet in pairs, so a group has ``2 * tile`` rows or so, whatever the
    sample; the most over all tiles is the most of the sample. Samples are compared null-safe.
    """
    whole = F.length("seq") > 0
    sides = [x.filter(whole).select(F.struct("sample").alias("s"), "seq_idx", F.col("nread").cast("double").alias("nread"), "seq") for x in (children, parents)]
    # of a parent's copies the most abundant is one to whatever child any of them is one
    sides[1] = sides[1].groupBy("s", "seq").agg(F.max("nread").alias("nread"))
    n = [x.groupBy("s").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias(c)) for x, c in zip(sides, ("_l", "_r"), strict=True)]
    tiles = n[0].join(_dealt(n[1]), "s")
    own = lambda c: F.pmod(F.xxhash64(*(["seq_idx", "seq"] if c == "_l" else ["seq"])), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = sides[0].join(_dealt(tiles), "s").select("s.sample", own("_l").alias("i"), every("_r").alias("j"), "seq_idx", "nread", "seq")
    right = sides[1].join(_dealt(tiles), "s").select(F.col("s.sample").alias("sample"), every("_l").alias("i"), own("_r").alias("j"), *[F.col(c).alias(c) for c in ("nread", "seq")])  # names of its own, as both may be of one table
    kind = dict(left.dtypes)

    def kernel(key, kids, old):
        import pandas as pd

        if not len(kids) or not len(old):
            return pd.DataFrame([], columns=["sample", "seq_idx", "n", "a", "b"])
        old = old.sort_values("nread", ascending=False)
        texts, which = np.unique(old.seq.to_numpy(dtype=object).astype(str), return_inverse=True)
        own, child = np.unique(kids.seq.to_numpy(dtype=object).astype(str), return_inverse=True)
        size = np.array([len(t) for t in own.tolist()])
        # parents that a child may have, the most abundant ones
        many = np.searchsorted(-old.nread.to_numpy(), -fold * kids.nread.to_numpy(), side="left")
        left, right = _ENDS.setdefault(max_shift, Ends(max_shift)).of(own.tolist(), texts.tolist())
        part = (left < size[:, None]) & (right < size[:, None])  # a parent that makes all of the child is none
        a, b = (np.maximum.accumulate(np.where(part, x, -1)[:, which], axis=1)[child, np.maximum(many, 1) - 1] for x in (left, right))
        some = (many > 0) & (a >= 0)
        return pd.DataFrame({"sample": key[0], "seq_idx": kids.seq_idx[some], "n": size[child][some], "a": a[some], "b": b[some]})

    found = left.groupBy("sample", "i", "j").cogroup(right.groupBy("sample", "i", "j")).applyInPandas(kernel, f"sample {kind['sample']}, seq_idx {kind['seq_idx']}, n long, a long, b long")
    return found.groupBy("sample", "seq_idx").agg(F.max("n").alias("n"), F.max("a").alias("a"), F.max("b").alias("b"))


def _chimeric(one_off: bool, min_one_off_distance: int):
    """Whether two ends make the whole, or all but one letter where both differ enough from it."""
    whole = F.col("a") + F.col("b") >= F.col("n")
    if not one_off:
        return whole
    far = (F.col("n") - F.col("a") >= min_one_off_distance) & (F.col("n") - F.col("b") >= min_one_off_distance)
    return whole | (F.col("a") + F.col("b") + 1 >= F.col("n")) & far


def flag_samples(table: DataFrame, seqs: DataFrame, fold: float = 1.5, least: int = 2, one_off: bool = False, min_one_off_distance: int = 4, max_shift: int = 16, tile: int = 512) -> DataFrame:
    """``seq_idx, nflag, nsam``: in how many of its samples a sequence looks chimeric.

    Possible parents have at least ``least`` reads and more than ``fold`` times the sample's smallest count. Null and
    empty sequences are in samples, but never flagged and no parents.
    """
    # files of repeated texts look small enough to send, but they and the samples' counts are as many as there are, so each join
    # deals both sides to tasks, and the driver holds none
    rows = table.join(_dealt(seqs.select("seq_idx", "seq")), "seq_idx").select("sample", "seq_idx", "nread", "seq")
    few = rows.groupBy(F.struct("sample").alias("s")).agg(F.min("nread").alias("_m"))
    parents = rows.withColumn("s", F.struct("sample")).join(_dealt(few), "s").filter((F.col("nread") >= least) & (F.col("nread") > F.lit(float(fold)) * F.col("_m")))
    ends = _ends(rows, parents, fold, max_shift, tile).filter(_chimeric(one_off, min_one_off_distance))
    flags = ends.groupBy("seq_idx").agg(F.count(F.lit(1)).alias("nflag"))
    total = rows.groupBy("seq_idx").agg(F.countDistinct(F.struct("sample")).alias("nsam"))
    return total.join(_dealt(flags), "seq_idx", "left").select("seq_idx", F.coalesce("nflag", F.lit(0)).cast("long").alias("nflag"), "nsam")


def consensus(flags: DataFrame, min_fraction: float = 0.9, ignore: int = 1, id_col: str = "seq_idx") -> DataFrame:
    """Ids that are chimeric in all their samples, or in all but ``ignore`` of them by the fraction; parts are added up first."""
    total = flags.groupBy(id_col).agg(F.sum("nflag").cast("bigint").alias("nflag"), F.sum("nsam").cast("bigint").alias("nsam"))
    some = (F.col("nflag") > 0) & (F.col("nflag") >= (F.col("nsam") - ignore) * F.lit(float(min_fraction)))
    return total.filter((F.col("nflag") >= F.col("nsam")) | some)


def against_references(seqs: DataFrame, refs: DataFrame, one_off: bool = False, min_one_off_distance: int = 4, max_shift: int = 16, tile: int = 512) -> DataFrame:
    """``seq_idx, is_chimera`` of sequences against ``refs(seq)``, of any number: tiles of both meet in pairs.

    A null or empty sequence is no chimera; without references there are none.
    """
    child = seqs.select(F.lit(0).alias("sample"), "seq_idx", F.lit(0).alias("nread"), "seq")
    parent = refs.select(F.lit(0).alias("sample"), F.lit(None).alias("seq_idx"), F.lit(1).alias("nread"), "seq").distinct()
    ends = _ends(child, parent, 1.0, max_shift, tile).filter(_chimeric(one_off, min_one_off_distance)).select("seq_idx", F.lit(True).alias("is_chimera"))
    return seqs.select("seq_idx").join(ends, "seq_idx", "left").withColumn("is_chimera", F.coalesce("is_chimera", F.lit(False)))
