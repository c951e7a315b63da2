"""Post-clustering curation: rare sequences that follow a more common relative are merged into it.

Ids are ranked by occurrences and reads, both falling, and the id. A child is
merged into the first parent in that order with which it shares enough samples
and which is abundant enough beside it, and parents are followed to the root.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import following, numbered
from .distance import candidates, measured


def ranked_ids(table: DataFrame, id_col: str = "seq_idx") -> DataFrame:
    """``occ``, ``total`` and ``place`` from 1 of each id."""
    out = table.groupBy(id_col).agg(F.count(F.lit(1)).alias("occ"), F.sum("nread").cast("bigint").alias("total"))
    return numbered(out, F.desc("occ"), F.desc("total"), id_col, name="place")


def pair_stats(matches: DataFrame, ids: DataFrame, max_dist: float = 0.1, max_gap: int | None = None, max_total_gap: int | None = None, id_col: str = "seq_idx") -> DataFrame:
    """Per child and parent: shared samples, least and mean ratio of the parent's to the child's reads."""
    near = matches.filter((F.col("dist") <= max_dist) & (F.col(f"{id_col}1") != F.col(f"{id_col}2")))
    if max_gap is not None:
        near = near.filter(F.col("max_gap") <= max_gap)
    if max_total_gap is not None:
        near = near.filter(F.col("n_gap") <= max_total_gap)
    one = ids.select(F.col(id_col).alias(f"{id_col}1"), F.col("place").alias("p1"))
    two = ids.select(F.col(id_col).alias(f"{id_col}2"), F.col("place").alias("p2"))
    both = near.join(one, f"{id_col}1").join(two, f"{id_col}2")
    first = F.col("p1") < F.col("p2")
    both = both.select(
        F.when(first, F.col(f"{id_col}2")).otherwise(F.col(f"{id_col}1")).alias("child"),
        F.when(first, F.col(f"{id_col}1")).otherwise(F.col(f"{id_col}2")).alias("parent"),
        F.least("p1", "p2").alias("parent_place"),
        (F.when(first, F.col("nread1")).otherwise(F.col("nread2")) / F.nullif(F.when(first, F.col("nread2")).otherwise(F.col("nread1")), F.lit(0))).alias("ratio"),
    )
    return both.groupBy("child", "parent", "parent_place").agg(F.count(F.lit(1)).alias("shared"), F.min("ratio").alias("min_ratio"), F.avg("ratio").alias("mean_ratio"))


def parent_map(table: DataFrame, matches: DataFrame, max_dist: float = 0.1, min_abundance_ratio: float = 1.0, min_cooccurrence_ratio: float = 1.0, use_mean: bool = False, id_col: str = "seq_idx", **gaps) -> DataFrame:
    """``seq_idx, parent_idx`` of every id in the table: the root of its parents, itself where none qualifies.

    The ratio must be above its least, the share of the child's samples at least its own.
    """
    ids = ranked_ids(table, id_col)
    pairs = pair_stats(matches, ids, max_dist, id_col=id_col, **gaps)
    occ = ids.select(F.col(id_col).alias("child"), "occ")
    ratio = F.col("mean_ratio" if use_mean else "min_ratio")
    fit = pairs.join(occ, "child").filter((F.col("shared") >= F.lit(float(min_cooccurrence_ratio)) * F.col("occ")) & (ratio > min_abundance_ratio))
    first = fit.groupBy("child").agg(F.min_by("parent", "parent_place").alias("parent"))
    roots = following(first, "child", "parent")
    return ids.join(roots, ids[id_col] == roots["child"], "left").select(id_col, F.coalesce("parent", id_col).alias("parent_idx"))


def merged_table(table: DataFrame, parents: DataFrame, id_col: str = "seq_idx") -> DataFrame:
    """Reads added up by the parent and every other column."""
    keys = [c for c in table.columns if c not in (id_col, "nread")]
    out = table.join(parents, id_col, "left").withColumn(id_col, F.coalesce("parent_idx", id_col))
    return out.groupBy(*keys, id_col).agg(F.sum("nread").cast("bigint").alias("nread"))


def sample_matches(table: DataFrame, seqs: DataFrame, threshold: float = 0.1, gaps: bool = False, copies: bool = True) -> DataFrame:
    """Pairs of one sample whose edit distance over the longer length is at most the threshold, with both counts.

    Pairs are looked for inside samples only. A text of several sequences is looked for once, and two texts that several
    samples have are measured once. Without ``copies`` only the smallest sequence of each text of a sample, which stands for
    the others, is paired with those of other texts, and each of the others with that one alone: pairs of different texts
    are all there, and a distance of zero is membership.
    """
    if not 0 <= threshold < 1:
        raise ValueError("the threshold lies from 0 up to 1")
    seqs = seqs.filter("seq is not null")
    texts = seqs.groupBy("seq").agg(F.min("seq_idx").alias("text"))
    of = seqs.join(texts, "seq").select("seq_idx", "text")
    counted = table.join(of, "seq_idx").select("sample", "text", "seq_idx", "nread")
    rows = counted.select("sample", F.col("text").alias("id")).distinct().join(texts.select(F.col("text").alias("id"), "seq"), "id")
    rows = rows.withColumns({"side": F.lit(0), "_t": F.lit(float(threshold))})
    found = candidates(rows, block="sample")
    pairs = found.select(F.least("x", "y").alias("seq_idx1"), F.greatest("x", "y").alias("seq_idx2")).distinct()
    stats = ("align_length", "n_gap", "max_gap") if gaps else ()
    every = (*stats, "max_gap_turned") if gaps else ()
    near = _near(pairs, texts.select(F.col("text").alias("seq_idx"), "seq"), threshold, gaps)
    near = near.select(F.col("seq_idx1").alias("text1"), F.col("seq_idx2").alias("text2"), "dist", *every)
    none = [F.lit(0.0).alias("dist"), *([F.length("seq").cast("long").alias("align_length"), *[F.lit(0).cast("long").alias(c) for c in every[1:]]] if gaps else [])]
    alone = texts.select(F.col("text").alias("text1"), F.col("text").alias("text2"), *none)
    side = lambda t, k: t.select("sample", F.col("text").alias(f"text{k}"), F.struct("seq_idx", "nread").alias(f"r{k}"))
    met = lambda t, by, u: side(t, 1).join(by, "text1").join(side(u, 2), ["sample", "text2"]).filter("text1 <> text2 or r1.seq_idx < r2.seq_idx")

    def turned(both: DataFrame) -> DataFrame:
        # the smaller sequence comes first, whichever text it has, and gaps of equal alignments lie by the order
        first = F.col("r1.seq_idx") < F.col("r2.seq_idx")
        both = both.withColumn("max_gap", F.when(first, F.col("max_gap")).otherwise(F.col("max_gap_turned"))) if gaps else both
        one, two = F.when(first, F.col("r1")).otherwise(F.col("r2")), F.when(first, F.col("r2")).otherwise(F.col("r1"))
        both = both.withColumns({"one": one, "two": two})
        return both.select("sample", F.col("one.seq_idx").alias("seq_idx1"), F.col("two.seq_idx").alias("seq_idx2"), F.col("one.nread").alias("nread1"), F.col("two.nread").alias("nread2"), "dist", *stats)

    if copies:
        return turned(met(counted, near.unionByName(alone), counted))
    first = counted.groupBy("sample", "text").agg(F.min(F.struct("seq_idx", "nread")).alias("f")).select("sample", "text", "f.*")
    return turned(met(first, near, first).unionByName(met(first, alone, counted)))


def near_pairs(seqs: DataFrame, threshold: float = 0.1, gaps: bool = False) -> DataFrame:
    """``seq_idx1, seq_idx2, dist`` of sequences, the smaller index first, whose edit distance over the longer length is at most the threshold.

    Candidates come from ``distance.candidates``. With ``gaps`` come the columns of ``gap_stats``. Null sequences have no pairs.
    """
    if not 0 <= threshold < 1:
        raise ValueError("the threshold lies from 0 up to 1")
    rows = seqs.select(F.lit(0).alias("block"), F.col("seq_idx").alias("id"), "seq", F.lit(0).alias("side"), F.lit(float(threshold)).alias("_t"))
    found = candidates(rows)
    return _near(found.select(F.least("x", "y").alias("seq_idx1"), F.greatest("x", "y").alias("seq_idx2")), seqs, threshold, gaps).drop("max_gap_turned")


def _near(pairs: DataFrame, seqs: DataFrame, threshold: float, gaps: bool) -> DataFrame:
    """Pairs that are within the threshold, measured. With ``gaps`` also ``max_gap_turned``, which the other order has."""
    one = seqs.select(F.col("seq_idx").alias("seq_idx1"), F.col("seq").alias("s1"))
    two = seqs.select(F.col("seq_idx").alias("seq_idx2"), F.col("seq").alias("s2"))
    near = measured(pairs.join(one, "seq_idx1").join(two, "seq_idx2").withColumn("_t", F.lit(float(threshold))))
    if not gaps:
        return near.select("seq_idx1", "seq_idx2", "dist")
    kind = dict(near.dtypes)["seq_idx1"]
    near = near.repartition(int(near.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes but much work

    def run(batches):
        import pandas as pd

        for pdf in batches:
            columns, gap, longest, turned = gap_table(pdf.s1.tolist(), pdf.s2.tolist(), pdf.d.to_numpy())
            yield pdf[["seq_idx1", "seq_idx2", "dist"]].assign(align_length=columns, n_gap=gap, max_gap=longest, max_gap_turned=turned)

    return near.select("seq_idx1", "seq_idx2", "dist", "s1", "s2", "d").mapInPandas(run, f"seq_idx1 {kind}, seq_idx2 {kind}, dist double, align_length long, n_gap long, max_gap long, max_gap_turned long")


#: Cells of alignments that are filled at a time.
CELLS = 1 << 20


def gap_stats(a: str, b: str, edits: int) -> tuple[int, int, int]:
    """Columns, gap letters and the longest run of gaps of one side, of a global alignment of the fewest ``edits`` and then the fewest gap letters.

    A band about the diagonal, as wide as the edits allow, is enough. Of equal ways back a column of two letters
    comes before a gap in ``b``, and that before one in ``a``.
    """
    return tuple(int(x[0]) for x in gap_table([a], [b], np.array([edits]))[:3])


def gap_table(a: list[str], b: list[str], edits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``gap_stats`` gives of each pair, and the longest run of gaps of the pair's other order, many pairs at a time."""
    sizes = np.array([(len(x), len(y)) for x, y in zip(a, b, strict=True)], np.int64).reshape(-1, 2)
    edits = np.asarray(edits, np.int64)
    out = np.zeros((4, len(a)), np.int64)
    order = np.lexsort((sizes[:, 1], sizes[:, 0], edits))
    at = 0
    while at < len(order):
        # as many pairs as there is room for, were they as long as the longest of these
        some = order[at : at + max(1, CELLS // 8)]
        need = (np.maximum.accumulate(sizes[some].max(1)) + 1) * (2 * np.maximum.accumulate(edits[some]) + 1) * np.arange(1, len(some) + 1)
        some = some[: max(1, int(np.searchsorted(need, CELLS, side="right")))]
        out[:, some] = _gaps([a[k] for k in some], [b[k] for k in some], sizes[some], int(edits[some].max()))
        at += len(some)
    return tuple(out)


def _coded(texts: list[str], width: int, before: int) -> np.ndarray:
    """Letters of texts as rows from place ``before`` on."""
    out = np.zeros((len(texts), before + width), np.uint32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    size = np.array([len(t) for t in texts])
    row = np.repeat(np.arange(len(texts)), size)
    out[row, before + np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _gaps(a: list[str], b: list[str], sizes: np.ndarray, edits: int) -> tuple[np.ndarray, ...]:
    n, m = sizes[:, 0], sizes[:, 1]
    top, width = int(sizes.max(initial=0)), 2 * edits + 1
    kind, far = (np.int32, np.int32(1 << 29)) if (2 * top + 2) * (2 * top + width + 4) < 1 << 28 else (np.int64, np.int64(1 << 50))
    # pairs lie behind each other in the last axis, so that steps along the band are steps of whole rows
    x, y = (np.ascontiguousarray(t.T) for t in (_coded(a, top, 0), _coded(b, top + width, edits)))
    wrong = (n + m + 1).astype(kind)
    gap, c = wrong + kind(1), np.arange(width)[:, None]
    slope = gap * c.astype(kind)
    cost = np.full((top + 1, width, len(a)), far, kind)
    row = c - edits
    cost[0] = np.where((row >= 0) & (row <= m), gap * row.astype(kind), far)
    for i in range(1, int(n.max(initial=0)) + 1):
        j = i - edits + c
        last, best = cost[i - 1], cost[i]
        np.multiply(x[i - 1] != y[i - 1 : i - 1 + width], wrong, out=best)
        best += last
        best[: max(0, edits + 1 - i)] = far
        np.minimum(best[:-1], last[1:] + gap, out=best[:-1])
        off = (j < 0) | (j > m)
        best[off] = far
        best -= slope
        np.minimum.accumulate(best, axis=0, out=best)
        best += slope
        best[off] = far
        np.minimum(best, far, out=best)
    found = []
    for turned in (False, True):
        k, i, j = np.arange(len(a)), n.copy(), m.copy()
        gaps, longest, run, side = (np.zeros(len(a), np.int64) for _ in range(4))
        while True:
            # what is left without a cost is letter by letter
            go = (i[k] != j[k]) | (cost[i[k], j[k] - i[k] + edits, k] > 0)
            k = k[go]
            if not len(k):
                break
            p, q = i[k], j[k]
            d = q - p + edits
            at = cost[p, d, k]
            pair = (p > 0) & (q > 0)
            pair &= at == cost[p - 1, d, k] + np.where(x[p - 1, k] != y[q - 1 + edits, k], wrong[k], 0)
            up = (p > 0) & (d + 1 < width)
            up &= at == cost[p - 1, np.minimum(d + 1, width - 1), k] + gap[k]
            if turned:
                back = (q > 0) & (d > 0)
                up &= ~(back & (at == cost[p, np.maximum(d - 1, 0), k] + gap[k]))
            up &= ~pair
            now = np.where(pair, 0, np.where(up, 1, 2))
            run[k] = np.where(now == 0, 0, np.where(now == side[k], run[k] + 1, 1))
            side[k] = now
            gaps[k] += now > 0
            longest[k] = np.maximum(longest[k], run[k])
            i[k] -= now < 2
            j[k] -= now != 1
        found.append((gaps, longest))
    return (n + m + found[0][0]) // 2, found[0][0], found[0][1], found[1][1]
