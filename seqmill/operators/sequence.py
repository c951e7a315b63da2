"""Operators on reads and alignments: dereplication, filters, merging mates, error tables, nuclear copies."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dna import COMPLEMENTS, CODES, IUPAC, expected_errors, primer_pattern, qualities
from ..functions.session import checkpointed, numbered


def dereplicate(reads: DataFrame, seq: str = "seq", qual: str = "qual") -> tuple[DataFrame, DataFrame]:
    """Unique sequences, most abundant first, with mean scores by position; and the map from read to unique.

    Scores are added up by position before they meet, so a sequence with a
    third of the reads is no single group of them. Reads without a sequence are
    in neither table.
    """
    reads = reads.filter(F.col(seq).isNotNull())
    per = reads.select(seq, F.posexplode_outer(qualities(F.col(qual))).alias("pos", "q")).groupBy(seq, "pos").agg(F.avg("q").alias("q"), F.count(F.lit(1)).alias("n"))
    mean = per.groupBy(seq).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "q"))), lambda x: x["q"]).alias("mean_qual"), F.max("n").alias("abundance"))
    uniques = numbered(mean, F.desc("abundance"), seq, name="derep_idx")
    return uniques, reads.join(uniques.select(seq, "derep_idx"), seq).select("rec_idx", "derep_idx")


def quality_bins(reads: DataFrame, qual: str = "qual", offset: int = 33, most: int | None = None, rec: str = "rec_idx") -> DataFrame:
    """The distinct scores of the first ``most`` reads, or of all."""
    reads = reads.filter(F.col(rec) <= most) if most is not None else reads
    return reads.select(F.explode(F.array_distinct(qualities(F.regexp_replace(F.col(qual), "\r", ""), offset))).alias("score")).distinct()


def filter_reads(reads: DataFrame, max_ee: float | None = None, max_n: int | None = None, min_length: int | None = None, max_length: int | None = None, seq: str = "seq", qual: str = "qual") -> DataFrame:
    keep = F.lit(True)
    if max_ee is not None:
        keep &= expected_errors(F.col(qual)) <= max_ee
    if max_n is not None:
        keep &= F.length(F.regexp_replace(F.upper(F.col(seq)), "[^N]", "")) <= max_n
    if min_length is not None:
        keep &= F.length(seq) >= min_length
    if max_length is not None:
        keep &= F.length(seq) <= max_length
    return reads.filter(keep)


def truncate_quality(reads: DataFrame, score: int, seq: str = "seq", qual: str = "qual") -> DataFrame:
    """Cut each read before its first score of at most ``score``."""
    bad = F.array_position(F.transform(qualities(F.col(qual)), lambda q: q <= score), True)
    n = F.when(bad > 0, bad - 1).otherwise(F.length(qual)).cast("int")
    return reads.withColumn("_n", n).withColumn(seq, F.left(seq, F.col("_n"))).withColumn(qual, F.left(qual, F.col("_n"))).drop("_n")


def cut_ends(reads: DataFrame, cut: tuple[int, int], seq: str = "seq", qual: str = "qual") -> DataFrame:
    """Take fixed numbers of letters from both ends."""
    for c in (seq, qual):
        n = F.greatest(F.length(c) - cut[0] - cut[1], F.lit(0))
        reads = reads.withColumn(c, F.substr(F.col(c), F.lit(cut[0] + 1), n))
    return reads


#: Cells of letters and of costs that primers are aligned in at once; one read of more is aligned alone.
CELLS = 4 << 20


def primer_ends(seqs: list[str | None], primer: str, max_err: float, min_overlap: int) -> np.ndarray:
    """Where the best match of a primer ends in each read: least edits over IUPAC codes, the leftmost of those; 0 for too many.

    All reads of a group are aligned a letter at a time, the longest first. A cost and the
    place where its match begins are one number, so the least has the earliest beginning.
    """
    n, limit, need = len(primer), int(max_err * len(primer)), min(min_overlap, len(primer))
    raw = [(x or "").upper().encode("ascii", "replace") for x in seqs]
    size = np.array([len(r) for r in raw], np.int64)
    out = np.zeros(len(raw), np.int64)
    order = np.argsort(-size, kind="stable")
    at = 0
    while at < len(order) and size[order[at]]:
        top = int(size[order[at]])
        group = order[at : at + max(1, CELLS // (top + n + 1))]
        at += len(group)
        letters = np.zeros((top, len(group)), np.uint8)
        for k, i in enumerate(group.tolist()):
            letters[: size[i], k] = np.frombuffer(raw[i], np.uint8)
        wide = top + 1
        wrong = np.full((256, n), wide, np.int64)
        for i, code in enumerate(primer):
            wrong[[ord(c) for c in IUPAC.get(code, "")], i] = 0
        gaps = np.arange(n + 1) * wide
        cost = np.repeat(gaps[None], len(group), 0)
        best, end = np.full(len(group), limit + 1), np.zeros(len(group), np.int64)
        there = np.searchsorted(-size[group], -np.arange(1, wide), side="right").tolist()
        for j, m in enumerate(there, 1):
            old, cost = cost[:m], np.empty((m, n + 1), np.int64)
            cost[:, 0] = j
            np.minimum(old[:, :-1] + wrong[letters[j - 1, :m]], old[:, 1:] + wide, out=cost[:, 1:])
            cost -= gaps
            np.minimum.accumulate(cost, axis=1, out=cost)
            cost += gaps
            edits, begin = np.divmod(cost[:, n], wide)
            better = np.flatnonzero((edits < best[:m]) & (j - begin >= need))
            best[better], end[better] = edits[better], j
        out[group] = end
    return out


def primer_end(seq: str, primer: str, max_err: float, min_overlap: int) -> Column:
    """Letters up to a primer's end, null where it isn't found; an exact primer by a regular expression in the engine, else by edit distance."""
    primer = primer.upper()
    if max_err == 0:
        head = F.regexp_extract(F.upper(F.col(seq)), f"^.*?{primer_pattern(primer)}", 0)
        return F.when(F.length(head) > 0, F.length(head))

    @F.pandas_udf("int")
    def ends(s):
        import pandas as pd

        return pd.Series(primer_ends(s.tolist(), primer, max_err, min_overlap), dtype="int32")

    return F.nullif(ends(F.col(seq)), F.lit(0))


#: What becomes of the letters up to a primer's end: cut, cut but for the primer, N in their place, lower case, or left.
ACTIONS = ("trim", "retain", "mask", "lowercase", "none")


def _cut_to(reads: DataFrame, end: Column, primer: str, action: str, seq: str, qual: str | None) -> DataFrame:
    if action not in ACTIONS:
        raise ValueError(f"an action is one of {', '.join(ACTIONS)}")
    at = F.greatest(F.coalesce(end - (len(primer) if action == "retain" else 0), F.lit(0)), F.lit(0))
    rest = lambda c: F.substr(F.col(c), at + 1, F.length(c))
    if action in ("trim", "retain"):
        return reads.withColumns({c: rest(c) for c in [seq] + ([qual] if qual else [])})
    head = F.repeat(F.lit("N"), at) if action == "mask" else F.lower(F.left(F.col(seq), at))
    return reads if action == "none" else reads.withColumn(seq, F.concat(head, rest(seq)))


def trim_primer(reads: DataFrame, primer: str, max_err: float = 0.2, min_overlap: int = 10, discard: bool = True, action: str = "trim", seq: str = "seq", qual: str | None = "qual") -> DataFrame:
    """Cut what lies up to the primer's end, as ``ACTIONS`` has it. Null reads match nothing."""
    out = reads.withColumn("_end", primer_end(seq, primer, max_err, min_overlap))
    if discard:
        out = out.filter("_end is not null")
    return _cut_to(out, F.col("_end"), primer, action, seq, qual).drop("_end")


def low_end(scores: Column, cutoff: float) -> Column:
    """How many scores at the end are cut: from the last on, sums of what each lacks to the cutoff are taken until one is negative, and the cut is where the sum is greatest."""
    state = F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), F.lit(0).alias("cut"), F.lit(False).alias("over"))

    def step(s, q):
        total = s["sum"] + F.lit(float(cutoff)) - q
        over = s["over"] | (total < 0)
        better = ~over & (total > s["best"])
        return F.struct((s["i"] + 1).alias("i"), total.alias("sum"), F.when(better, total).otherwise(s["best"]).alias("best"), F.when(better, s["i"] + 1).otherwise(s["cut"]).alias("cut"), over.alias("over"))

    return F.aggregate(F.reverse(scores), state, step, lambda s: s["cut"])


def cut_quality(reads: DataFrame, ends: tuple[float, ...], seq: str = "seq", qual: str = "qual") -> DataFrame:
    """Take low scores from the end, or with two cutoffs the first from the beginning and the second from the end."""
    own = qualities(F.col(qual))
    out = reads.withColumn("_z", low_end(own, ends[-1]))
    out = out.withColumn("_a", low_end(F.reverse(own), ends[0]) if len(ends) > 1 else F.lit(0))
    n = F.greatest(F.length(qual) - F.col("_a") - F.col("_z"), F.lit(0))
    return out.withColumns({c: F.substr(F.col(c), F.col("_a") + 1, n) for c in (seq, qual)}).drop("_a", "_z")


def trim_pairs(pairs: DataFrame, primer_R1: str, primer_R2: str, max_err: float = 0.2, min_overlap: int = 10, action: str = "retain", discard: bool = True, either: bool = False, max_n: int | None = None, max_ee: float | None = None, min_length: int | None = None, max_length: int | None = None, truncQ_R1: tuple | None = None, truncQ_R2: tuple | None = None, cut_R1: tuple | None = None, cut_R2: tuple | None = None, qual: bool = True) -> DataFrame:
    """Mates ``seq_R1, seq_R2`` (and ``qual_R1, qual_R2``) trimmed together: a pair stays or goes as a whole.

    In this order: fixed letters are cut, a positive number at the beginning and a negative one at the end; low scores;
    the primers, each from its mate. A pair goes if either mate has no primer, where ``discard``, or fails a filter. With
    ``either`` a pair whose mates have each other's primer is trimmed by these, and ``orient`` says ``rev``, else ``fwd``.
    Names and defaults are those of ``config.Trim``. Null mates have no primer and fail every filter.
    """
    out = pairs
    for mate, cuts, cutoffs in (("R1", cut_R1, truncQ_R1), ("R2", cut_R2, truncQ_R2)):
        seq, score = f"seq_{mate}", f"qual_{mate}"
        for n in cuts or ():
            own = [seq, *([score] if qual else [])]
            out = out.withColumns({c: F.substr(F.col(c), F.lit(max(n, 0) + 1), F.greatest(F.length(c) - abs(n), F.lit(0))) for c in own})
        out = cut_quality(out, cutoffs, seq, score) if cutoffs and qual else out
    ends = {"_a": ("seq_R1", primer_R1), "_b": ("seq_R2", primer_R2)} | ({"_c": ("seq_R1", primer_R2), "_d": ("seq_R2", primer_R1)} if either else {})
    out = out.withColumns({k: primer_end(c, p, max_err, min_overlap) for k, (c, p) in ends.items()})
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    turned = ~both & F.col("_c").isNotNull() & F.col("_d").isNotNull() if either else F.lit(False)
    out = out.withColumn("_turned", turned)
    if discard:
        out = out.filter(both | F.col("_turned"))
    # the primer that is retained is as long as the one that was found
    for mate, own, other, p, q in (("R1", "_a", "_c", primer_R1, primer_R2), ("R2", "_b", "_d", primer_R2, primer_R1)):
        end = F.when(F.col("_turned"), F.col(other) - (len(q) - len(p) if action == "retain" else 0)).otherwise(F.col(own)) if either else F.col(own)
        out = _cut_to(out.withColumn("_end", end), F.col("_end"), p, action, f"seq_{mate}", f"qual_{mate}" if qual else None)
    out = out.withColumn("orient", F.when(F.col("_turned"), "rev").otherwise("fwd")) if either else out
    for mate in ("R1", "R2"):
        out = filter_reads(out, max_ee if qual else None, max_n, min_length, max_length, f"seq_{mate}", f"qual_{mate}")
    return out.drop(*ends, "_turned", "_end")


_SWAP = str.maketrans(CODES, COMPLEMENTS)


def merge_mates(fwd: str, rev: str, min_overlap: int = 12, max_mismatch: int = 0, trim: bool = False) -> str | None:
    """A read and its mate, joined where the mate's reverse complement overlaps it best; None where nothing does."""
    a, b = np.frombuffer(fwd.encode(), np.uint8), np.frombuffer(rev.translate(_SWAP)[::-1].encode(), np.uint8)
    best = None
    for at in range(len(a) - min_overlap, -len(b) + min_overlap - 1, -1):
        lo, hi = max(0, at), min(len(a), at + len(b))
        if hi - lo < min_overlap:
            continue
        bad = int((a[lo:hi] != b[lo - at : hi - at]).sum())
        if bad <= max_mismatch and (best is None or hi - lo - 2 * bad > best[0]):
            best = (hi - lo - 2 * bad, at)
    if best is None:
        return None
    at = best[1]
    left = b"" if trim or at >= 0 else b[:-at].tobytes()
    tail = b[max(0, len(a) - at) :].tobytes()
    own = a if not trim or at + len(b) >= len(a) else a[: at + len(b)]
    return (left + own[max(0, at) if trim and at < 0 else 0 :].tobytes() + tail).decode()


def merge_pairs(pairs: DataFrame, min_overlap: int = 12, max_mismatch: int = 0, concatenate: bool = False, trim: bool = False) -> DataFrame:
    """``seq`` and ``accept`` beside ``seq_fwd, seq_rev``; or both ends with ten N between them."""
    if concatenate:
        rc = F.reverse(F.translate("seq_rev", CODES, COMPLEMENTS))
        return pairs.withColumn("seq", F.concat("seq_fwd", F.lit("N" * 10), rc)).withColumn("accept", F.lit(True))

    @F.pandas_udf("string")
    def merged(f, r):
        import pandas as pd

        return pd.Series([merge_mates(x, y, min_overlap, max_mismatch, trim) if x and y else None for x, y in zip(f, r, strict=True)])

    return pairs.withColumn("seq", merged("seq_fwd", "seq_rev")).withColumn("accept", F.col("seq").isNotNull())


def merge_denoised(reads: DataFrame, by: tuple[str, ...] = ("sample",), rec: str = "rec_idx", **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merge the denoised mates ``seq_fwd, seq_rev`` of reads: merged sequences, rejected pairs, and the map from read to sequence.

    Reads with the same two sequences in one sample are one pair with an abundance, so each pair is aligned once. Merged:
    ``seq, abundance, n_pairs`` by sample, pairs that give the same sequence added up. Rejected: the pairs that don't
    overlap, with their abundance. The map has every read, with null where a mate is null or the pair was rejected.
    Options are those of ``merge_pairs``.
    """
    both = F.col("seq_fwd").isNotNull() & F.col("seq_rev").isNotNull()
    unique = reads.filter(both).groupBy(*by, "seq_fwd", "seq_rev").agg(F.count(F.lit(1)).alias("abundance"))
    pairs = checkpointed(merge_pairs(unique, **options))
    merged = pairs.filter("accept").groupBy(*by, "seq").agg(F.sum("abundance").alias("abundance"), F.count(F.lit(1)).alias("n_pairs"))
    rejected = pairs.filter("not accept").select(*by, "seq_fwd", "seq_rev", "abundance")
    keys = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in (*by, "seq_fwd", "seq_rev")]
    where = reads.alias("r").join(pairs.filter("accept").alias("p"), keys, "left").select(f"r.{rec}", "p.seq")
    return merged, rejected, where


_STEP = re.compile(r"(\d+)([=XMID])")


def walk_cigar(true: str, obs: str, qual: str, cigar: str, offset: int = 33, indel: bool = False) -> list[tuple[str, int]]:
    """(transition, score) of each aligned letter; with ``indel`` each gap twice, at the letter before and after.

    ``X2Y`` is true to observed; ``_2XY`` a letter Y inserted beside X, ``XY2_`` one that is lost.
    Steps end where a sequence or the scores do.
    """
    out, i, j = [], 0, 0
    obs = obs[: len(qual)]
    score = lambda k: ord(qual[k]) - offset
    steps = [(int(n), c) for n, c in _STEP.findall(cigar)] or [(len(obs), "=")]
    for n, c in steps:
        n = min(n, len(true) - i if c == "D" else len(obs) - j if c == "I" else min(len(true) - i, len(obs) - j))
        if c in "=XM":
            out += [(f"{true[i + k]}2{obs[j + k]}", score(j + k)) for k in range(n)]
            i, j = i + n, j + n
        elif c == "I":  # observed only
            if indel:
                for k in range(j, j + n):
                    for beside in (k - 1, k + 1):
                        if 0 <= beside < len(obs):
                            out.append((f"_2{obs[beside]}{obs[k]}", score(beside)))
            j += n
        else:
            if indel:
                for k in range(i, i + n):
                    for beside in (j - 1, j):
                        if 0 <= beside < len(obs):
                            out.append((f"{obs[beside]}{true[k]}2_", score(beside)))
            i += n
    return out


def transitions(rows: DataFrame, offset: int = 33, indel: bool = False) -> DataFrame:
    """``transition, qual, n`` over rows ``true_seq, obs_seq, obs_qual, cigar``; counts are made in each batch before they move."""

    def run(batches):
        import pandas as pd
        from collections import Counter

        for pdf in batches:
            c = Counter()
            for t, o, q, s in zip(pdf.true_seq, pdf.obs_seq, pdf.obs_qual, pdf.cigar, strict=True):
                if t is not None and o is not None and q is not None:
                    c.update(walk_cigar(t, o, q, s or "", offset, indel))
            yield pd.DataFrame({"transition": [k[0] for k in c], "qual": pd.Series([k[1] for k in c], dtype="int32"), "n": pd.Series(list(c.values()), dtype="int64")})

    parts = rows.select("true_seq", "obs_seq", "obs_qual", "cigar").mapInPandas(run, "transition string, qual int, n long")
    return parts.groupBy("transition", "qual").agg(F.sum("n").cast("bigint").alias("n"))


def error_rates(counts: np.ndarray, scores: np.ndarray, bins: tuple[int, ...] = (2, 11, 25, 37)) -> np.ndarray:
    """16 by score rates from 16 by score counts, for scores that come in bins: linear between bins, flat beyond.

    Rows are A2A, A2C, ... T2T; rates are wrong letters over all of the true letter's, from 1e-7 to 0.25, and each
    true letter's add up to one. A bin without letters is left out, and a true letter without any has the highest
    rates. Counts at scores below the least bin or above the greatest are an error.
    """
    counts, scores, bins = np.asarray(counts, float), np.asarray(scores), np.unique(bins)
    seen = scores[counts.sum(0) > 0]
    if len(seen) and (seen.max() > bins.max() or seen.min() < bins.min()):
        raise ValueError(f"scores from {seen.min()} to {seen.max()} aren't within the bins from {bins.min()} to {bins.max()}")
    out = np.zeros((16, len(scores)))
    total = counts.reshape(4, 4, -1).sum(1)
    for row in range(16):
        if row // 4 != row % 4:
            known = np.flatnonzero(np.isin(scores, bins) & (total[row // 4] > 0))
            rate = counts[row, known] / total[row // 4, known]
            out[row] = np.clip(np.interp(scores, scores[known], rate) if len(known) else 0.25, 1e-7, 0.25)
    return _completed(out)


def _completed(rates: np.ndarray) -> np.ndarray:
    """With each true letter's own rate, what the wrong letters leave."""
    for a in range(4):
        rates[5 * a] = 0
        rates[5 * a] = 1 - rates[4 * a : 4 * a + 4].sum(0)
    return rates


def smoothed_rates(counts: np.ndarray, scores: np.ndarray, span: float = 0.75) -> np.ndarray:
    """16 by score rates from 16 by score counts, for scores that don't come in bins.

    The logarithm of (wrong + 1) / all is smoothed over the scores by local quadratics, weighted by the letters at a
    score and by nearness; beyond the scores with letters the curve is flat. Limits are those of ``error_rates``.
    """
    counts, scores = np.asarray(counts, float), np.asarray(scores, float)
    out = np.zeros((16, len(scores)))
    total = counts.reshape(4, 4, -1).sum(1)
    for row in range(16):
        weight = total[row // 4]
        known = np.flatnonzero(weight > 0)
        if row // 4 != row % 4:
            y = np.log10((counts[row, known] + 1) / weight[known])
            out[row] = np.clip(10 ** np.interp(scores, scores[known], local_quadratics(scores[known], y, weight[known], span)) if len(known) else 0.25, 1e-7, 0.25)
    return _completed(out)


def local_quadratics(x: np.ndarray, y: np.ndarray, weight: np.ndarray, span: float) -> np.ndarray:
    """The value at each of ``x`` of the parabola fitted to the nearest share ``span`` of the points, tricube weights of the distance."""
    near = min(len(x), max(3, int(np.ceil(span * len(x)))))
    out = np.empty(len(x))
    for i, at in enumerate(x):
        d = np.abs(x - at)
        reach = max(np.partition(d, near - 1)[near - 1], 1e-9)
        w = np.sqrt(weight * np.clip(1 - np.minimum(d / (reach * (1 + 1e-6)), 1) ** 3, 0, None) ** 3)
        out[i] = np.linalg.lstsq(w[:, None] * np.vander(x - at, min(3, len(x)), increasing=True), w * y, rcond=None)[0][0]
    return out


def binned(scores: list[int]) -> bool:
    """Whether scores come in bins, as fewer than ten different ones do."""
    return len(set(scores)) < 10


def _runs(text: Column, pattern: str) -> Column:
    """``pos`` from 1 and ``len`` of every match, as an array: what lies between matches is added up."""
    both = F.arrays_zip(F.split(text, pattern, -1).alias("rest"), F.regexp_extract_all(text, F.lit(f"({pattern})")).alias("run"))
    begin = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<pos:int,len:int>>").alias("found"))

    def step(acc, x):
        at = acc["at"] + F.length(x["rest"])
        n = F.length(F.coalesce(x["run"], F.lit("")))
        return F.struct((at + n).alias("at"), F.when(n > 0, F.array_append(acc["found"], F.struct(at.alias("pos"), n.alias("len")))).otherwise(acc["found"]).alias("found"))

    return F.aggregate(both, begin, step)["found"]


def nuclear_copies(rows: DataFrame, end: int = 659, seq: str = "seq", id_col: str = "seq_id") -> DataFrame:
    """``id, indicator, pos, len``: frameshifts and stop codons of aligned sequences.

    Lower-case ends go first. A run of gaps or of lower case whose length is no
    multiple of three is a frameshift, unless it begins at 1 or ends before
    ``end``; TAA or TAG is a stop codon where its place from 1 leaves 2 by three.
    Null and empty sequences have neither.
    """
    x = rows.select(id_col, F.regexp_replace(F.coalesce(F.col(seq), F.lit("")), "^[acgt]+|[acgt]+$", "").alias("x"))
    shifts = F.filter(_runs(F.col("x"), "-+|[acgt]+"), lambda r: (r["pos"] != 1) & (r["pos"] + r["len"] != end) & (r["len"] % 3 != 0))
    stops = F.filter(_runs(F.col("x"), "TA[GA]"), lambda r: r["pos"] % 3 == 2)

    def named(found: Column, name: str) -> Column:
        return F.transform(found, lambda r: F.struct(F.lit(name).alias("indicator"), r["pos"].alias("pos"), r["len"].alias("len")))

    return x.select(id_col, F.explode(F.concat(named(shifts, "frameshift"), named(stops, "stop_codon"))).alias("r")).select(id_col, "r.indicator", "r.pos", "r.len")


def consensus_columns(aligned: Column, reference: str) -> Column:
    """The letters of an aligned row at columns that the reference annotation doesn't mark with a dot."""
    keep = F.array(*[F.lit(i + 1) for i, c in enumerate(reference) if c != "."])
    return F.array_join(F.transform(keep, lambda i: F.substr(aligned, i, F.lit(1))), "")
