"""Pairs of near sequences or vectors inside blocks, such as samples or parent taxa.

Edit distances are searched through an index: a sequence of n letters that may
be at k edits from a shorter one is cut into segments of q letters one behind the
other. Each edit spoils one of them at most, so of any k + 1 + s segments at
least s + 1 are found in the other sequence, not more than k places away. The
rarest segments of each sequence are kept, and only pairs that have so many of
them in common are measured. q is the longest that leaves k + 1 segments. Where
the index would find no fewer pairs than there are, all pairs of the block are
measured instead, in tiles.

Distances of vectors and masked Hamming distances are matrix products over
tiles: both sides of a block are dealt to tiles of bounded size, and tiles meet
in pairs.

A block may be null; null is a block like any other. ``threshold`` is a number or
a map from block to number, where ``_NA_`` stands for blocks that it doesn't name;
blocks without a threshold have no pairs. Results are ``block, id, id2, dist``;
without a right side each pair comes once, the smaller id first.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.session import checkpointed

#: Segment lengths, the longest that fits first.
LENGTHS = (14, 12, 10, 8, 6, 5, 4, 3, 2, 1)
#: Segments that are looked for beyond those that edits can spoil.
SPARE = 3
#: Rows of a side of a tile.
TILE = 2048


def with_limit(rows: DataFrame, block: str, threshold) -> DataFrame:
    """``rows`` with ``_t``, the threshold of their block; rows of blocks without one go."""
    if not isinstance(threshold, dict):
        return rows.withColumn("_t", F.lit(float(threshold)))
    kind = dict(rows.dtypes)[block]
    known = [(k, float(v)) for k, v in threshold.items() if k != "_NA_"]
    # one row a taxon that was given a threshold, as the driver holds them
    own = rows.sparkSession.createDataFrame(known, "_taxon string, _t double").select(F.col("_taxon").cast(kind).alias("_taxon"), "_t") if known else None
    out = rows.join(F.broadcast(own), F.col(block) == F.col("_taxon"), "left").drop("_taxon") if own is not None else rows.withColumn("_t", F.lit(None).cast("double"))
    return out.withColumn("_t", F.coalesce("_t", F.lit(threshold.get("_NA_")).cast("double"))).filter("_t is not null")


def _edits(n: Column, t: Column) -> Column:
    return F.floor(n * t + 1e-9)


def _common(a: Column, b: Column) -> Column:
    """Letters that two texts begin with in common, by halves of what is left."""
    step = lambda at, i: F.when((at + i <= F.least(F.length(a), F.length(b))) & (F.substr(a, F.lit(1), at + i) == F.substr(b, F.lit(1), at + i)), at + i).otherwise(at)
    return F.aggregate(F.array(*[F.lit(1 << i) for i in range(30, -1, -1)]), F.lit(0), step)


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows over all shuffle partitions: they are few bytes but much work, and would be put together by bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _met(rows: DataFrame, some: DataFrame, tile: int) -> DataFrame:
    """Each of ``some`` beside all rows of its block as ``y, side_y, n_y``: both are dealt to tiles that meet in pairs."""
    n = [t.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias(c)) for t, c in ((some, "_l"), (rows, "_r"))]
    tiles = n[0].join(n[1], "b")
    own = lambda c: F.pmod(F.xxhash64("id", "side"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = some.join(tiles, "b").select("b", own("_l").alias("i"), every("_r").alias("j"), F.col("id").alias("x"), "side", "n", "k")
    right = rows.join(tiles, "b").select("b", every("_l").alias("i"), own("_r").alias("j"), F.col("id").alias("y"), F.col("side").alias("side_y"), F.col("n").alias("n_y"))
    return _spread(left, "b", "i", "j").join(_spread(right, "b", "i", "j").hint("shuffle_hash"), ["b", "i", "j"])


def candidates(rows: DataFrame, two_sides: bool = False, block: str = "block", tile: int = TILE // 4) -> DataFrame:
    """``b, x, y``: the block as a struct and ids of pairs that are worth measuring, of ``block, id, side, seq, _t``.

    ``x`` is the longer one, or of one length the one with the greater id; with ``two_sides`` pairs are of different sides.
    Ids have to be unique in each block and side. All copies of a sequence are paired, as the result has them.
    What all sequences of a block begin with tells none apart, so segments are cut behind it. A sequence that has no more
    letters there than edits, or whose segments would meet more often than its block has sequences, is paired with all of
    its block in tiles.
    """
    k = F.col("k")
    rows = rows.filter("seq is not null").select(F.struct(F.col(block)).alias("b"), "id", "side", "seq", F.length("seq").alias("n"), "_t", _edits(F.length("seq"), F.col("_t")).alias("k"))
    per = rows.groupBy("b").agg(F.min("seq").alias("a"), F.max("seq").alias("z"), F.count(F.lit(1)).alias("all"))
    per = per.select("b", _common(F.col("a"), F.col("z")).alias("skip"), "all")
    rows = rows.join(per, "b").withColumn("seq", F.substr("seq", F.col("skip") + 1)).withColumn("m", F.length("seq"))
    fit = [F.when(F.floor(F.col("m") / q) > k, q) for q in LENGTHS]
    # read by all that follows, so it is stored once, and so are the segments that are kept
    rows = checkpointed(rows.withColumn("q", F.coalesce(*fit, F.lit(0))))

    def cut(q: Column | int, step: Column | int, last: Column) -> Column:
        places = F.transform(F.sequence(F.lit(0), last), lambda i: (i * step).cast("int"))
        return F.transform(places, lambda i: F.struct(i.alias("at"), F.substr("seq", i + 1, F.lit(q) if isinstance(q, int) else q).alias("gram")))

    segments = cut(F.col("q"), F.col("q"), F.floor(F.col("m") / F.col("q")) - 1)
    # which lengths of segments there are, and for which lengths of sequences: ten rows at most
    seen = rows.filter("q > 0").groupBy("q").agg(F.min(F.col("m") - F.col("k")).alias("a"), F.max("m").alias("z")).collect()
    none = F.array().cast("array<struct<at: int, gram: string>>")
    grams = [F.when((F.col("m") >= r["q"]) & F.col("m").between(r["a"], r["z"]), cut(r["q"], 1, F.greatest(F.col("m") - r["q"], F.lit(0)))) for r in seen]
    every = F.array_distinct(F.flatten(F.array(*[F.coalesce(g, none) for g in grams]))) if grams else none
    probe = rows.select("b", F.col("id").alias("y"), F.col("side").alias("side_y"), F.col("n").alias("n_y"), F.explode(every).alias("g")).select("b", "y", "side_y", "n_y", F.col("g.gram").alias("gram"), F.col("g.at").alias("at_y"))
    often = probe.groupBy("b", "gram").agg(F.count(F.lit(1)).alias("often"))
    index = rows.filter("q > 0").select("b", F.col("id").alias("x"), "side", "n", "k", "all", F.explode(segments).alias("s")).select("b", "x", "side", "n", "k", "all", "s.at", "s.gram")
    # a sequence's segments, the rarest first; a segment that is nowhere but in itself is the rarest
    kept = index.join(often, ["b", "gram"]).groupBy("b", "x", "side", "n", "k", "all").agg(F.slice(F.sort_array(F.collect_list(F.struct("often", "at", "gram"))), F.lit(1), F.max((F.col("k") + 1 + SPARE).cast("int"))).alias("s"))
    kept = checkpointed(kept).withColumn("work", F.aggregate("s", F.lit(0).cast("long"), lambda n, s: n + s["often"]))
    plain = F.col("work") > F.col("all")
    wide = kept.filter(plain).select("b", F.col("x").alias("id"), "side", "n", "k").unionByName(rows.filter("q = 0").select("b", "id", "side", "n", "k"))
    kept = kept.filter(~plain).withColumn("need", F.size("s") - F.col("k")).select("b", "x", "side", "n", "k", "need", F.explode("s").alias("s")).select("b", "x", "side", "n", "k", "need", "s.gram", "s.at")
    order = F.struct("n", "x") > F.struct(F.col("n_y").alias("n"), F.col("y").alias("x"))
    if two_sides:
        order = (F.col("side") != F.col("side_y")) & (F.struct("n", "side") > F.struct(F.col("n_y").alias("n"), F.col("side_y").alias("side")))
    fits = order & (F.col("n_y") >= F.col("n") - k)
    met = _spread(kept, "b", "gram").join(_spread(probe, "b", "gram"), ["b", "gram"]).filter(fits & (F.abs(F.col("at") - F.col("at_y")) <= k))
    met = met.groupBy("b", "x", "side", "y", "need").agg(F.collect_set("at").alias("found")).filter(F.size("found") >= F.col("need")).select("b", "x", "side", "y")
    return met.unionByName(_met(rows, wide, tile).filter(fits).select("b", "x", "side", "y"))


def texts_of(rows: DataFrame, block: str, seq: str = "seq") -> DataFrame:
    """``block, id, seq``: each text of a block once, under the smallest of its ids. Null texts go."""
    return rows.filter(F.col(seq).isNotNull()).groupBy(block, F.col(seq).alias("seq")).agg(F.min("id").alias("id")).select(block, "id", "seq")


def members(rows: DataFrame, texts: DataFrame, block: str, seq: str = "seq") -> DataFrame:
    """``b, rep, id``: the block as a struct, and the id that stands for each row's text."""
    own = texts.select(F.struct(F.col(block)).alias("b"), F.col("id").alias("rep"), "seq")
    return rows.select(F.struct(F.col(block)).alias("b"), "id", F.col(seq).alias("seq")).join(own, ["b", "seq"]).select("b", "rep", "id")


def _expanded(near: DataFrame, left: DataFrame, right: DataFrame | None, block: str, linked: DataFrame | None = None) -> DataFrame:
    """Pairs of rows from ``block, id, id2, dist`` of texts. Of one side alone copies of the texts in ``linked`` are pairs as well."""
    near = near.select(F.struct(F.col(block)).alias("b"), F.col("id").alias("x"), F.col("id2").alias("y"), "dist")
    if right is None:
        near = near.unionByName(linked.select(F.struct(F.col(block)).alias("b"), F.col("id").alias("x"), F.col("id").alias("y"), F.lit(0.0).alias("dist")))
    both = near.join(left.toDF("b", "x", "_1"), ["b", "x"]).join((left if right is None else right).toDF("b", "y", "_2"), ["b", "y"])
    if right is not None:
        return both.select(F.col(f"b.{block}").alias(block), F.col("_1").alias("id"), F.col("_2").alias("id2"), "dist")
    both = both.filter((F.col("x") != F.col("y")) | (F.col("_1") < F.col("_2")))
    return both.select(F.col(f"b.{block}").alias(block), F.least("_1", "_2").alias("id"), F.greatest("_1", "_2").alias("id2"), "dist")


def edit_pairs(left: DataFrame, right: DataFrame | None, block: str, threshold, seq: str = "seq") -> DataFrame:
    """Pairs whose edit distance over the longer length is at most the threshold, which is below 1. Null sequences have no pairs.

    Copies of a text are looked for and measured once, and the pairs of texts are then dealt to their rows.
    """
    _checked(threshold)
    sides = [None if x is None else with_limit(x.select(block, "id", F.col(seq).alias("seq")), block, threshold) for x in (left, right)]
    texts = [None if x is None else texts_of(x, block) for x in sides]
    rows = [None if x is None else members(x, t, block) for x, t in zip(sides, texts, strict=True)]
    return _expanded(text_pairs(*texts, block, threshold), *rows, block, texts[0])


def text_pairs(left: DataFrame, right: DataFrame | None, block: str, threshold, seq: str = "seq") -> DataFrame:
    """What ``edit_pairs`` gives, of rows among which no text is twice in a block; copies would meet in all pairs."""
    _checked(threshold)
    own = with_limit(left.select(block, "id", F.col(seq).alias("seq"), F.lit(0).alias("side")), block, threshold)
    rows = own if right is None else own.unionByName(with_limit(right.select(block, "id", F.col(seq).alias("seq"), F.lit(1).alias("side")), block, threshold))
    found = candidates(rows, right is not None, block)
    if right is None:
        pairs = found.select("b", F.least("x", "y").alias("id"), F.greatest("x", "y").alias("id2"))
    else:
        first = F.col("side") == 0
        pairs = found.select("b", F.when(first, F.col("x")).otherwise(F.col("y")).alias("id"), F.when(first, F.col("y")).otherwise(F.col("x")).alias("id2"))
    one = own.select(F.struct(F.col(block)).alias("b"), "id", F.col("seq").alias("s1"), "_t")
    two = (own if right is None else right.select(block, "id", F.col(seq).alias("seq"))).select(F.struct(F.col(block)).alias("b"), F.col("id").alias("id2"), F.col("seq").alias("s2"))
    return measured(pairs.join(one, ["b", "id"]).join(two, ["b", "id2"])).select(F.col(f"b.{block}").alias(block), "id", "id2", "dist")


def measured(pairs: DataFrame) -> DataFrame:
    """``s1, s2`` within ``_t`` of each other, with their edits ``d`` and ``dist``; the computation stops at each pair's limit."""
    top = F.greatest(F.length("s1"), F.length("s2"))
    near = pairs.withColumn("_top", top).withColumn("d", F.expr("levenshtein(s1, s2, cast(floor(_top * _t + 1e-9) as int))")).filter("d >= 0")
    return near.withColumn("dist", F.col("d") / F.greatest("_top", F.lit(1))).drop("_top")


def _checked(threshold) -> None:
    if any(not 0 <= t < 1 for t in (threshold.values() if isinstance(threshold, dict) else [threshold])):
        raise ValueError("thresholds lie from 0 up to 1")


def tile_pairs(left: DataFrame, right: DataFrame | None, block: str, threshold, width: Column, kernel: Callable, tile: int = TILE) -> DataFrame:
    """Pairs by a kernel over tiles: ``kernel(x, y)`` gives the distances of two lists of ``v`` as a matrix, NaN for none.

    Both sides of a block are dealt to tiles by a hash of the id, and each pair of tiles is a group, so a group has about
    ``2 * tile`` rows at most, and of one side alone each pair of tiles once. ``width`` parts a block into what can be
    compared.
    """
    same = right is None
    sides = [with_limit(x.select(block, "id", "v", width.alias("width")), block, threshold).withColumn("b", F.struct(F.col(block))) for x in ((left,) if same else (left, right))]
    n = [x.groupBy("b", "width").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias(c)) for x, c in zip(sides, ("_l", "_r"), strict=False)]
    tiles = n[0].withColumn("_r", F.col("_l")) if same else n[0].join(n[1], ["b", "width"])
    own = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    dealt = [x.join(tiles, ["b", "width"]).withColumn("_own", own(c)) for x, c in zip(sides, ("_l", "_r"), strict=False)]
    names = ("b", "width", "i", "j", "side", "id", "v", "_t")
    if same:
        # to the tile pairs (own, other) with own <= other as the left, and (other, own) as the right
        meet = F.explode(F.transform(every("_l"), lambda o: F.struct(F.least("_own", o).alias("i"), F.greatest("_own", o).alias("j"), F.when(o < F.col("_own"), 1).otherwise(0).alias("side"))))
        both = dealt[0].select("b", "width", "id", "v", "_t", meet.alias("m")).select("b", "width", "m.*", "id", "v", "_t").select(*names)
    else:
        a = dealt[0].select("b", "width", F.col("_own").alias("i"), F.explode(every("_r")).alias("j"), F.lit(0).alias("side"), "id", "v", "_t")
        z = dealt[1].select("b", "width", F.explode(every("_l")).alias("i"), F.col("_own").alias("j"), F.lit(1).alias("side"), "id", "v", "_t")
        both = a.select(*names).unionByName(z.select(*names))
    both = both.select(F.col(f"b.{block}").alias(block), *names[1:])
    kind = dict(both.dtypes)

    def pairs(key, pdf):
        import pandas as pd

        a = pdf[pdf.side == 0]
        b = a if same and key[2] == key[3] else pdf[pdf.side == 1]
        parts = []
        if len(a) and len(b):
            d = kernel(a.v.tolist(), b.v.tolist())
            with np.errstate(invalid="ignore"):
                i, j = np.nonzero(d <= a["_t"].iloc[0])
            x, y, z = a.id.to_numpy()[i], b.id.to_numpy()[j], d[i, j]
            if same:
                keep = x < y if b is a else slice(None)
                x, y, z = np.minimum(x, y)[keep], np.maximum(x, y)[keep], z[keep]
            parts.append((x, y, z))
        x, y, z = parts[0] if parts else ([], [], [])
        # no rows have a type of their own, else strings would come as numbers
        return pd.DataFrame({block: pd.Series([key[0]] * len(x), dtype=object), "id": pd.Series(x, dtype=object), "id2": pd.Series(y, dtype=object), "dist": pd.Series(z, dtype=float)})

    return both.groupBy(block, "width", "i", "j").applyInPandas(pairs, f"`{block}` {kind[block]}, id {kind['id']}, id2 {kind['id']}, dist double")


def _cosine(x: list, y: list) -> np.ndarray:
    a, b = (np.stack(v).astype(float) for v in (x, y))
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    return np.round(1 - a @ b.T, 9)


def vector_pairs(left: DataFrame, right: DataFrame | None, block: str, threshold, tile: int = TILE) -> DataFrame:
    """Pairs of vectors ``v`` whose cosine distance, to nine places, is at most the threshold.

    Vectors that are null or hold a null or a NaN are in no pair, and neither are two of different lengths; a vector of
    zeros is at distance one.
    """
    whole = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x))
    return tile_pairs(left.filter(whole), None if right is None else right.filter(whole), block, threshold, F.size("v"), _cosine, tile)


def hamming_pairs(left: DataFrame, right: DataFrame | None, block: str, threshold, seq: str = "seq", min_overlap: int = 1, gaps: str = "-.", tile: int = TILE // 4) -> DataFrame:
    """Pairs of aligned sequences by the share of different letters among the positions where both have one.

    Positions where either has a character of ``gaps`` are masked; pairs with fewer than ``min_overlap`` others, and those of
    different lengths, are none. Upper and lower case are the same. Null and empty sequences have no pairs. Copies of a text
    are compared once, and the pairs of texts are then dealt to their rows.
    """

    def kernel(x: list, y: list) -> np.ndarray:
        a, b = (np.array([np.frombuffer(s.encode("latin-1", "replace"), np.uint8) for s in v]) for v in (x, y))
        masked = np.frombuffer(gaps.encode(), np.uint8)
        there = [(~np.isin(m, masked)).astype(np.float32) for m in (a, b)]
        both = there[0] @ there[1].T
        same = np.zeros_like(both)
        for c in np.setdiff1d(np.unique(a), masked):
            same += (a == c).astype(np.float32) @ (b == c).astype(np.float32).T
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(both >= max(1, min_overlap), np.round(1 - same.astype(float) / both, 9), np.nan)

    sides = [None if x is None else with_limit(x.filter(F.length(seq) > 0).select(block, "id", F.upper(F.col(seq)).alias("seq")), block, threshold) for x in (left, right)]
    texts = [None if x is None else texts_of(x, block).withColumnRenamed("seq", "v") for x in sides]
    rows = [None if x is None else members(x, t.withColumnRenamed("v", "seq"), block) for x, t in zip(sides, texts, strict=True)]
    # copies are pairs only if enough of their text isn't masked
    linked = with_limit(texts[0].filter(F.length(F.translate("v", gaps, "")) >= max(1, min_overlap)), block, threshold).filter("_t >= 0")
    return _expanded(tile_pairs(*texts, block, threshold, F.length("v"), kernel, tile), *rows, block, linked)


#: Distances by the name that a configuration gives them.
METHODS: dict[str, Callable] = {"edit": edit_pairs, "hamming": hamming_pairs, "cosine": vector_pairs}


def configured(config: str | dict) -> Callable:
    """A function of left side, right side, block and threshold from a distance's name, or a mapping with its ``method`` and options."""
    config = {"method": config} if isinstance(config, str) else dict(config)
    method = config.pop("method")
    if method not in METHODS:
        raise ValueError(f"no distance {method}; there are {', '.join(METHODS)}")
    return lambda left, right, block, threshold: METHODS[method](left, right, block, threshold, **config)
