"""Reproducible, nested subsampling: what a smaller sample keeps, a larger one of the same seed keeps too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Places of a block that are put in order inside a row; larger blocks have a row for each place.
WIDE = 4_096


def _key(seed: int, rec: str) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(rec).cast("string")))


def block_ranks(reads: DataFrame, denominator: int, seed: int = 1, rec: str = "rec_idx") -> DataFrame:
    """``block_rank``: a read's place in a random order of its block of ``denominator`` consecutive reads."""
    block = F.floor((F.col(rec) - 1) / denominator)
    order = Window.partitionBy("_block").orderBy(_key(seed, rec), rec)
    return reads.withColumn("_block", block).withColumn("block_rank", F.row_number().over(order)).drop("_block")


def sample_fraction(reads: DataFrame, numerator: int, denominator: int, seed: int = 1, rec: str = "rec_idx") -> DataFrame:
    """``numerator`` reads of each block of ``denominator``; a last block that is short is sampled as if it were full."""
    if not 0 <= numerator <= denominator:
        raise ValueError("the numerator must be from 0 to the denominator")
    return _ranked(reads, numerator, denominator, seed, rec).drop("_rank")


def _ranked(reads: DataFrame, most: int, denominator: int, seed: int, rec: str) -> DataFrame:
    """Reads whose ``_rank`` in the random order of all places of their block is at most ``most``.

    The first ``most`` places of a block are one row, made once, and its reads are looked up there as they come: neither reads nor
    places are sorted or held, and what a task holds are its blocks, a row for ``denominator`` reads.
    """
    if denominator > WIDE:
        return reads.join(_places(reads, denominator, seed, rec).filter(F.col("_rank") <= most), rec)
    block = F.floor((F.col(rec) - 1) / denominator)
    place = lambda i: F.col("_block") * denominator + i
    key = lambda r: F.md5(F.concat_ws("-", F.lit(str(seed)), r.cast("string")))
    keyed = F.transform(F.sequence(F.lit(1), F.lit(denominator)), lambda i: F.struct(key(place(i)).alias("k"), place(i).alias("r"), i.alias("i")))
    first = F.transform(F.slice(F.sort_array(keyed), 1, most), lambda x: x["i"])
    blocks = reads.select(block.alias("_block")).distinct().select("_block", first.alias("_first"))
    # not a broadcast: blocks are few bytes until their places are made
    found = reads.withColumn("_block", block).join(blocks.hint("shuffle_hash"), "_block")
    rank = F.array_position("_first", (F.col(rec) - F.col("_block") * denominator).cast("int"))
    return found.withColumn("_rank", rank).filter("_rank > 0").select(*reads.columns, "_rank")


def _places(reads: DataFrame, denominator: int, seed: int, rec: str) -> DataFrame:
    """``_rank`` of every place of the blocks that have reads: a full block's random order has the missing reads in it too."""
    # blocks are few bytes, and would be put together in one task before their places, many more, are made; by another hash
    # than their own they are dealt anew, and the windows stay where they are
    order = Window.partitionBy("_part", "_block").orderBy(_key(seed, rec), rec)
    block = F.floor((F.col(rec) - 1) / denominator)
    blocks = reads.select(block.alias("_block")).distinct().withColumn("_part", F.xxhash64("_block"))
    blocks = blocks.repartition(int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_part")
    full = blocks.select("_part", "_block", F.explode(F.sequence(F.lit(1), F.lit(denominator))).alias("_i"))
    return full.select("_part", "_block", (F.col("_block") * denominator + F.col("_i")).alias(rec)).withColumn("_rank", F.row_number().over(order)).select(rec, "_rank")


def sample_levels(reads: DataFrame, numerators: list[int], denominator: int, seed: int = 1, rec: str = "rec_idx") -> DataFrame:
    """Several nested samples in one pass: a read once for each ``level``, a numerator, whose sample has it.

    One random order gives each read's rank in its block, and the rank says which samples have the read, so the reads are
    scanned once; written by ``level``, each sample is a partition.
    """
    if not numerators or not all(0 <= n <= denominator for n in numerators):
        raise ValueError("numerators must be from 0 to the denominator")
    levels = sorted(set(numerators))
    ranked = _ranked(reads, levels[-1], denominator, seed, rec)
    own = F.filter(F.array(*map(F.lit, levels)), lambda n: n >= F.col("_rank"))
    return ranked.withColumn("level", F.explode(own)).drop("_rank")


def sample_fractions(reads: DataFrame, numerators: list[int], denominator: int, seed: int = 1, rec: str = "rec_idx") -> dict[int, DataFrame]:
    """The samples of ``sample_levels`` one by one."""
    every = sample_levels(reads, numerators, denominator, seed, rec)
    return {n: every.filter(F.col("level") == n).drop("level") for n in numerators}


def sample_number(reads: DataFrame, number: int, seed: int = 1, rec: str = "rec_idx") -> DataFrame:
    """The ``number`` reads that come first in a random order, or all.

    Counts of the order's first four digits, 65,536 rows, say in which of these the last read lies; those before it are
    all in, and only its own reads, one in 65,536, are put in order.
    """
    digits = F.substring(_key(seed, rec), 1, 4)
    before = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    counts = reads.groupBy(digits.alias("_d")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    cut = counts.filter((F.col("_before") < number) & (F.col("_before") + F.col("_n") >= number)).first()
    if cut is None:
        return reads if number > 0 else reads.limit(0)
    last = reads.filter(digits == cut["_d"]).orderBy(_key(seed, rec), rec).limit(number - cut["_before"])
    return reads.filter(digits < cut["_d"]).unionByName(last)


def sample_numbers(reads: DataFrame, numbers: list[int], seed: int = 1, rec: str = "rec_idx") -> dict[int, DataFrame]:
    return {n: sample_number(reads, n, seed, rec) for n in numbers}


def paired(r1: DataFrame, r2: DataFrame, rec: str = "rec_idx") -> DataFrame:
    """Mates side by side, with ``_R1`` and ``_R2`` behind their columns, to be sampled as one read."""
    one = r1.select(rec, *[F.col(c).alias(f"{c}_R1") for c in r1.columns if c != rec])
    two = r2.select(rec, *[F.col(c).alias(f"{c}_R2") for c in r2.columns if c != rec])
    return one.join(two, rec)


def unpaired(both: DataFrame, rec: str = "rec_idx") -> tuple[DataFrame, DataFrame]:
    cut = lambda s: both.select(rec, *[F.col(c).alias(c.removesuffix(s)) for c in both.columns if c.endswith(s)])
    return cut("_R1"), cut("_R2")


def sample_by_order(reads: DataFrame, order: DataFrame, number: int, rec: str = "rec_idx") -> DataFrame:
    """Reads whose place in a given order, ``order(rec_idx, place)``, is at most ``number``."""
    return reads.join(order.filter(F.col("place") <= number).select(rec), rec, "left_semi")


def renamed(reads: DataFrame, rec: str = "rec_idx", name: str = "name") -> DataFrame:
    """Names replaced by the read's number in hexadecimal."""
    return reads.withColumn(name, F.lower(F.hex(F.col(rec).cast("bigint"))))


def rarefaction_levels(spark, fractions: list[tuple[int, int]] = (), numbers: list[int] = (), full: bool = True) -> DataFrame:
    """``label, numerator, denominator, number`` of each level."""
    rows = [(f"{a}_per_{b}", a, b, None) for a, b in fractions] + [(f"{n}_reads", None, None, n) for n in numbers] + ([("full", None, None, None)] if full else [])
    return spark.createDataFrame(rows, "rarefy_text string, numerator int, denominator int, number int")
