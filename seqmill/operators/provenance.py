"""Where each raw read went: stage flags, stage indices, and maps of both orientations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the stages of a read.
RAW, TRIMMED, FILTERED, DENOISED = 0x00, 0x01, 0x02, 0x04
_HEX = "^[0-9A-Fa-f]{1,15}$"


def stage_flags(raw: DataFrame, stages: list[DataFrame], name: str = "name", rec: str = "rec_idx") -> DataFrame:
    """``read_idx, flags``: bit i is set where stage i has the read's name. Up to eight stages."""
    if len(stages) > 8:
        raise ValueError("at most eight stages")
    out = _indexed(raw, name, rec)
    flags = F.lit(0)
    for i, stage in enumerate(stages):
        out = out.join(stage.select(F.col(name).alias("_name"), F.lit(True).alias(f"_s{i}")).distinct(), "_name", "left")
        flags = flags + F.when(F.col(f"_s{i}"), 1 << i).otherwise(0)
    return out.select("read_idx", flags.cast("int").alias("flags"))


def stage_map(raw: DataFrame, stages: dict[str, DataFrame], name: str = "name", rec: str = "rec_idx") -> DataFrame:
    """``raw_idx`` and for each stage the read's position there, null where it is missing."""
    out = _indexed(raw, name, rec).withColumnRenamed("read_idx", "raw_idx")
    for label, stage in stages.items():
        out = out.join(stage.groupBy(F.col(name).alias("_name")).agg(F.min(rec).alias(f"{label}_idx")), "_name", "left")
    return out.drop("_name")


def _indexed(raw: DataFrame, name: str, rec: str) -> DataFrame:
    """Names with their number: the hexadecimal name where all names are one, else the position."""
    all_hex = raw.agg(F.coalesce(F.bool_and(F.col(name).rlike(_HEX)), F.lit(False))).first()[0]
    index = F.conv(F.col(name), 16, 10).cast("bigint") if all_hex else F.col(rec).cast("bigint")
    return raw.select(F.col(name).alias("_name"), index.alias("read_idx"))


def merged_reads(reads: DataFrame, derep_fwd: DataFrame, denoised_fwd: DataFrame, derep_rev: DataFrame, denoised_rev: DataFrame, merged: DataFrame) -> DataFrame:
    """``rec_idx, merge_idx``: read to unique to denoised in both directions, and to the merged pair.

    ``derep_*(rec_idx, derep_idx)``, ``denoised_*(derep_idx, denoised_idx)``, ``merged(fwd_idx, rev_idx, merge_idx)``.
    """
    fwd = derep_fwd.join(denoised_fwd, "derep_idx").select("rec_idx", F.col("denoised_idx").alias("fwd_idx"))
    rev = derep_rev.join(denoised_rev, "derep_idx").select("rec_idx", F.col("denoised_idx").alias("rev_idx"))
    out = reads.select("rec_idx").join(fwd, "rec_idx", "left").join(rev, "rec_idx", "left")
    return out.join(merged, ["fwd_idx", "rev_idx"], "left").select("rec_idx", "merge_idx")


def read_map(stages: DataFrame, merged: DataFrame, dictionary: DataFrame, sample: str) -> DataFrame:
    """``sample, raw_idx, seq_idx, flags`` of every raw read.

    ``stages(raw_idx, trim_idx, filt_idx)``, ``merged(filt_idx, seq)``, ``dictionary(seq_idx, seq)``.
    """
    index = dictionary.groupBy("seq").agg(F.min("seq_idx").alias("seq_idx"))
    out = stages.join(merged, "filt_idx", "left").join(index, "seq", "left")
    bit = lambda c, b: F.when(F.col(c).isNotNull(), b).otherwise(0)
    flags = bit("trim_idx", TRIMMED) + bit("filt_idx", FILTERED) + bit("seq_idx", DENOISED)
    return out.select(F.lit(sample).alias("sample"), "raw_idx", "seq_idx", flags.cast("int").alias("flags"))


def merge_orientations(fwd: DataFrame, rev: DataFrame) -> DataFrame:
    """Maps of both orientations: the forward index first, flags of both together."""
    on = ["sample", "raw_idx"]
    both = fwd.toDF("sample", "raw_idx", "s1", "f1").join(rev.toDF("sample", "raw_idx", "s2", "f2"), on, "full")
    return both.select(*on, F.coalesce("s1", "s2").alias("seq_idx"), F.coalesce("f1", F.lit(0)).bitwiseOR(F.coalesce("f2", F.lit(0))).alias("flags"))
