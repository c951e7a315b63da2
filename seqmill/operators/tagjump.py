"""Tag jumps: reads of abundant sequences that show up in samples they are not from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Score from which a count is a tag jump.
LEAST = 0.1
#: Flag of reads that survive.
SURVIVED = 0x08


def score(table: DataFrame, f: float, p: float, id_col: str = "seq_idx", sample: str = "sample", least: float = LEAST, by: str | None = None) -> DataFrame:
    """``total``, ``uncross`` and ``is_tag_jump`` beside every row.

    With N reads of the sequence overall and n samples, z = f N / n, and the
    score is 2 / (1 + exp(x / z) ** p). Totals are aggregated and joined back,
    so that a sequence with a large part of the rows is added up before it
    moves. Null counts add nothing and have no score. With ``by`` reads and
    samples are those of a run, such as the sequencing run, which must not be null.
    """
    keys = [by] if by else []
    total = table.groupBy(*keys, id_col).agg(F.sum("nread").cast("bigint").alias("total"))
    if by:
        n = table.select(by, sample).distinct().groupBy(by).agg(F.count(sample).alias("_n"))
        out = table.join(total.hint("shuffle_hash"), [*keys, id_col]).join(F.broadcast(n), by)  # rows aren't sorted to meet few totals, nor dealt to as few tasks as there are runs
    else:
        out = table.join(total, id_col).withColumn("_n", F.lit(table.agg(F.countDistinct(sample)).first()[0]))
    z = F.lit(float(f)) * F.col("total") / F.greatest(F.col("_n"), F.lit(1)).cast("double")
    value = F.lit(2.0) / (F.lit(1.0) + F.exp(F.lit(float(p)) * F.col("nread") / F.nullif(z, F.lit(0.0))))
    return out.withColumn("uncross", value).drop("_n").withColumn("is_tag_jump", F.col("uncross") >= least)


def summarize(scored: DataFrame, sample: str = "sample") -> DataFrame:
    """Per sample its reads, tag-jump events, their reads and their percentage."""
    jump = F.col("is_tag_jump")
    out = scored.groupBy(sample).agg(F.sum("nread").cast("bigint").alias("total_reads"), F.count_if(jump).alias("n_events"), F.sum(F.when(jump, F.col("nread")).otherwise(0)).cast("bigint").alias("tag_jump_reads"))
    return out.withColumn("read_percent_removed", F.lit(100.0) * F.col("tag_jump_reads") / F.nullif(F.col("total_reads"), F.lit(0)))


def flag_reads(reads: DataFrame, scored: DataFrame, on: tuple[str, ...] = ("sample", "seq_idx")) -> DataFrame:
    """Reads' flags with the survivors' bit where their row was scored and is no tag jump."""
    known = scored.select(*on, "is_tag_jump")
    out = reads.join(known, list(on), "left")
    bit = F.when(F.coalesce(~F.col("is_tag_jump"), F.lit(False)), SURVIVED).otherwise(0)
    return out.withColumn("flags", F.coalesce("flags", F.lit(0)).bitwiseOR(bit)).drop("is_tag_jump")
