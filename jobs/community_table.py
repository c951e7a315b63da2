"""Community table: from counts of reads to a cleaned table of sequences by sample, with their taxa.

    spark-submit jobs/community_table.py --counts COUNTS --taxonomy TAXA --output OUT [--config jobs/community_table.json]

Counts of one sequencing run, sample and sequence are added up. Inside each run
the counts that are tag jumps go, and then sequences with too few reads or in too
few samples. What stays gets its share of the sample's reads and the sequence's
taxa, and is written by run.

A run is a partition of the output. A rerun writes the same rows in the place of
the old ones; ``runs`` names the runs to do, and others stay as they are. Rows
without a run are of the run ``unnamed``; rows without a sample, sequence or
count are dropped, and counted in the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import common
from seqmill.functions.session import checkpointed, importable
from seqmill.operators import abundance, tagjump

DEFAULTS = {
    "run": "seqrun", "sample": "sample", "sequence": "seq_idx", "reads": "nread", "unnamed": "unnamed",
    "taxonomy_sequence": "seq_idx", "ranks": {},
    "f": 0.05, "p": 0.05, "least_score": 0.1, "min_reads": 2, "min_samples": 1, "runs": None,
}


def cleaned(table: DataFrame, f: float, p: float, least_score: float, min_reads: int, min_samples: int, stored=checkpointed) -> DataFrame:
    """Rows of ``seqrun, sample, seq_idx, nread`` that are no tag jumps, of sequences that are common enough in their run, with ``uncross`` and ``share``.

    ``stored`` keeps a table that is read more than once.
    """
    scored = tagjump.score(table, f, p, least=least_score, by="seqrun").filter("not is_tag_jump").select("seqrun", "sample", "seq_idx", "nread", "uncross")
    # several branches read what is scored, so it is stored and not scored again for each
    scored = stored(scored)
    common_ = scored.groupBy("seqrun", "seq_idx").agg(F.sum("nread").alias("r"), F.count(F.lit(1)).alias("s")).filter((F.col("r") >= min_reads) & (F.col("s") >= min_samples))
    kept = scored.join(common_.select("seqrun", "seq_idx").hint("shuffle_hash"), ["seqrun", "seq_idx"], "left_semi")
    total = kept.groupBy("seqrun", "sample").agg(F.sum("nread").alias("of_sample"))
    return kept.join(total, ["seqrun", "sample"]).withColumn("share", F.col("nread") / F.col("of_sample")).drop("of_sample")


def run(spark: SparkSession, counts: str, taxonomy: str, output: str, **settings) -> dict:
    """Do the job; what was read and written, as in the log."""
    c = DEFAULTS | settings
    importable(spark)
    rows = spark.read.parquet(counts).select(F.coalesce(F.col(c["run"]).cast("string"), F.lit(c["unnamed"])).alias("seqrun"), F.col(c["sample"]).cast("string").alias("sample"), F.col(c["sequence"]).cast("long").alias("seq_idx"), F.col(c["reads"]).alias("nread"))
    rows = rows.filter(F.col("seqrun").isin(c["runs"])) if c["runs"] is not None else rows
    whole = F.col("sample").isNotNull() & F.col("seq_idx").isNotNull() & F.col("nread").isNotNull()
    read = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~whole).alias("dropped")).first().asDict()
    common.LOG.info("read %d rows of %s, %d of them without sample, sequence or count", read["rows"], counts, read["dropped"])
    key = F.struct("seqrun", "sample").alias("key")
    with common.without_leftovers(spark) as stored:
        table = abundance.long_table(rows.filter(whole).select(key, "seq_idx", "nread"), "key", "seq_idx").select("sample.*", F.col("seq").alias("seq_idx"), "nread")
        taxa = spark.read.parquet(taxonomy).select(F.col(c["taxonomy_sequence"]).cast("long").alias("seq_idx"), *[F.col(x).cast("string").alias(r) for r, x in c["ranks"].items()])
        # one row a sequence, so no count is doubled
        taxa = taxa.filter("seq_idx is not null").groupBy("seq_idx").agg(*[F.min(r).alias(r) for r in c["ranks"]]) if c["ranks"] else taxa.select("seq_idx").distinct()
        out = cleaned(table, c["f"], c["p"], c["least_score"], c["min_reads"], c["min_samples"], stored).join(taxa, "seq_idx", "left")
        common.overwritten(out.select("sample", "seq_idx", "nread", "uncross", "share", *c["ranks"], "seqrun"), output, "seqrun")
    there = written(spark, output, c["ranks"])
    r = (there if c["runs"] is None else there.filter(F.col("seqrun").isin(c["runs"]))).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("nread"), F.lit(0)).alias("reads")).first()
    common.LOG.info("wrote %d rows with %d reads to %s", r["rows"], r["reads"], output)
    return {"read": read, "wrote": r.asDict()}


def written(spark: SparkSession, output: str, ranks: dict) -> DataFrame:
    """The whole output."""
    return spark.read.schema("sample string, seq_idx long, nread long, uncross double, share double, " + "".join(f"`{r}` string, " for r in ranks) + "seqrun string").parquet(output)


if __name__ == "__main__":
    common.main(run, DEFAULTS, __doc__, ("counts", "taxonomy", "output"))
