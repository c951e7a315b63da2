"""Read ledger: unique sequences and their abundance by sample, kept up as files of reads arrive.

    spark-submit jobs/read_ledger.py --reads FOLDER --output OUT --checkpoint CHECKPOINT [--config jobs/read_ledger.json]

A stream over the folder takes the files that are new since the last run, a
batch of files at a time, and stops when there are no more. Three tables grow:

    OUT/increments   batch, sample, seq_hash, nread, first_id    what each batch had
    OUT/sequences    batch, seq_hash, seq, n_chars               each sequence, in the batch that it first came with
    OUT/abundance    sample, seq_hash, nread, first_id, through  the sums, and the last batch that is in them

A batch writes its own partitions of the first two, so a batch that is repeated
after a failure replaces what it had written. After the stream the samples whose
last batch is not the one in ``abundance`` are added up from their increments,
and only these partitions are written; so what a failure left undone is done by
the next run, and a run without new files writes nothing.

A sequence is known by the MD5 of its text, and moves as that. Rows without a
sequence, or with a shorter one than ``min_length``, are dropped and counted in
the log; rows without a sample are of the sample ``unnamed``. Files don't change
once they are there, as Spark's file streams have it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import common
from seqmill.functions.dna import seq_hash
from seqmill.functions.session import importable

DEFAULTS = {"id": "rec_idx", "sample": "sample", "sequence": "seq", "unnamed": "unnamed", "min_length": 1, "files_per_batch": 1000}

INCREMENTS = "sample string, seq_hash string, nread long, first_id long, batch long"
SEQUENCES = "seq_hash string, seq string, n_chars int, batch long"
ABUNDANCE = "seq_hash string, nread long, first_id long, through long, sample string"


def stored(spark: SparkSession, output: str, name: str, schema: str) -> DataFrame:
    """A table of the output; one that was never written has no rows."""
    try:
        return spark.read.schema(schema).parquet(f"{output}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def take(batch: DataFrame, number: int, output: str, c: dict) -> dict:
    """Write the increments and the new sequences of one batch."""
    spark = batch.sparkSession
    rows = batch.select(F.coalesce(F.col(c["sample"]).cast("string"), F.lit(c["unnamed"])).alias("sample"), F.col(c["sequence"]).cast("string").alias("seq"), F.col(c["id"]).cast("long").alias("id"))
    fit = F.col("seq").isNotNull() & (F.length("seq") >= c["min_length"])
    own = rows.filter(fit).groupBy("sample", seq_hash(F.col("seq")).alias("seq_hash")).agg(F.count(F.lit(1)).alias("nread"), F.min("id").alias("first_id"))
    common.overwritten(own.withColumn("batch", F.lit(number).cast("long")), f"{output}/increments", "batch")
    increments = stored(spark, output, "increments", INCREMENTS).filter(F.col("batch") == number)
    known = stored(spark, output, "sequences", SEQUENCES).filter(F.col("batch") < number).select("seq_hash")
    new = increments.select("seq_hash").distinct().join(known, "seq_hash", "left_anti")
    texts = rows.filter(fit).select(seq_hash(F.col("seq")).alias("seq_hash"), "seq").groupBy("seq_hash").agg(F.first("seq").alias("seq"))
    new = texts.join(new, "seq_hash", "left_semi").select("seq_hash", "seq", F.length("seq").alias("n_chars"), F.lit(number).cast("long").alias("batch"))
    common.overwritten(new, f"{output}/sequences", "batch")
    # what was written is counted where it lies
    r = increments.agg(F.count(F.lit(1)).alias("increments"), F.coalesce(F.sum("nread"), F.lit(0)).alias("reads")).first()
    done = {"rows": batch.count(), "reads": r["reads"], "increments": r["increments"], "new": stored(spark, output, "sequences", SEQUENCES).filter(F.col("batch") == number).count()}
    common.LOG.info("batch %d: read %d rows, %d of them with a fitting sequence; wrote %d increments and %d new sequences", number, *done.values())
    return done


def refresh(spark: SparkSession, output: str) -> int:
    """Add up the samples that have batches which their abundance lacks; how many."""
    increments = stored(spark, output, "increments", INCREMENTS)
    last = increments.groupBy("sample").agg(F.max("batch").alias("last"))
    through = stored(spark, output, "abundance", ABUNDANCE).groupBy("sample").agg(F.max("through").alias("through"))
    behind = last.join(through, "sample", "left").filter(~F.col("last").eqNullSafe(F.col("through"))).select("sample", "last")
    sums = increments.groupBy("sample", "seq_hash").agg(F.sum("nread").alias("nread"), F.min("first_id").alias("first_id"))
    out = sums.join(behind, "sample").select("seq_hash", "nread", "first_id", F.col("last").alias("through"), "sample")
    samples = behind.count()
    if samples:
        common.overwritten(out, f"{output}/abundance", "sample")
    common.LOG.info("wrote %d samples of %s/abundance", samples, output)
    return samples


def run(spark: SparkSession, reads: str, output: str, checkpoint: str, **settings) -> list[dict]:
    """Take what is new and bring the sums up to it; a summary of each batch."""
    c = DEFAULTS | settings
    importable(spark)
    schema = spark.read.parquet(reads).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", c["files_per_batch"]).parquet(reads)
    done: list[dict] = []
    query = stream.writeStream.foreachBatch(lambda batch, number: done.append(take(batch, number, output, c))).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    common.LOG.info("%d new batches from %s", len(done), reads)
    refresh(spark, output)
    return done


def written(spark: SparkSession, output: str) -> DataFrame:
    """``sample, seq_hash, nread, first_id, n_chars``: the abundance, and how long each sequence is."""
    sequences = stored(spark, output, "sequences", SEQUENCES).select("seq_hash", "n_chars")
    return stored(spark, output, "abundance", ABUNDANCE).join(sequences, "seq_hash").select("sample", "seq_hash", "nread", "first_id", "n_chars")


if __name__ == "__main__":
    common.main(run, DEFAULTS, __doc__, ("reads", "output", "checkpoint"))
