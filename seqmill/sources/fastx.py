"""FASTA and FASTQ as tables: reading, writing, splitting, interleaving, renaming, random access.

A record's number in its file is a column, and everything that the order of a
file means is said with it. Compressed files can't be split, so such a file is one
task, which streams it; read once, store as Parquet, and go on from there.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.session import numbered

#: Names of FASTQ files, or of folders that Spark wrote one to.
FASTQ = r"\.(fastq|fq)(/part-[^/]*)?(\.gz)?$"

SCHEMA = "file string, rec_idx long, name string, description string, seq string, qual string"


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, block, at, value``: every line with the split that it lies in, and a number that rises inside it.

    Spark's own reader fetches and splits the files, so any store and any size will do.
    """
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")


def _bases(lines: DataFrame, counted) -> DataFrame:
    """``file, block, first, before`` of each split: its first line's number, and what is ``counted`` in the file's splits before it. One row a split."""
    per = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.sum(counted.cast("long")).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select("file", "block", "first", "before")


def _headed(rows: DataFrame, header, seq, qual) -> DataFrame:
    # the name ends before the first white space, the description begins behind it
    name = F.regexp_extract(header, r"^\S*", 0)
    return rows.select("file", "rec_idx", name.alias("name"), F.substring(header, F.length(name) + 2, F.length(header)).alias("description"), seq.alias("seq"), qual.alias("qual"))


def _fastq(lines: DataFrame) -> DataFrame:
    at = lines.join(_bases(lines, F.lit(1)), ["file", "block"]).withColumn("at", F.col("before") + F.col("at") - F.col("first"))
    field = lambda k: F.max(F.when(F.pmod("at", F.lit(4)) == k, F.col("value")))
    rows = at.groupBy("file", F.floor(F.col("at") / 4 + 1).alias("rec_idx")).agg(field(0).alias("h"), field(1).alias("s"), field(3).alias("q")).filter("h <> ''")
    return _headed(rows, F.substring("h", 2, 1 << 30), F.coalesce("s", F.lit("")), F.coalesce("q", F.lit("")))


def _fasta(lines: DataFrame) -> DataFrame:
    head = F.col("value").startswith(">")
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    at = lines.withColumn("own", F.sum(head.cast("long")).over(inside)).join(_bases(lines, head), ["file", "block"])
    part = F.when(~head, F.struct("block", "at", F.trim("value").alias("value")))
    rows = at.groupBy("file", (F.col("before") + F.col("own")).alias("rec_idx")).agg(F.max(F.when(head, F.col("value"))).alias("h"), F.collect_list(part).alias("parts")).filter("rec_idx > 0")
    return _headed(rows, F.substring("h", 2, 1 << 30), F.array_join(F.transform(F.array_sort("parts"), lambda x: x["value"]), ""), F.lit(None).cast("string"))


def read_fastx(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records of files, numbered from 1 in each file; which are FASTQ their names tell, and which are compressed too.

    Lines are read in splits, and splits' counts number the records, so a file is as many tasks as it has splits.
    FASTQ has four lines a record, blank lines at its end don't count; FASTA sequences may have several lines.
    """
    lines = _lines(spark, paths if isinstance(paths, list) else [paths])
    named = [bool(re.search(FASTQ, f)) for f in lines.inputFiles()]  # the driver's own list of files
    found = [read(lines.filter(F.col("file").rlike(FASTQ) == kind)) for read, kind in ((_fastq, True), (_fasta, False)) if kind in named]
    return found[0].unionByName(found[1]) if len(found) == 2 else found[0] if found else spark.createDataFrame([], SCHEMA)


def joined(reads: DataFrame, files: list[str]) -> DataFrame:
    """Several files as one, in the given order: ``rec_idx`` goes on from file to file."""
    counts = {r["file"]: r["n"] for r in reads.groupBy("file").agg(F.max("rec_idx").alias("n")).collect()}  # one row a file
    start, base = 0, {}
    for f in files:
        match = next((k for k in counts if k == f or k.endswith("/" + f.lstrip("/"))), None)
        if match:
            base[match] = start
            start += counts[match]
    shift = F.create_map(*[F.lit(x) for kv in base.items() for x in kv])[F.col("file")]
    return reads.filter(shift.isNotNull()).withColumn("rec_idx", F.col("rec_idx") + shift)


def fastq_text(name: str = "name", seq: str = "seq", qual: str = "qual"):
    return F.concat(F.lit("@"), F.col(name), F.lit("\n"), F.col(seq), F.lit("\n+\n"), F.col(qual))


def fasta_text(name: str = "name", seq: str = "seq"):
    return F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col(seq))


def write_fastx(reads: DataFrame, path: str, fastq: bool = True, append: bool = False, compress: bool = False, order: str = "rec_idx") -> str:
    """Records in order, one line a sequence, as a folder of part files; the path."""
    text = fastq_text() if fastq else fasta_text()
    out = reads.sort(order).select(text.alias("value"))
    out.write.mode("append" if append else "overwrite").option("compression", "gzip" if compress else "none").text(path)
    return path


def split_round_robin(reads: DataFrame, n: int, rec: str = "rec_idx") -> DataFrame:
    """``part`` from 0 and the record's number there."""
    if not 1 <= n <= 64:
        raise ValueError("from 1 to 64 parts")
    at = F.col(rec) - 1
    return reads.withColumn("part", F.pmod(at, F.lit(n)).cast("int")).withColumn("part_idx", F.floor(at / n) + 1)


def interleave(parts: DataFrame) -> DataFrame:
    """The inverse of ``split_round_robin``: records by their number in the part, then by part."""
    return numbered(parts, "part_idx", "part", name="rec_idx")


def rename(reads: DataFrame, names: DataFrame, rec: str = "rec_idx") -> DataFrame:
    """Names by record number; as many as records, or an error."""
    if reads.count() != names.count():
        raise ValueError("there must be a name for each record")
    return reads.drop("name").join(names.select(rec, "name"), rec)


def extract(reads: DataFrame, wanted: DataFrame, renumber: bool = False, rec: str = "rec_idx") -> DataFrame:
    """Records of ``wanted(req_pos, rec_idx)``, repeats and all, with their place in the request; names by that place, from 1, where ``renumber``."""
    out = wanted.join(reads, rec)
    return out.withColumn("name", F.col("req_pos").cast("string")) if renumber else out


def range_hash(reads: DataFrame, start: int, n: int, rec: str = "rec_idx") -> DataFrame:
    """A digest of ``n`` records from ``start`` and of their order: sums over 128 bits of each record's digest with its place.

    Sums are made where records lie, so no list of records meets in one task.
    """
    own = F.md5(F.concat_ws("\n", (F.col(rec) - start).cast("string"), "name", "seq", F.coalesce("qual", F.lit(""))))
    part = reads.filter((F.col(rec) >= start) & (F.col(rec) < start + n)).select(own.alias("h"))
    words = [F.sum(F.conv(F.substring("h", i, 8), 16, 10).cast("decimal(38,0)")) for i in (1, 9, 17, 25)]
    return part.agg(F.md5(F.concat_ws(",", F.count(F.lit(1)).cast("string"), *[F.coalesce(w, F.lit(0)).cast("string") for w in words])).alias("hash"))
