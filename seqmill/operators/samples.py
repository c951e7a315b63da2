"""Sample tables: reading, inferring from file names, merging duplicates, orientation and rarefaction."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens of metadata columns that mean true and false.
TRUE = ("true", "t", "yes", "y", "1", "+")
FALSE = ("false", "f", "no", "n", "0", "-", "")


def flag(c):
    """A token as a boolean; null is false, and any other token is taken for a name and true."""
    low = F.lower(F.trim(c))
    return F.when(low.isNull() | low.isin(list(FALSE)), False).otherwise(True)


def numbers(c):
    """A comma list as doubles; null for an empty one."""
    return F.when(F.trim(c) != "", F.transform(F.split(c, ","), lambda x: F.trim(x).cast("double")))


def merge_duplicates(table: DataFrame, policy: str = "error", files: tuple[str, ...] = ("fastq_R1", "fastq_R2")) -> DataFrame:
    """Rows that agree in all but their files become one, files joined by commas in order; or an error."""
    twice = table.groupBy("seqrun", "sample").count().filter("count > 1")
    if policy != "merge":
        if twice.limit(1).count():
            raise ValueError("samples occur more than once; 'merge' merges them")
        return table
    keys = [c for c in table.columns if c not in files]
    # files of a sample stay paired: they are sorted together
    packed = F.sort_array(F.collect_list(F.struct(*files)))
    out = table.groupBy(*keys).agg(packed.alias("_f"))
    return out.select(*keys, *[F.array_join(F.col(f"_f.{f}"), ",").alias(f) for f in files])


def expand_orientation(table: DataFrame, orient: str = "custom") -> DataFrame:
    """A row for each direction: one for ``fwd`` or ``rev``, two for ``mixed``; ``custom`` takes the column."""
    if orient != "custom":
        table = table.withColumn("orient", F.lit(orient))
    both = F.when(F.col("orient") == "mixed", F.array(F.lit("fwd"), F.lit("rev"))).otherwise(F.array("orient"))
    return table.withColumn("orient", F.explode(both))


def finalize(table: DataFrame, orient: str = "fwd", policy: str = "error", levels: DataFrame | None = None, trim_path: str = "trim", filt_path: str = "filt", rarefy_path: str = "rarefy") -> DataFrame:
    """Keys and file names of every sample, direction and rarefaction level."""
    out = expand_orientation(merge_duplicates(table, policy), orient)
    read_key = F.concat_ws("_", "seqrun", "sample")
    if levels is None:
        out = out.withColumn("rarefy_text", F.lit("full"))
    else:
        # levels are a few configured rows: an array on each sample, not a join
        out = out.withColumn("rarefy_text", F.explode(F.array(*[F.lit(r["rarefy_text"]) for r in levels.select("rarefy_text").collect()])))
    full = F.col("rarefy_text") == "full"
    out = out.withColumn("readwise_key", read_key).withColumn("sample_key", F.when(full, read_key).otherwise(F.concat_ws("_", read_key, "rarefy_text")))
    file = lambda d, key, end: F.concat(F.lit(f"{d}/"), F.concat_ws("_", key, "orient"), F.lit(end))
    for r in ("R1", "R2"):
        out = out.withColumn(f"trim_{r}", file(trim_path, "readwise_key", f"_{r}_trim.fastq.gz")).withColumn(f"filt_{r}", file(filt_path, "readwise_key", f"_{r}_filt.fastq.gz"))
        out = out.withColumn(f"to_denoise_{r}", F.when(full, F.col(f"filt_{r}")).otherwise(file(rarefy_path, "sample_key", f"_{r}.fastq.gz")))
    return out if "spike_weight" in out.columns else out.withColumn("spike_weight", F.lit(1.0))


def infer(files: DataFrame, extension: str = r"fastq(?:\.gz)?", path: str = "path") -> DataFrame:
    """``seqrun, sample, fastq_R1, fastq_R2`` of paired files: the run is the folder, mates share the rest of the name."""
    name = rf"^(?:(?:.*/)?([^/]+)/)?([^/]+?)_(?:L001_)?R([12])(?:_001)?\.{extension}$"
    p = F.col(path)
    each = files.filter(p.rlike(name)).select(F.regexp_extract(p, name, 1).alias("seqrun"), F.regexp_extract(p, name, 2).alias("sample"), F.regexp_extract(p, name, 3).alias("mate"), p.alias("file"))
    one, two = (each.filter(F.col("mate") == m).select("seqrun", "sample", F.col("file").alias(f"fastq_R{m}")) for m in "12")
    out = one.join(two, ["seqrun", "sample"])
    low = F.lower("sample")
    return out.withColumn("neg_control", low.rlike("neg|blank|ntc")).withColumn("pos_control", low.rlike("pos|mock"))


def read(spark, path: str) -> DataFrame:
    """A CSV or TSV sample table with typed flags and lists; ``orient`` is ``fwd`` where it is missing."""
    sep = "\t" if re.search(r"\.t(sv|xt)(\.gz)?$", path) else ","
    if re.search(r"\.xlsx?$", path):
        import pandas as pd

        table = spark.createDataFrame(pd.read_excel(path, dtype=str))
    else:
        table = spark.read.csv(path, sep=sep, header=True)
    for c in ("neg_control", "pos_control"):
        table = table.withColumn(c, flag(F.col(c)) if c in table.columns else F.lit(False))
    for c in table.columns:
        if re.match(r"(cut|truncQ)_R[12]$", c):
            table = table.withColumn(c, numbers(F.col(c)))
    if "spike_weight" in table.columns:
        table = table.withColumn("spike_weight", F.col("spike_weight").cast("double"))
    return table if "orient" in table.columns else table.withColumn("orient", F.lit("fwd"))


def table_hash(table: DataFrame) -> str:
    """A digest of all rows, whatever their order: counts and sums of row hashes."""
    h = F.xxhash64(*[F.col(c) for c in sorted(table.columns)])
    r = table.agg(F.count(F.lit(1)), F.sum(F.pmod(h, F.lit(1 << 40))), F.bit_xor(h)).first()
    return f"{r[0]}-{r[1] or 0}-{(r[2] or 0) & 0xFFFFFFFFFFFFFFFF:016x}"
