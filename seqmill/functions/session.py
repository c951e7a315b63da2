"""What operators need of the session: a shared folder for checkpoints, and numbering that holds."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package; a cluster gets it by ``--py-files``."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH")]))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session has none, a local master gets a temporary folder and any
    other master a folder under the warehouse, which is shared as well.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and spark.sparkContext.master.startswith("local"):
        found = "file://" + tempfile.mkdtemp(prefix="seqmill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return (found or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_seqmill_checkpoints").rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` from the folder that ``spark.checkpoint.dir`` names; a local session without one gets a temporary folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def numbered(df: DataFrame, *order: Column | str, name: str = "row_no") -> DataFrame:
    """A consecutive row number from 1 in a total order, without gathering rows in one task.

    Rows are range-partitioned and sorted, and the sorted rows are checkpointed
    so that they stay where they are; the partitions' counts, one row each,
    give the numbers that partitions begin with.
    """
    at = checkpointed(df.sort(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = at.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    out = at.withColumn("_part", part).join(F.broadcast(base), "_part")
    return out.withColumn(name, F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_part", "_base", "_at")


def running_count(df: DataFrame, key: str, marks: DataFrame, mark: str, name: str, width: int = 1 << 16) -> DataFrame:
    """For each row, the number of ``marks`` that are not above its ``key``.

    Keys are cut to ranges of ``width``; a window counts inside a range, and a
    window over the ranges' counts, one row each, adds what lies below.
    """
    bucket = lambda c: F.floor(F.col(c) / width)
    m = marks.select(F.col(mark).alias("_k")).filter("_k is not null").distinct()
    below = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = m.groupBy(bucket("_k").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    keys = df.select(F.col(key).alias("_k")).filter("_k is not null").distinct()
    both = keys.withColumn("_m", F.lit(0)).union(m.withColumn("_m", F.lit(1))).groupBy("_k").agg(F.max("_m").alias("_m")).withColumn("_b", bucket("_k"))
    ranges = both.select("_b").distinct().join(per, "_b", "left").withColumn("_base", F.coalesce(F.sum("_n").over(below), F.lit(0))).select("_b", "_base")
    inside = Window.partitionBy("_b").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    counts = both.withColumn("_in", F.sum("_m").over(inside)).join(ranges, "_b").select("_k", (F.col("_base") + F.col("_in")).alias(name))
    return df.join(counts, df[key] == counts["_k"], "left").drop("_k")


def following(nodes: DataFrame, child: str, parent: str, rounds: int = 64) -> DataFrame:
    """Follow parents to the root by pointer jumping; a parent that is no child is a root. Depth halves each round."""
    out = checkpointed(nodes.select(child, parent))
    for _ in range(rounds):
        up = out.select(F.col(child).alias(parent), F.col(parent).alias("_up"))
        step = out.join(up, parent, "left").select(child, F.col(parent).alias("_was"), F.coalesce("_up", parent).alias(parent))
        step = checkpointed(step)
        out = step.select(child, parent)
        if not step.filter(f"_was <> {parent}").limit(1).count():
            return out
    raise ValueError("parents form a cycle")
