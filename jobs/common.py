"""What the jobs share: arguments, configuration, a log, writing by partitions."""

from __future__ import annotations

import argparse
import contextlib
import json
import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

LOG = logging.getLogger("jobs")


def configured(spark: SparkSession, path: str | None, defaults: dict) -> dict:
    """The defaults, and what a JSON file, read by Spark, has in their place; a key that no default has is an error."""
    own = json.loads(spark.read.text(path, wholetext=True).first()[0]) if path else {}
    if unknown := sorted(set(own) - set(defaults)):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    return defaults | own


def main(run, defaults: dict, doc: str, paths: tuple[str, ...], argv: list[str] | None = None) -> None:
    """The command line of a job: one argument for each path, and the configuration's path."""
    parser = argparse.ArgumentParser(description=doc)
    for p in paths:
        parser.add_argument(f"--{p}", required=True)
    parser.add_argument("--config")
    given = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(run.__module__).getOrCreate()
    try:
        run(spark, *[given[p] for p in paths], **configured(spark, given["config"], defaults))
    finally:
        spark.stop()


#: Whether a query's shuffle files go when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def without_leftovers(spark: SparkSession):
    """Shuffle files go with the query that wrote them, not when the driver happens to collect its garbage; and a function that
    stores a table on the executors' disks, compressed and by columns, until the next one is stored or all is done.
    """
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    held = []

    def stored(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.DISK_ONLY))
        # filled now, so that what it took to make it goes now, and so does the table before it, which it was made of
        held[-1].count()
        if len(held) > 1:
            held.pop(0).unpersist(blocking=True)
        return held[-1]

    try:
        yield stored
    finally:
        for df in held:
            df.unpersist(blocking=True)
        if was is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, was)


def overwritten(df: DataFrame, path: str, *by: str) -> None:
    """Write the partitions that ``df`` has in place of what was there; other partitions stay.

    Rows are rebalanced by partition, so a partition with a large part of the rows is split over tasks and files, and small
    ones share a task.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
