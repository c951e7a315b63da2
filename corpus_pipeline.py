"""Corpus pipeline: quality, language, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. Null texts count as empty.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqmill.llm import langid, neardup, packing, quality
from seqmill.llm.common import discard, filtered, merged, stored, table

LOG = logging.getLogger("corpus_pipeline")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from a bounded sample of ``labels`` and these texts."""
    model = spark.sparkContext.broadcast(quality.fit(*quality.sample(docs, table(spark, sf_dir, "labels"))))
    return filtered(merged(docs), "text", lambda m, texts: (m.score(texts) >= quality.ACCEPT).tolist(), model)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the languages that ``lang`` names, as the classifier's margins tell; those without a letter go."""
    model = spark.sparkContext.broadcast(langid.calibrated(*langid.sample(docs)))
    return filtered(merged(docs), "text", lambda m, texts: m.accepts(texts), model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: five words, similarity 0.8.

    Rows with a null id all stay. Of several rows with one id the one whose text, and then
    whose other columns as JSON, sort first stays; a null text sorts as empty.
    """
    docs = merged(docs)
    found = neardup.groups(docs)
    found = stored(found, "groups", rows=docs.count())
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    few = gone.limit(neardup.FEW_IDS + 1).count() <= neardup.FEW_IDS
    left = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(docs.columns)
    twice = found.filter("doc_id = component_id").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if not twice.limit(1).count():
        return left
    # only rows of repeated ids are moved
    few = twice.limit(neardup.FEW_IDS + 1).count() <= neardup.FEW_IDS
    twice = F.broadcast(twice) if few else twice
    once = left.join(twice, "doc_id", "left_anti").select(docs.columns)
    order = F.struct(F.coalesce("text", F.lit("")).alias("t"), F.to_json(F.struct(*docs.columns)).alias("j"))
    shared = left.join(twice, "doc_id", "left_semi")
    LOG.warning("%d rows have their id in common with others; one row of each of %d ids stays", shared.count(), twice.count())
    first = shared.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), order).alias("row"))
    return once.unionByName(first.select("row.*"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the documents that are left."""
    return packing.pack(merged(docs))


STAGES = [("quality", good_quality), ("language", known_language), ("near_dedup", near_dedup), ("packing", packed)]

#: SQL can express none of the four; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result a table in the shared folder before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
