"""The canonical relations over the driver's tables, as DataFrames and as SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import importable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: SQL of each view. A view that names another comes after it.
SQL: dict[str, str] = {
    "seqtab": "SELECT l_suppkey AS sample, l_partkey AS seq_idx, CAST(SUM(l_quantity) AS BIGINT) AS nread FROM lineitem GROUP BY 1, 2",
    "seqtab_runs": "SELECT l_suppkey AS sample, l_returnflag AS seqrun, l_partkey AS seq_idx, CAST(SUM(l_quantity) AS BIGINT) AS nread FROM lineitem GROUP BY 1, 2, 3",
    "seqs": "SELECT doc_id AS seq_idx, text AS seq FROM documents",
    "parts_seq": "SELECT p_partkey AS seq_idx, p_name || p_type AS seq FROM part",
    "hits": "SELECT p.seq_idx AS query, f.hit FROM parts_seq p JOIN (SELECT seq, MIN(seq_idx) AS hit FROM parts_seq GROUP BY seq) f USING (seq) WHERE p.seq_idx <> f.hit",
    "taxa": """SELECT p_partkey AS seq_idx, 'Fungi' AS kingdom, p_type AS phylum,
       CASE WHEN p_size <= 5 THEN 'pseudoclass_' || p_type ELSE 'class_' || substr(p_brand, 1, 7) END AS class,
       p_brand AS "order", CASE WHEN p_size > 45 THEN NULL ELSE 'fam_' || CAST(p_size AS VARCHAR) END AS family,
       CASE WHEN p_size > 35 THEN NULL ELSE p_name END AS genus,
       CASE WHEN p_size > 25 THEN NULL ELSE p_name || '_' || CAST(p_size AS VARCHAR) END AS species FROM part""",
    "reads": "SELECT event_id + 1 AS rec_idx, lower(hex(event_id + 1)) AS name, event_type, value, props FROM events",
    "otus": "SELECT t.*, s.nread, s.nsample FROM taxa t JOIN (SELECT seq_idx, CAST(SUM(nread) AS BIGINT) AS nread, COUNT(*) AS nsample FROM seqtab GROUP BY 1) s USING (seq_idx)",
    "paths": "SELECT DISTINCT concat_ws(',', r_name, n_name, c_mktsegment) AS classification FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "matches": """SELECT a.sample, a.seq_idx AS seq_idx1, b.seq_idx AS seq_idx2, a.nread AS nread1, b.nread AS nread2, CAST(b.seq_idx - a.seq_idx AS DOUBLE) / 100 AS dist
       FROM seqtab a JOIN seqtab b ON a.sample = b.sample AND b.seq_idx > a.seq_idx AND b.seq_idx - a.seq_idx <= 3""",
}
_NEEDS = {"hits": ["parts_seq"], "otus": ["taxa", "seqtab"], "matches": ["seqtab"]}


def with_views(body: str, *names: str, recursive: bool = False) -> str:
    """SQL that has the named views, and what they need, before the body; a body may begin with further ones after a comma."""
    order: list[str] = []
    for n in names:
        for x in [*_NEEDS.get(n, []), n]:
            if x not in order:
                order.append(x)
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(f"{n} AS ({SQL[n]})" for n in order) + "\n" + body


def seqtab(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("sample"), F.col("l_partkey").alias("seq_idx")).agg(F.sum("l_quantity").cast("bigint").alias("nread"))


def seqtab_runs(spark: SparkSession, d: str) -> DataFrame:
    keys = [F.col("l_suppkey").alias("sample"), F.col("l_returnflag").alias("seqrun"), F.col("l_partkey").alias("seq_idx")]
    return table(spark, d, "lineitem").groupBy(*keys).agg(F.sum("l_quantity").cast("bigint").alias("nread"))


def seqs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("seq_idx"), F.col("text").alias("seq"))


def parts_seq(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("seq_idx"), F.concat("p_name", "p_type").alias("seq"))


def taxa(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("seq_idx"),
        F.lit("Fungi").alias("kingdom"),
        F.col("p_type").alias("phylum"),
        F.when(size <= 5, F.concat(F.lit("pseudoclass_"), "p_type")).otherwise(F.concat(F.lit("class_"), F.substring("p_brand", 1, 7))).alias("class"),
        F.col("p_brand").alias("order"),
        F.when(size <= 45, F.concat(F.lit("fam_"), size.cast("string"))).alias("family"),
        F.when(size <= 35, F.col("p_name")).alias("genus"),
        F.when(size <= 25, F.concat("p_name", F.lit("_"), size.cast("string"))).alias("species"),
    )


def reads(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select((F.col("event_id") + 1).alias("rec_idx"), F.lower(F.hex(F.col("event_id") + 1)).alias("name"), "event_type", "value", "props")


def otus(spark: SparkSession, d: str) -> DataFrame:
    n = seqtab(spark, d).groupBy("seq_idx").agg(F.sum("nread").cast("bigint").alias("nread"), F.count(F.lit(1)).alias("nsample"))
    return taxa(spark, d).join(n, "seq_idx")


def paths(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.select(F.concat_ws(",", "r_name", "n_name", "c_mktsegment").alias("classification")).distinct()


def matches(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours by id in a sample: ids within three of each other are found by their shifted values, as an equi-join."""
    t = seqtab(spark, d)
    a = t.select("sample", F.col("seq_idx").alias("seq_idx1"), F.col("nread").alias("nread1"), F.explode(F.array(*[F.col("seq_idx") + k for k in (1, 2, 3)])).alias("seq_idx2"))
    b = t.select("sample", F.col("seq_idx").alias("seq_idx2"), F.col("nread").alias("nread2"))
    return a.join(b, ["sample", "seq_idx2"]).select("sample", "seq_idx1", "seq_idx2", "nread1", "nread2", ((F.col("seq_idx2") - F.col("seq_idx1")) / F.lit(100.0)).alias("dist"))


def headers(spark: SparkSession, d: str, kind: str) -> DataFrame:
    """Parts' taxa written as headers of a format, placeholders for what is unknown."""
    t = taxa(spark, d).na.fill("NA")
    ranks = ["kingdom", "phylum", "class", "order", "family", "genus", "species"]
    own = F.concat(F.lit("s"), F.col("seq_idx").cast("string"))
    if kind == "sintax":
        h = F.concat(own, F.lit(";tax="), F.concat_ws(",", *[F.concat(F.lit(f"{r[0]}:"), r) for r in ranks]), F.lit(";"))
    elif kind == "unite":
        h = F.concat(own, F.lit("|"), F.concat_ws(";", *[F.concat(F.lit(f"{r[0]}__"), r) for r in ranks]), F.lit("|SH1"))
    elif kind == "bold":
        h = F.concat(own, F.lit("|a|"), F.concat_ws(",", *ranks[:5], F.lit(""), F.lit(""), *ranks[5:], F.lit("")))
    else:
        h = F.concat(own, F.lit(" Root;"), F.concat_ws(";", *ranks))
    return t.select(h.alias("header"))
