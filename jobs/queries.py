"""The jobs as queries: each runs twice into one new folder, and what is there then is returned."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import community_table, read_ledger
from seqmill.functions.session import shared_dir

_HERE = Path(__file__).resolve().parent
COMMUNITY = json.loads((_HERE / "community_table.json").read_text())
LEDGER = json.loads((_HERE / "read_ledger.json").read_text())


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def job1_community_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _folder(spark, "job1")
    for _ in range(2):
        community_table.run(spark, f"{sf_dir}/lineitem.parquet", f"{sf_dir}/part.parquet", out, **COMMUNITY)
    found = community_table.written(spark, out, COMMUNITY["ranks"])
    return found.withColumns({"uncross": F.round("uncross", 6), "share": F.round("share", 6)})


def job2_read_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _folder(spark, "job2")
    for _ in range(2):
        # a file stream takes a folder or a pattern, and the table may be one file
        read_ledger.run(spark, f"{sf_dir}/documents.parque[t]", out, f"{out}/checkpoint", **LEDGER)
    return read_ledger.written(spark, out)


QUERIES = {"job1_community_table": job1_community_table, "job2_read_ledger": job2_read_ledger}

ORACLE_SQL = {
    "job1_community_table": """
WITH t AS (SELECT coalesce(l_returnflag, 'unnamed') AS seqrun, CAST(l_suppkey AS VARCHAR) AS sample, l_partkey AS seq_idx, CAST(sum(l_quantity) AS BIGINT) AS nread FROM lineitem
  WHERE l_suppkey IS NOT NULL AND l_partkey IS NOT NULL AND l_quantity IS NOT NULL GROUP BY 1, 2, 3 HAVING sum(l_quantity) <> 0),
n AS (SELECT seqrun, count(DISTINCT sample) AS n FROM t GROUP BY 1),
s AS (SELECT t.*, 2 / (1 + exp(0.05 * nread / (0.05 * sum(nread) OVER (PARTITION BY seqrun, seq_idx) / n))) AS uncross FROM t JOIN n USING (seqrun)),
k AS (SELECT *, sum(nread) OVER (PARTITION BY seqrun, seq_idx) AS r, count(*) OVER (PARTITION BY seqrun, seq_idx) AS s FROM s WHERE uncross < 0.1),
c AS (SELECT *, nread / sum(nread) OVER (PARTITION BY seqrun, sample) AS share FROM k WHERE r >= 40 AND s >= 2)
SELECT seqrun, sample, seq_idx, nread, round(uncross, 6) AS uncross, round(share, 6) AS share, p_type AS family, p_brand AS genus, p_name AS species FROM c LEFT JOIN part ON p_partkey = seq_idx
""",
    "job2_read_ledger": """
SELECT coalesce(source, 'unnamed') AS sample, md5(text) AS seq_hash, count(*) AS nread, min(doc_id) AS first_id, CAST(max(length(text)) AS INTEGER) AS n_chars
FROM documents WHERE length(text) >= 20 GROUP BY 1, 2
""",
}
