"""The filter audit against SQL and against filters that are really applied in order, on odd tables too."""

import random
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from seqmill.llm import interactions
from tests.oracle import connect, rows


def applied(docs, names):
    """Rows of the audit from documents given as (part, set of failed filters, good, toxic), by applying each order."""
    out = []
    for part in sorted({d[0] for d in docs}):
        mine = [d for d in docs if d[0] == part]
        orders = {}
        for o in permutations(names):
            left = mine
            for step, f in enumerate(o, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                orders["".join(o), step] = (f, len(left), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone))
        total = {f: sum(v[2] for v in orders.values() if v[0] == f) for f in names}
        out += [(part, o, s, *v[1:], total[v[0]]) for (o, s), v in orders.items()]
    return sorted(out)


@pytest.mark.parametrize("names", ["A", "ABC", "ABCDE"])
def test_audit_is_what_orders_remove(spark, names):
    rng = random.Random(len(names))
    docs = [(rng.choice("xyz"), {f for f in names if rng.random() < 0.4}, rng.randrange(2), rng.randrange(2)) for _ in range(300)]
    table = spark.createDataFrame([(p, 1, g, t, *[int(f in fails) for f in names]) for p, fails, g, t in docs], "part string, n long, good long, toxic long, " + ", ".join(f"{f} int" for f in names))
    got = interactions.audit(table, list(names))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == applied(docs, names)


def test_filters_are_named_by_letters(spark):
    with pytest.raises(ValueError):
        interactions.audit(spark.range(1), ["long"])
    with pytest.raises(ValueError):
        interactions.audit(spark.range(1), [])


def test_odd_documents(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows and ids, clashing columns; labels that contradict each other."""
    long = "Word " * 60_000
    docs = [(None, "no id", "en"), (None, "no id", "en"), (1, None, None), (2, "", "en"), (3, long, "en"), (4, long, "de"), (4, long, "de"), (5, "no id", ""), (-6, "no id", "fr"), (7, "a b c d \x0b e $", None), (7, "x", "en")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"n": F.lit("x"), "A": F.lit(1), "digest": F.lit(2), "good": F.lit(9), "part": F.lit("q"), "salt": F.lit(0)}).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, None), (1, 0, 1), (4, None, None), (3, 1, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    got = interactions.op12_filter_audit(spark, str(tmp_path))
    con = connect("/root/testdata/sf0.001")
    for t in ("documents", "labels"):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    cur = con.execute(interactions.SQL)
    want = rows([x[0] for x in cur.description], cur.fetchall())
    assert rows(got.columns, map(tuple, got.collect())) == want and len(want) == 4 * 600
    # of the copies of one text only those behind the smallest id fail, wherever they are
    patterns = {(r["part"], r["E"]): r["n"] for r in interactions.patterns(spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "labels.parquet"))).groupBy("part", "E").agg(F.sum("n").alias("n")).collect()}
    assert patterns == {("", 0): 2, ("", 1): 1, ("en", 0): 4, ("en", 1): 1, ("de", 1): 2, ("fr", 0): 1}


def test_one_text_has_most_rows(spark):
    """A text with most of the rows is added up before it moves: few rows leave the exchange of digests."""
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 9, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    found = interactions.patterns(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["E"]: r["n"] for r in found.groupBy("E").agg(F.sum("n").alias("n")).collect()} == {0: 3001, 1: 26_999}
