"""The jobs: equal to SQL, the same when run again, over growing input, after failures, from the command line."""

import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobs import common, community_table, queries, read_ledger
from tests.oracle import same

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_same_rows_as_sql(spark, sf_dir, name):
    same(spark, sf_dir, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_counts_are_scored_once(spark):
    """What sums, shares and rows read is stored, and rows aren't sorted to meet totals."""
    rows = [(f"r{i % 2}", f"s{i % 7}", i % 5, 1 + i * i % 40) for i in range(70)]
    table = spark.createDataFrame(rows, "seqrun string, sample string, seq_idx long, nread long").distinct()
    out = community_table.cleaned(table, 0.05, 0.05, 1.0, 1, 1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() and "EXP(" not in plan and "strategy=shuffle_hash" in plan


def test_rows_are_not_dealt_by_run(spark):
    """Runs are few, so rows that were dealt by run would be in as few tasks."""
    from seqmill.operators import tagjump

    table = spark.range(50).selectExpr("'r' seqrun", "id % 7 sample", "id % 5 seq_idx", "id + 1 nread")
    plan = tagjump.score(table, 0.05, 0.05, by="seqrun")._jdf.queryExecution().optimizedPlan().toString()
    assert "(strategy=broadcast)" in plan


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("part-*")}


def plain(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def arriving(spark, sf_dir, tmp_path):
    """A folder, and a function that lets a share of the documents arrive there as a new file."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", "src1", 0), (9002, "short", "en", "src1", 5), (9003, "a sequence without a sample " * 2, "en", None, 0), (None, "a sequence without an id " * 2, "en", "x/y=z", 0)], docs.schema)
    docs = docs.union(docs.filter("doc_id % 7 = 0").withColumn("doc_id", F.col("doc_id") + 5000)).union(odd)
    folder = tmp_path / "reads"
    folder.mkdir()

    def arrive(k):
        docs.filter(F.coalesce(F.col("doc_id"), F.lit(0)) % 3 == k).coalesce(1).write.parquet(str(tmp_path / f"new{k}"))
        (part,) = (tmp_path / f"new{k}").glob("part-*")
        shutil.copy(part, folder / f"{k}.parquet")

    return folder, arrive


def expected(spark, folder):
    d = spark.read.parquet(str(folder)).filter("length(text) >= 20")
    return plain(d.groupBy(F.coalesce("source", F.lit("unnamed")).alias("sample"), F.md5("text").alias("seq_hash")).agg(F.count(F.lit(1)), F.min("doc_id"), F.max(F.length("text"))).na.fill({"min(doc_id)": -1}))


def found(spark, out):
    return plain(read_ledger.written(spark, out).na.fill({"first_id": -1}))


def test_ledger_over_growing_input(spark, arriving, tmp_path):
    folder, arrive = arriving
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    arrive(0)
    (first,) = read_ledger.run(spark, str(folder), out, mark, **queries.LEDGER)
    assert found(spark, out) == expected(spark, folder)
    before = files(out)
    assert read_ledger.run(spark, str(folder), out, mark, **queries.LEDGER) == [] and files(out) == before
    arrive(1)
    arrive(2)
    more = read_ledger.run(spark, str(folder), out, mark, **{**queries.LEDGER, "files_per_batch": 1})
    assert len(more) == 2 and found(spark, out) == expected(spark, folder)
    # each row was read once, each sequence written once
    assert sum(x["rows"] for x in (first, *more)) == spark.read.parquet(str(folder)).count()
    assert sum(x["rows"] - x["reads"] for x in (first, *more)) == spark.read.parquet(str(folder)).filter("text is null or length(text) < 20").count() >= 2
    known = read_ledger.stored(spark, out, "sequences", read_ledger.SEQUENCES)
    assert known.count() == known.select("seq_hash").distinct().count() == read_ledger.written(spark, out).select("seq_hash").distinct().count()
    # what the first batch wrote was not touched again
    assert {k: v for k, v in before.items() if "abundance" not in k}.items() <= files(out).items()


def test_ledger_mends_what_failed(spark, arriving, tmp_path):
    """A batch that is done twice, and sums that a failure left behind or half replaced."""
    folder, arrive = arriving
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    arrive(0)
    settings = read_ledger.DEFAULTS | queries.LEDGER
    batch = spark.read.parquet(str(folder))
    assert read_ledger.take(batch, 0, out, settings) == read_ledger.take(batch, 0, out, settings)
    read_ledger.run(spark, str(folder), out, mark, **queries.LEDGER)
    assert found(spark, out) == expected(spark, folder)
    arrive(1)
    read_ledger.take(spark.read.parquet(str(folder / "1.parquet")), 1, out, settings)  # and then no sums
    shutil.rmtree(Path(out) / "abundance" / "sample=src1")
    read_ledger.run(spark, str(folder), out, mark, **queries.LEDGER)
    assert found(spark, out) == expected(spark, folder)
    before = files(out)
    assert read_ledger.refresh(spark, out) == 0 and files(out) == before


def test_ledger_of_nothing(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(str(tmp_path / "reads"))
    read_ledger.run(spark, str(tmp_path / "reads"), str(tmp_path / "out"), str(tmp_path / "mark"), **queries.LEDGER)
    assert found(spark, str(tmp_path / "out")) == []


def test_community_again_and_by_run(spark, sf_dir, tmp_path):
    d, out = f"{sf_dir}/lineitem.parquet", str(tmp_path / "out")
    taxa = f"{sf_dir}/part.parquet"
    said = community_table.run(spark, d, taxa, out, **queries.COMMUNITY)
    whole = plain(community_table.written(spark, out, queries.COMMUNITY["ranks"]))
    assert said["read"]["rows"] == spark.read.parquet(d).count() and said["wrote"]["rows"] == len(whole) > 0
    before = files(out)
    community_table.run(spark, d, taxa, out, **queries.COMMUNITY, runs=["N"])
    assert plain(community_table.written(spark, out, queries.COMMUNITY["ranks"])) == whole
    after = files(out)
    assert {k for k in before if "seqrun=N" not in k} == {k for k in after if "seqrun=N" not in k} and not {k for k in before if "seqrun=N" in k} & set(after)


def test_community_leaves_nothing_but_its_output(spark, sf_dir, tmp_path):
    """No checkpoint, stored table or changed setting stays behind, also when the job fails."""
    from seqmill.functions.session import shared_dir

    scratch = Path(shared_dir(spark).removeprefix("file:"))
    before, held, was = files(scratch), spark.sparkContext._jsc.getPersistentRDDs().size(), spark.conf.get(common.CLEANUP, None)
    community_table.run(spark, f"{sf_dir}/lineitem.parquet", f"{sf_dir}/part.parquet", str(tmp_path / "out"), **queries.COMMUNITY)
    with pytest.raises(ZeroDivisionError), common.without_leftovers(spark) as stored:
        assert stored(stored(spark.range(9)).filter("id > 3")).count() == 5 and spark.conf.get(common.CLEANUP) == "true"
        raise ZeroDivisionError
    assert files(scratch) == before and spark.sparkContext._jsc.getPersistentRDDs().size() == held and spark.conf.get(common.CLEANUP, None) == was


def test_community_of_odd_rows(spark, tmp_path):
    rows = [("r", "a", 1, 5.0), ("r", "a", 1, 5.0), (None, "a", 1, 7.0), ("r", None, 1, 1.0), ("r", "b", None, 1.0), ("r", "b", 2, None), ("r", "b", 3, 4.0)]
    spark.createDataFrame(rows, "seqrun string, sample string, seq_idx long, nread double").withColumns({"key": F.lit(1), "total": F.lit("x"), "genus": F.lit("own")}).write.parquet(str(tmp_path / "counts"))
    spark.createDataFrame([(1, "G"), (1, "F"), (None, "H")], "seq_idx long, g string").write.parquet(str(tmp_path / "taxa"))
    said = community_table.run(spark, str(tmp_path / "counts"), str(tmp_path / "taxa"), str(tmp_path / "out"), ranks={"genus": "g"}, least_score=3.0)
    assert said["read"] == {"rows": 7, "dropped": 3}
    got = community_table.written(spark, str(tmp_path / "out"), {"genus": "g"}).select("seqrun", "sample", "seq_idx", "nread", "share", "genus")
    assert set(map(tuple, got.collect())) == {("r", "a", 1, 10, 1.0, "F"), ("unnamed", "a", 1, 7, 1.0, "F"), ("r", "b", 3, 4, 1.0, None)}


def test_community_of_nothing(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(0).write.parquet(str(tmp_path / "counts"))
    said = community_table.run(spark, str(tmp_path / "counts"), f"{sf_dir}/part.parquet", str(tmp_path / "out"), **queries.COMMUNITY)
    assert said == {"read": {"rows": 0, "dropped": 0}, "wrote": {"rows": 0, "reads": 0}}


def test_settings(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"min_length": 3}))
    assert common.configured(spark, str(tmp_path / "c.json"), read_ledger.DEFAULTS) == read_ledger.DEFAULTS | {"min_length": 3}
    (tmp_path / "c.json").write_text(json.dumps({"wrong": 3}))
    with pytest.raises(ValueError):
        common.configured(spark, str(tmp_path / "c.json"), read_ledger.DEFAULTS)


def test_command_line(spark, arriving, tmp_path):
    folder, arrive = arriving
    arrive(0)
    args = ["--reads", str(folder), "--output", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "mark"), "--config", str(ROOT / "jobs/read_ledger.json")]
    env = os.environ | {"PYTHONPATH": str(ROOT), "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=2 --conf spark.ui.enabled=false pyspark-shell"}
    done = subprocess.run([sys.executable, "-m", "jobs.read_ledger", *args], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "1 new batches" in done.stderr and "new sequences" in done.stderr
    assert found(spark, str(tmp_path / "out")) == expected(spark, folder)
