"""Random access by an index against whole reads: plain, in splits, compressed in members; repeats, order, bytes read."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from seqmill.sources import fastx, fastx_index


def members(text, size):
    """Text as block compression has it: members of ``size`` bytes, wherever records are."""
    return b"".join(gzip.compress(text[i : i + size]) for i in range(0, len(text), size))


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    rng = random.Random(11)
    d = tmp_path_factory.mktemp("fx")
    word = lambda a, b: "".join(rng.choice("ACGT") for _ in range(rng.randrange(a, b)))
    fastq = "".join(f"@r{i}{rng.choice(['', ' x', chr(9) + 'é y'])}\n{(s := word(0, 120))}\n+\n{'I' * len(s)}\n" for i in range(1, 5001)).encode()
    fasta = "".join(f">s{i} d {i}\n" + "".join(word(1, 60) + "\n" for _ in range(rng.randrange(4))) for i in range(1, 3001)).encode()
    (d / "a.fastq").write_bytes(fastq)
    (d / "b.fasta").write_bytes(fasta[:-1])
    (d / "c.fastq.gz").write_bytes(members(fastq, 10_000))
    (d / "d.fasta.gz").write_bytes(members(fasta, 333))
    (d / "e.fastq.gz").write_bytes(gzip.compress(fastq))
    (d / "f.fasta").write_bytes(b"")
    return d


@pytest.mark.parametrize("split", ["134217728", "50000"])
def test_records_are_those_of_a_whole_read(spark, files, split):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        whole = fastx.read_fastx(spark, str(files)).cache()
        index = fastx_index.build(spark, str(files), 50).cache()
        # every record lies in one range
        assert index.agg(F.sum(F.col("last_rec") - F.col("first_rec") + 1)).first()[0] == whole.count() == 5000 * 3 + 3000 * 2
        rng = random.Random(5)
        names = [r[0] for r in whole.select("file").distinct().collect()]
        ask = [(k, rng.choice(names), rng.choice([1, 2, 3000, rng.randrange(1, 3001)])) for k in range(1000)]
        wanted = spark.createDataFrame(ask, "req_pos long, file string, rec_idx long")
        got = fastx_index.read(index, wanted).orderBy("req_pos").collect()
        want = {(r["file"], r["rec_idx"]): r for r in whole.collect()}
        assert [tuple(r) for r in got] == [(k, *want[f, i]) for k, f, i in ask]
        # the same digest of a range of records, read by the index
        file = next(x for x in names if "c.fastq" in x)
        some = fastx_index.read(index, spark.range(100, 200).select(F.col("id").alias("req_pos"), F.lit(file).alias("file"), F.col("id").alias("rec_idx")))
        assert fastx.range_hash(some, 100, 100).first() == fastx.range_hash(whole.filter(F.col("file") == file), 100, 100).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_few_bytes_are_read(spark, files):
    index = fastx_index.build(spark, str(files), 50)
    for name in ("a.fastq", "c.fastq.gz", "d.fasta.gz"):
        wanted = spark.createDataFrame([(f"file://{files}/{name}", i) for i in (7, 8, 2500, 2501)], "file string, rec_idx long").withColumn("file", F.regexp_replace("file", "file:///", "file:/"))
        own = index.withColumn("file", F.regexp_replace("file", "file:///", "file:/"))
        r = fastx_index.ranges(own, wanted).agg(F.sum(F.col("stop") - F.col("offset")), F.count(F.lit(1)), F.sum(F.size("need"))).first()
        assert r[2] == 4 and r[1] <= 3 and r[0] < (files / name).stat().st_size / 15, name
    assert fastx_index.read(index, wanted.limit(0).withColumn("req_pos", F.lit(1))).count() == 0


def test_blocked_files(spark, files, tmp_path):
    """One large member is rewritten as small ones, and read by ranges then."""
    reads = fastx.read_fastx(spark, str(files / "e.fastq.gz"))
    assert fastx_index.build(spark, str(files / "e.fastq.gz")).count() == 1
    path = fastx_index.blocked(reads, str(tmp_path / "out.fastq"), every=500)
    index = fastx_index.build(spark, path)
    assert index.count() >= 10 and index.agg(F.max(F.col("last_rec") - F.col("first_rec"))).first()[0] < 500
    assert index.agg(F.sum("last_rec")).first()[0] == 5000
