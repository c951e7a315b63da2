import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqmill.config import PipelineConfig
from seqmill.functions import taxa
from seqmill.functions.dna import IUPAC
from seqmill.functions.session import numbered, running_count
from seqmill.operators import abundance, chimera, cluster, curation, rollup, sampling, samples, sequence, tagjump, taxonomy
from seqmill.sources import adapters, fastx, tables
from seqmill.streaming import summaries


def test_distribute():
    assert cluster.distribute([8, 7, 6, 5, 4, 3, 2, 1], 5) == [1, 2, 3, 4, 5, 6, 6, 5]
    rng = random.Random(0)
    for _ in range(50):
        w = [rng.randint(0, 9) for _ in range(rng.randint(0, 40))]
        bins, want = [], []
        for x in w:
            k = next((i for i, b in enumerate(bins) if x <= 7 and b + x <= 7), None)
            if k is None:
                k = len(bins)
                bins.append(0)
            bins[k] += x if x <= 7 else 100
            want.append(k + 1)
        assert cluster.distribute(w, 7) == want


def test_numbering(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS x").repartition(7)
    assert [r[1] for r in numbered(df, "x").orderBy("x").select("x", "row_no").collect()] == list(range(1, 1001))
    marks = spark.createDataFrame([(3,), (3,), (70000,)], "m long")
    got = dict(running_count(spark.createDataFrame([(1,), (3,), (69999,), (70000,), (200000,)], "k long"), "k", marks, "m", "n").select("k", "n").collect())
    assert got == {1: 0, 3: 1, 69999: 1, 70000: 2, 200000: 2}


def test_dedup_renumber(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "a", 3), (4, "b", 4), (5, "b", 5)], "seq_idx long, sample string, nread long")
    hits = spark.createDataFrame([(2, 1), (4, 3)], "query long, hit long")
    got = sorted(map(tuple, abundance.deduplicate(t, hits).select("seq_idx", "sample", "nread").collect()))
    assert got == [(1, "a", 3), (2, "a", 3), (2, "b", 4), (3, "b", 5)]
    assert abundance.ensure_row(t.filter("false")).count() == 1


def test_tag_jump(spark):
    t = spark.createDataFrame([("s", "x", 1), ("t", "x", 99)], "sample string, seq string, nread long")
    row = tagjump.score(t, 0.05, 1, "seq").filter("nread = 1").first()
    assert row["is_tag_jump"] and abs(row["uncross"] - 0.8026) < 1e-4
    assert tagjump.score(t.filter("false"), 0.05, 1, "seq").count() == 0


def test_chimera(spark):
    assert chimera.is_bimera("AAAACCCC", ["AAAAGGGG", "TTTTCCCC"])
    assert not chimera.is_bimera("AAAACCCC", ["AAAAGGGG"]) and not chimera.is_bimera("AAAACCCC", ["AAAACCCC", "AAAAGGGG"])
    f = spark.createDataFrame([(1, 3, 3), (2, 0, 3), (3, 2, 3), (4, 1, 3), (5, 0, 0)], "seq_idx int, nflag long, nsam long")
    assert sorted(r[0] for r in chimera.consensus(f).collect()) == [1, 3, 5]
    t = spark.createDataFrame([("s", 1, 100), ("s", 2, 90), ("s", 3, 5)], "sample string, seq_idx int, nread long")
    s = spark.createDataFrame([(1, "AAAAGGGG"), (2, "TTTTCCCC"), (3, "AAAACCCC")], "seq_idx int, seq string")
    assert {r[0]: r[1] for r in chimera.flag_samples(t, s).collect()} == {1: 0, 2: 0, 3: 1}


def test_curation_against_walk(spark):
    """The greedy walk in order of ids, one child at a time, gives the same parents."""
    rng = random.Random(4)
    table = {(s, i): rng.randint(1, 40) for s in range(12) for i in range(1, 9) if rng.random() < 0.7}
    occ = {i: sum(k[1] == i for k in table) for i in range(1, 9)}
    total = {i: sum(v for k, v in table.items() if k[1] == i) for i in range(1, 9)}
    order = sorted((i for i in occ if occ[i]), key=lambda i: (-occ[i], -total[i], i))
    pairs = [(s, i, j, table[s, i], table[s, j], 0.05) for s in range(12) for i in range(1, 9) for j in range(i + 1, 9) if (s, i) in table and (s, j) in table]
    parent = {}
    for c in order:
        parent[c] = c
        for p in order[: order.index(c)]:
            both = [(table[s, p], table[s, c]) for s in range(12) if (s, p) in table and (s, c) in table]
            if both and len(both) >= 0.5 * occ[c] and min(a / b for a, b in both) > 0.1:
                parent[c] = parent[p]
                break
    t = spark.createDataFrame([(str(s), i, n) for (s, i), n in table.items()], "sample string, seq_idx long, nread long")
    m = spark.createDataFrame([(str(p[0]), *p[1:]) for p in pairs], "sample string, seq_idx1 long, seq_idx2 long, nread1 long, nread2 long, dist double")
    got = dict(curation.parent_map(t, m, 0.1, 0.1, 0.5).collect())
    assert got == parent
    merged = curation.merged_table(t, curation.parent_map(t, m, 0.1, 0.1, 0.5))
    assert merged.agg({"nread": "sum"}).first()[0] == sum(table.values())


def test_nuclear_copies(spark):
    rows = spark.createDataFrame([("clean", "ACGACG"), ("gap", "ACGA--CG"), ("stop", "ATAACG"), ("null", None)], "seq_id string, seq string")
    got = sorted(map(tuple, sequence.nuclear_copies(rows).collect()))
    assert got == [("gap", "frameshift", 5, 2), ("stop", "stop_codon", 2, 3)]


def test_cigar():
    assert sequence.walk_cigar("AC", "AC", "IJ", "=") == [("A2A", 40), ("C2C", 41)]
    assert sequence.walk_cigar("ACG", "ATG", "III", "1=1X1=") == [("A2A", 40), ("C2T", 40), ("G2G", 40)]
    assert len(sequence.walk_cigar("AG", "ATG", "III", "1=1I1=", indel=True)) == 4


def test_error_rates():
    counts = np.ones((16, 4)) * 10
    r = sequence.error_rates(counts, np.array([2, 11, 25, 37]))
    assert r.shape == (16, 4) and np.allclose(r.reshape(4, 4, 4).sum(1), 1)
    # by hand: A2C 10 of 100 at 2 and 1 of 100 at 6, linear between, flat beyond; none of 11; T has no letters
    scores = np.arange(9)
    counts = np.zeros((16, 9))
    counts[0, [2, 6]], counts[1, [2, 6]] = [90, 99], [10, 1]
    r = sequence.error_rates(counts, scores, (2, 6, 11))
    assert np.allclose(r[1], [0.1, 0.1, 0.1, 0.0775, 0.055, 0.0325, 0.01, 0.01, 0.01])
    assert np.allclose(r[2], 1e-7) and np.allclose(r[0], 1 - r[1] - 2e-7) and np.allclose(r[12], 0.25)
    for bad in ((3, 6), (2, 5)):
        with pytest.raises(ValueError):
            sequence.error_rates(counts, scores, bad)


def test_smoothed_rates():
    scores = np.arange(41)
    true = 10 ** (-1 - 0.05 * scores - 0.001 * (scores - 20) ** 2)
    total = np.full(41, 1e9)
    counts = np.zeros((16, 41))
    for a in range(4):
        for b in range(4):
            counts[4 * a + b] = total * (true if a != b else 1 - 3 * true)
    counts[:, [0, 1, 40]] = 0
    r = sequence.smoothed_rates(counts, scores)
    assert np.allclose(r.reshape(4, 4, -1).sum(1), 1)
    assert np.allclose(np.log10(r[1][2:40]), np.log10(np.clip(true, 1e-7, 0.25))[2:40], atol=0.02) and r[1][0] == r[1][2] and r[1][40] == r[1][39]


def test_gaps_and_near_pairs(spark):
    rng = random.Random(3)

    def slow(a, b):
        w, far = len(a) + len(b) + 1, {}
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                ways = [far[i - 1, j - 1] + w * (a[i - 1] != b[j - 1])] if i and j else []
                ways += [far[i - 1, j] + w + 1] if i else []
                ways += [far[i, j - 1] + w + 1] if j else []
                far[i, j] = min(ways, default=0)
        return divmod(far[len(a), len(b)], w)  # edits, gap letters

    words = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 60))) for _ in range(30)]
    for t in list(words):
        for _ in range(2):
            x = list(t)
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(x) + 1)
                x[k : k + rng.randrange(2)] = rng.choice(["", "A", "CC"])
            words.append("".join(x))
    words += ["", "", "A" * 40, "A" * 42, "AC" * 20, "AC" * 21]
    for a, b in zip(words, words[1:], strict=False):
        edits, gaps = slow(a, b)
        columns, found, longest = curation.gap_stats(a, b, edits)
        assert found == gaps and columns == (len(a) + len(b) + gaps) // 2 and (longest > 0) == (gaps > 0) and longest <= gaps
    assert curation.gap_stats("AACCGGTT", "AAGGTT", 2) == (8, 2, 2)
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)] + [(999, None)], "seq_idx long, seq string")
    for t in (0.0, 0.1, 0.3):
        got = {(r[0], r[1]): r[2] for r in curation.near_pairs(df, t).collect()}
        want = {}
        for j, b in enumerate(words):
            for i, a in enumerate(words[:j]):
                top = max(len(a), len(b))
                if abs(len(a) - len(b)) <= int(top * t + 1e-9) and (e := slow(a, b)[0]) <= int(top * t + 1e-9):
                    want[i, j] = e / max(top, 1)
        assert got == want
    table = spark.createDataFrame([(1, 0, 5), (1, 30, 6), (2, 30, 7)], "sample long, seq_idx long, nread long")
    rows = curation.sample_matches(table, df, 0.5, gaps=True).collect()
    assert all(r["sample"] == 1 and r["align_length"] >= r["n_gap"] >= r["max_gap"] for r in rows)


def test_greedy_clusters(spark):
    rng = random.Random(5)
    edges = {(i, j): rng.choice([0.1, 0.2]) for i in range(60) for j in range(i + 1, 60) if rng.random() < 0.06}
    got = dict(map(tuple, cluster.greedy(spark.createDataFrame([(i, j, d) for (i, j), d in edges.items()], "id long, id2 long, dist double"), spark.range(60)).collect()))
    centroids, want = [], {}
    for j in range(60):
        near = [(edges[i, j], i) for i in centroids if (i, j) in edges]
        if near:
            want[j] = min(near)[1]
        else:
            centroids.append(j)
    assert got == want and len(want) > 20


def test_odd_headers_and_vectors(spark):
    h = lambda *x: spark.createDataFrame([(t,) for t in x], "header string")
    assert [tuple(r)[:3] for r in taxonomy.parse_sintax(h("a;tax=d:X,d:Y,k:Z", "b", None, "c;size=2;tax=k:Q;")).select("seq_id", "domain", "kingdom").collect()] == [("a", "X", "Z"), ("b", None, None), (None, None, None), ("c", None, "Q")]
    assert [(r["seq_id"], r["kingdom"], r["phylum"]) for r in taxonomy.parse_unite(h("a|k__X;k__Y;p__|z", "b", None)).collect()] == [("a", "X", None), ("b", None, None), (None, None, None)]
    assert sequence.walk_cigar("ACGT", "AC", "II", "4=2I1D") == [("A2A", 40), ("C2C", 40)]
    v = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [1.0, 0.1]), (3, "a", None), (4, "a", [1.0, None]), (5, "a", [1.0]), (6, "a", [0.0, 0.0]), (7, None, [1.0, 0.0])], "id long, block string, v array<double>")
    assert {(r["id"], r["id2"]) for r in cluster.vector_pairs(v, v, "block", 0.5).filter("id < id2").collect()} == {(1, 2)}
    hits = spark.createDataFrame([(3, 1), (3, 2)], "query long, hit long")
    table = spark.createDataFrame([(1, i, 1) for i in (1, 2, 3)], "sample long, seq_idx long, nread long")
    assert sorted(map(tuple, abundance.collapse(table, hits)[1].collect())) == [(1, 1), (2, 2), (3, 1)]


def test_top_leaves(spark):
    rows = spark.createDataFrame([("s", "a,b", 0.5), ("s", "a,c", 0.3), ("s", "d,e", 0.3), ("s", "d,f", 0.1)], "seq_id string, path string, prob double")
    got = {(r["parent_taxonomy"], r["taxon"]): round(r["prob"], 9) for r in taxonomy.path_probabilities(rows, most=2).collect()}
    assert got == {(None, "a"): 0.8, ("a", "b"): 0.5, ("a", "c"): 0.3}


def test_fastx_in_splits(spark, tmp_path):
    """Small splits, several files, empty reads, and records over many lines, all numbered as in the files."""
    rng = random.Random(4)
    fq = [[(f"r{i} {'x' * rng.randrange(3)}", "ACGT" * rng.randrange(5)) for i in range(300)] for _ in range(2)]
    for k, reads in enumerate(fq):
        (tmp_path / f"{k}.fastq").write_text("".join(f"@{h}\r\n{s}\r\n+\r\n{'I' * len(s)}\r\n" for h, s in reads) + "\r\n")
    fa = [(f"s{i}", ["AC" * rng.randrange(1, 30) for _ in range(rng.randrange(6))]) for i in range(200)]
    (tmp_path / "ba.fa").write_text("; a comment\n" + "".join(f">{h}\n" + "".join(x + "\n" for x in s) for h, s in fa))
    (tmp_path / "a.fa").write_text(">only\nA\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = fastx.read_fastx(spark, str(tmp_path)).collect()
        assert fastx._lines(spark, [str(tmp_path / "ba.fa")]).select("block").distinct().count() > 5
        one = fastx.read_fastx(spark, str(tmp_path / "0.fastq"))
        a, b = (fastx.range_hash(one.withColumn("rec_idx", x), 10, 50).first()[0] for x in (one.rec_idx, 301 - one.rec_idx))
        assert a == fastx.range_hash(one.repartition(5), 10, 50).first()[0] != b
        assert [r["name"] for r in fastx.joined(fastx.read_fastx(spark, [str(tmp_path / "a.fa"), str(tmp_path / "ba.fa")]), ["a.fa"]).collect()] == ["only"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by = lambda name: [(r["name"], r["description"], r["seq"], r["qual"]) for r in sorted((r for r in rows if r["file"].endswith("/" + name)), key=lambda r: r["rec_idx"])]
    for k, reads in enumerate(fq):
        assert by(f"{k}.fastq") == [(*h.split(" ", 1), s, "I" * len(s)) for h, s in reads]
    assert by("ba.fa") == [(h, "", "".join(s), None) for h, s in fa]
    assert sorted(r["rec_idx"] for r in rows if r["file"].endswith("ba.fa")) == list(range(1, 201))


def test_samples_are_nested(spark):
    reads = spark.range(1, 1001).withColumnRenamed("id", "rec_idx")
    small = {r[0] for r in sampling.sample_number(reads, 10).collect()}
    large = {r[0] for r in sampling.sample_number(reads, 20).collect()}
    assert len(small) == 10 and len(large) == 20 and small < large
    few = {r[0] for r in sampling.sample_fraction(reads, 3, 100).collect()}
    many = {r[0] for r in sampling.sample_fraction(reads, 50, 100).collect()}
    assert len(few) == 30 and few < many
    a, b = sampling.unpaired(sampling.sample_number(sampling.paired(reads.selectExpr("rec_idx", "rec_idx AS name"), reads.selectExpr("rec_idx", "rec_idx AS name")), 10))
    assert {r[0] for r in a.collect()} == {r[0] for r in b.collect()}


def test_truncate(spark):
    df = spark.createDataFrame([("a,b,c",)], "p string")
    from pyspark.sql import functions as F

    assert tuple(df.select(taxa.truncate(F.col("p"), 2), taxa.truncate(F.col("p"), 4)).first()) == ("a,b", None)
    assert df.select(taxa.sintax_format(F.col("p"))).first()[0] == "tax=d:a,p:b,c:c;"


def test_header_dispatch(spark):
    for h, want in ((["x;tax=k:Fungi,p:Asco"], "Fungi"), (["x|k__Fungi;p__Asco|y"], "Fungi"), (["x Root;Fungi;Asco"], "Fungi")):
        out = taxonomy.parse_headers(spark.createDataFrame([(x,) for x in h], "header string"))
        assert out.first()["kingdom"] == want and out.first()["phylum"] == "Asco"
    assert taxonomy.parse_headers(spark.createDataFrame([("nothing",)], "header string")) is None


def test_trees(spark):
    p = spark.createDataFrame([("Fungi,A",), ("Fungi,B",), ("Fungi",), ("nonFungi",)], "classification string")
    t = {r["classification"]: r for r in taxonomy.tree(p).collect()}
    assert t["root"]["prior"] == 1 and t["Fungi"]["prior"] == 0.99 and t["nonFungi"]["prior"] == 0.01
    assert t["Fungi,A"]["parent_id"] == t["Fungi"]["taxon_id"] and abs(t["Fungi,A"]["prior"] - 0.495) < 1e-9
    t = {r["classification"]: r for r in taxonomy.tree_by_leaves(p).collect()}
    assert abs(t["Fungi"]["prior"] - 2 / 3) < 1e-9 and t["nonFungi"]["taxon_id"] == 2


def test_fastx_round_trip(spark, tmp_path):
    src = tmp_path / "r.fastq"
    src.write_text("".join(f"@r{i} more\nACGT{'A' * i}\n+\nIIII{'I' * i}\n" for i in range(20)))
    reads = fastx.read_fastx(spark, str(src)).drop("file", "description")
    parts = fastx.split_round_robin(reads, 3)
    back = fastx.interleave(parts.drop("rec_idx"))
    assert sorted(map(tuple, back.select("rec_idx", "name", "seq").collect())) == sorted(map(tuple, reads.select("rec_idx", "name", "seq").collect()))
    fa = tmp_path / "r.fasta"
    fa.write_text(">a x\nAC\nGT\n>b\nTT\n")
    assert [tuple(r) for r in fastx.read_fastx(spark, str(fa)).orderBy("rec_idx").select("name", "description", "seq").collect()] == [("a", "x", "ACGT"), ("b", "", "TT")]
    got = fastx.extract(reads, spark.createDataFrame([(1, 5), (2, 5), (3, 1)], "req_pos long, rec_idx long"))
    assert [r["name"] for r in got.orderBy("req_pos").collect()] == ["r4", "r4", "r0"]
    assert spark.read.text(fastx.write_fastx(reads, str(tmp_path / "out"))).count() == 80
    with pytest.raises(ValueError):
        fastx.rename(reads, reads.limit(3).select("rec_idx", "name"))


def test_tables(spark, tmp_path):
    empty = tmp_path / "e.tsv"
    empty.write_text("")
    assert tables.read_long_table(spark, str(empty)).columns == ["sample", "seq_id", "nread", "seqrun"]
    t = tmp_path / "t.tsv"
    t.write_text("a\tFungi;Asco\n")
    assert tables.read_taxonomy_table(spark, str(t)).first()["phylum"] == "Asco"
    bad = tmp_path / "b.tsv"
    bad.write_text("a\tb\tc\td\te\n")
    with pytest.raises(ValueError):
        tables.read_taxonomy_table(spark, str(bad))
    f = tmp_path / "s.tbl"
    f.write_text("# idx name len\n#-- ---- ---\n  1 seqA 100\n  2 -     50\n")
    got = [tuple(r) for r in tables.read_fixed_width(spark, str(f), "idx int, seq_name string, length int").collect()]
    assert got == [(1, "seqA", 100), (2, "-", 50)]
    assert tables.parse_model("Model of substitution: GTR+F\n  A-C: 1.5\n  A-G: 2.5\n pi(A) = 0.3\nGamma shape alpha: 0.7") == "GTR{1.5/2.5}+FU{0.3}+G4{0.7}"
    with pytest.raises(FileNotFoundError):
        adapters.find_executable("no-such-tool")


def test_sample_tables(spark):
    t = spark.createDataFrame([("r", "s", "a1", "a2"), ("r", "s", "b1", "b2")], "seqrun string, sample string, fastq_R1 string, fastq_R2 string")
    with pytest.raises(ValueError):
        samples.merge_duplicates(t)
    assert samples.merge_duplicates(t, "merge").first()["fastq_R2"] == "a2,b2"
    assert samples.table_hash(t) == samples.table_hash(t.repartition(3))


def test_config():
    c = PipelineConfig.from_mapping({"tag_jump": [{"f": 0.1}], "forward_primer": "ACGTN"})
    assert c.tag_jump.f == 0.1 and c.tag_jump.p == 0.05 and c.trimming.update(max_err=0.1, junk=1).max_err == 0.1
    for bad in ({"nonsense": 1}, {"forward_primer": "XYZ"}, {"orient": "custom"}, {"clustering": {"min_taxa": 1}}):
        with pytest.raises(ValueError):
            PipelineConfig.from_mapping(bad)


def test_config_sections():
    c = PipelineConfig.from_mapping({"control": [{"spike": "s.fa"}, {"positive": False}], "added_reference": {"fasta": "a.fa", "table": "a.tsv"}, "bayesant": {"model": "m.rds", "aligned": True}, "guilds": True, "path": "p/"})
    assert (c.control.spike, c.control.positive, c.added_reference.table, c.bayesant.aligned, c.sintax, c.guilds) == ("s.fa", None, "a.tsv", True, None, True)
    assert [c.folder(k) for k in ("meta", "trim", "filt", "protax")] == ["p/meta", "p/sequences/02_trimmed", "p/sequences/03_filtered", "p/sequences/07_protax"]
    for bad in ({"control": {"spike": True}}, {"added_reference": {"fasta": "a.fa"}}, {"bayesant": {}}, {"sintax": {}}, {"guilds": "yes"}):
        with pytest.raises(ValueError):
            PipelineConfig.from_mapping(bad)


def test_clusters_nest(spark):
    rng = np.random.default_rng(0)
    rows = [(i, i % 2, rng.normal(size=4).tolist()) for i in range(60)]
    v = spark.createDataFrame(rows, "id long, block int, v array<double>")
    got = cluster.denovo(v, "block", {"loose": 0.3, "tight": 0.1}).collect()
    inner = {}
    for r in got:
        assert inner.setdefault(r["tight"], r["loose"]) == r["loose"]


def test_rollup_xml(spark):
    ranks = ("kingdom", "phylum", "class", "order", "family", "genus", "species")
    o = spark.createDataFrame([("K", "P", "C", "O", "F", "G_1", "S_2", 5, 2)], ", ".join(f"`{r}` string" for r in ranks) + ", nread long, nsample long")
    data = rollup.rollup(o)
    xml = "".join(rollup.xml_nodes(data, {"n": "nread"}))
    assert xml.count("<node") == xml.count("</node>") == 7 and 'name="G"' in xml


def test_stream(spark, sf_dir, tmp_path):
    batch = spark.read.parquet(f"{sf_dir}/events.parquet")
    batch.write.parquet(str(tmp_path / "in"))
    s = summaries.event_counts(summaries.read_stream(spark, str(tmp_path / "in"), batch.schema), late="1000 days")
    q = s.writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT sum(n) FROM counts").first()[0] == batch.count()


def test_merge_mates():
    assert sequence.merge_mates("AAACCCGGGTTTACGTA", "GGGGTACGTAAACCCGGG", 10) == "AAACCCGGGTTTACGTACCCC"
    assert sequence.merge_mates("AAAAAAAAAAAAAA", "CCCCCCCCCCCCCC") is None


def slow_primer_end(seq, primer, max_err, min_overlap):
    n, limit = len(primer), int(max_err * len(primer))
    cost, best = [(i, 0) for i in range(n + 1)], None
    for j, c in enumerate(seq, 1):
        old, cost = cost, [(0, j)]
        for i in range(1, n + 1):
            wrong = c not in IUPAC.get(primer[i - 1], "")
            cost.append(min((old[i - 1][0] + wrong, old[i - 1][1]), (old[i][0] + 1, old[i][1]), (cost[i - 1][0] + 1, cost[i - 1][1])))
        if cost[n][0] <= limit and j - cost[n][1] >= min(min_overlap, n) and (best is None or cost[n][0] < best[0]):
            best = (cost[n][0], j)
    return best[1] if best else 0


def test_primer_ends(spark, monkeypatch):
    assert sequence.primer_ends(["TTACGTGGA", None, ""], "ACNT", 0.2, 3).tolist() == [6, 0, 0]
    rng = random.Random(5)
    reads = ["".join(rng.choices("ACGTNacé", k=rng.choice([0, 1, 3, 9, 40]))) for _ in range(300)]
    reads += [r[:5] + "ACGT" * 3 + r for r in reads[:50]]
    for primer, most, least in (("ACGTNG", 0.2, 6), ("RYACGTAC", 0.4, 3), ("ACGTACGTAC", 0.3, 10), ("A", 1.0, 1), ("AC-T", 0.5, 9)):
        want = [slow_primer_end(r.upper(), primer, most, least) for r in reads]
        for cells in (64, 4 << 20):
            monkeypatch.setattr(sequence, "CELLS", cells)
            assert sequence.primer_ends(reads, primer, most, least).tolist() == want
    rows = spark.createDataFrame([(1, "TTACGTGGA"), (2, None), (3, "")], "rec_idx int, seq string")
    assert [tuple(r) for r in sequence.trim_primer(rows, "ACGTNG", qual=None, min_overlap=6).collect()] == [(1, "A")]
    assert sequence.trim_primer(rows, "ACGTNG", qual=None, min_overlap=6, discard=False).count() == 3


def test_tools(spark, tmp_path, monkeypatch):
    """Commands and parsers with stubs in the tools' places, which write what they were given."""

    def stub(name, body):
        path = tmp_path / name
        path.write_text("#!/bin/sh\nset -e\nopt() { k=$1; shift; while [ $# -gt 0 ]; do [ \"$1\" = \"$k\" ] && echo \"$2\"; shift; done; }\neval last=\\${$#}\n" + body)
        path.chmod(0o755)
        monkeypatch.setenv(name.replace("-", "_"), str(path))

    seqs = spark.createDataFrame([("a", "ACGT"), ("b", "GG")], "seq_id string, seq string").coalesce(1)
    stub("hmmalign", 'cp "$last" "$(opt -o "$@")"')
    assert sorted(map(tuple, adapters.profile_alignment(seqs, "/p.hmm").collect())) == [("a", "ACGT"), ("b", "GG")]
    stub("nhmmer", f"printf '#{'-' * 3}{(' ' + '-' * 5) * 15}\\n' > \"$(opt --tblout \"$@\")\"")
    assert adapters.nucleotide_hits(seqs, "/p.hmm").collect() == []
    line = " ".join(["t1   ", "-    ", "  100", "q1   ", "-    ", "   50", "1e-10", " 30.5", "  0.1", *["    1"] * 13, "text of it"])
    rule = "#" + "-" * 4 + (" " + "-" * 5) * 21 + " " + "-" * 10
    stub("hmmsearch", f"printf '%s\\n%s\\n' '{rule}' '{line}' > \"$(opt --domtblout \"$@\")\"")
    hit = adapters.profile_hits(seqs, "/p.hmm").first()
    assert (hit.target_name, hit.tlen, hit.query_name, hit.full_score, hit.description) == ("t1", 100, "q1", 30.5, "text of it")
    stub("epa-ng", 'cp "$(opt --query "$@")" "$(opt --outdir "$@")/epa_result.jplace"')
    stub("gappa", 'test -s "$(opt --jplace-path "$@")"\nprintf \'name\\tLWR\\tfract\\taLWR\\tafract\\ttaxopath\\na\\t1\\t0.25\\t1\\t0.75\\tK;P\\n\' > "$(opt --out-dir "$@")/per_query.tsv"')
    rows = adapters.placed(seqs, "/m", "/t", "GTR", "/x", "/o", ("kingdom", "phylum", "class")).collect()
    assert sorted((r["seq_id"], r["rank"], r["parent_taxonomy"], r["taxon"] or "", r["prob"]) for r in rows) == [("a", "class", "K,P", "", 0.25), ("a", "phylum", "K", "P", 0.75)]
    stub("classifier", "echo 'a X 0.5 X,unk 0.25'")
    rows = adapters.assigned(seqs, "classifier", ["/one", "/two"], known=(), ranks=("kingdom", "phylum")).collect()
    assert sorted((r["rank"], r["taxon"] or "", r["prob"]) for r in rows) == [("kingdom", "X", 0.5), ("phylum", "", 0.25)]
    stub("hmmalign", "exit 3")
    with pytest.raises(Exception, match="CalledProcessError|returned non-zero"):
        adapters.profile_alignment(seqs, "/p.hmm").collect()


def test_column_roles():
    from seqmill.functions.columns import local_cpus, name_column, seq_column

    assert name_column(["x", "seq"]) == "x" and seq_column(["x", "y"]) == "y" and name_column(["OTU", "a", "ASV"]) == "ASV"
    with pytest.raises(ValueError):
        seq_column(["a", "b", "c"])
    assert local_cpus() >= 1


def test_classifier(spark):
    from seqmill.operators import classify

    rng = random.Random(1)
    make = lambda: "".join(rng.choice("ACGT") for _ in range(300))
    refs = [(i, make(), f"F,P{i % 2},C{i}") for i in range(8)]
    refs += [(8 + i, s[:150] + make()[:150], f"F,P{i % 2},C{i}") for i, s, _ in refs[:4]] + [(20, None, "F,P0,C9"), (21, "ACG", "F,P1,C9"), (22, refs[3][1], "F,P1,D")]
    q = [(f"q{i}", "".join(c if rng.random() > 0.03 else rng.choice("ACGT") for c in s)) for i, s, _ in refs[:8]] + [("none", ""), ("null", None), ("short", "ACGTACG"), ("far", "N" * 50)]
    q += [("copy", q[0][1]), ("q1", q[1][1])]
    # every round by itself, over all references at once
    want: dict = {}
    for name, s in q:
        own = [s[i : i + 8].encode() for i in range(len(s or "") - 7)]
        own = sorted(set(own), key=lambda w: int.from_bytes(w, "little"))
        for draw in classify.draws(s, len(own), 100, 32) if own else ():
            count, ref = max((sum(own[x].decode() in r for x in draw), -i) for i, r, _ in refs if r)
            path = next(p for i, _, p in refs if i == -ref)
            for n in range(1, 4) if count else ():
                t = ",".join(path.split(",")[:n])
                want[name, t] = want.get((name, t), 0) + 0.01
    frame = spark.createDataFrame(q, "seq_id string, seq string")
    known = spark.createDataFrame(refs, "ref_id long, seq string, path string")
    for letters in (1 << 20, 2048):
        got = classify.classify(frame, known, query_letters=letters, ref_letters=letters).collect()
        assert {(r["seq_id"], ",".join(filter(None, [r["parent_taxonomy"], r["taxon"]]))): round(r["prob"], 6) for r in got} == {k: round(v, 6) for k, v in want.items()}
    best = {r["seq_id"]: r["taxon"] for r in sorted(got, key=lambda r: r["prob"]) if r["rank"] == "class"}
    assert best == {f"q{i}": f"C{i}" for i in range(8)} | {"copy": "C0"}
    assert not classify.classify(frame, known.limit(0)).count() and not classify.classify(frame.limit(0), known).count()


def test_denoising(spark):
    from seqmill.operators import denoise

    rng = random.Random(5)
    base = "".join(rng.choice("ACGT") for _ in range(60))
    other = base[:30] + ("A" if base[30] != "A" else "C") + base[31:]
    reads = []
    for true, n in ((base, 600), (other, 150)):
        for _ in range(n):
            seq = "".join(c if rng.random() > 0.003 else rng.choice("ACGT".replace(c, "")) for c in true)
            reads.append(("s", seq, ":" * 60))
    u = denoise.uniques(spark.createDataFrame(reads, "sample string, seq string, qual string"))
    rates = denoise.learn_rates(u, rounds=2)
    assert rates.shape == (16, 64) and np.allclose(rates.reshape(4, 4, 64).sum(1), 1)
    got = denoise.denoise(u, rates).groupBy("centre").agg({"abundance": "sum"}).collect()
    assert {r[0]: r[1] for r in got}.keys() == {base, other} and sum(r[1] for r in got) == 750


def test_distances_above_the_cap(spark):
    one = "ACGT" * 250
    seqs = spark.createDataFrame([(1, one), (2, "G" * 70 + one[70:]), (3, "T" * 300 + one[300:])], "seq_idx int, seq string")
    table = spark.createDataFrame([("a", i, 1) for i in (1, 2, 3)], "sample string, seq_idx int, nread int")
    got = curation.sample_matches(table, seqs, 0.1).collect()
    assert [(r["seq_idx1"], r["seq_idx2"]) for r in got] == [(1, 2)] and 0.02 < got[0]["dist"] <= 0.1


def test_names_end_at_white_space(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("@r1\tdesc one\nAC\n+\nII\n@r2 x\nAC\n+\nII\n@r3\nAC\n+\nII\n")
    (tmp_path / "b.fasta").write_text(">s1\t d\nAC\n>\nG\n")
    got = {(r["name"], r["description"]) for r in fastx.read_fastx(spark, [str(tmp_path / "a.fastq"), str(tmp_path / "b.fasta")]).collect()}
    assert got == {("r1", "desc one"), ("r2", "x"), ("r3", ""), ("s1", " d"), ("", "")}


def test_reads_without_a_sequence_are_not_dereplicated(spark):
    reads = spark.createDataFrame([(1, "AC", "II"), (2, None, "II"), (3, "AC", None), (4, None, None)], "rec_idx long, seq string, qual string")
    uniques, where = sequence.dereplicate(reads)
    assert [r["seq"] for r in uniques.collect()] == ["AC"] and sorted(r["rec_idx"] for r in where.collect()) == [1, 3]


def test_chimeras_in_tiles(spark):
    """Flags don't depend on tiles, are those of every child against its own parents, and nulls are neither."""
    rng = random.Random(21)
    base = ["".join(rng.choice("ACGT") for _ in range(30)) for _ in range(6)]
    mixed = [a[: (k := rng.randrange(5, 25))] + b[k:] for a in base for b in base if a != b]
    odd = [m[:7] + ("A" if m[7] != "A" else "C") + m[8:] for m in mixed[:10]]
    texts = base + mixed + odd + [None, ""]
    seqs = spark.createDataFrame(list(enumerate(texts)), "seq_idx long, seq string")
    rows = [(s, i, rng.choice([1, 2, 9, 30]) if i >= 6 else rng.choice([20, 50])) for s in ("x", "y", None) for i in range(len(texts)) if i >= len(texts) - 2 or rng.random() < 0.7]
    table = spark.createDataFrame(rows, "sample string, seq_idx long, nread long")
    for one_off in (False, True):
        want = {}
        for s, i, n in rows:
            parents = [texts[j] for t, j, m in rows if t == s and m >= 2 and m > 1.5 * n and texts[j]]
            flag = bool(texts[i]) and chimera.is_bimera(texts[i], parents, one_off, 2, 3)
            a, b = want.get(i, (0, 0))
            want[i] = (a + flag, b + 1)
        for tile in (512, 4):
            got = chimera.flag_samples(table, seqs, one_off=one_off, min_one_off_distance=2, max_shift=3, tile=tile).collect()
            assert {r[0]: (r[1], r[2]) for r in got} == want and len(got) == len(want)
    refs = spark.createDataFrame([(b,) for b in base] + [(None,)], "seq string")
    for tile in (512, 2):
        got = chimera.against_references(seqs, refs, max_shift=3, tile=tile).collect()
        assert {r[0]: r[1] for r in got} == {i: bool(t) and chimera.is_bimera(t, base, max_shift=3) for i, t in enumerate(texts)}
    assert not chimera.against_references(seqs, refs.limit(0)).filter("is_chimera").count()
    large = chimera.against_references(seqs.withColumn("seq_idx", F.col("seq_idx") + (1 << 60)), refs, max_shift=3)
    assert {r[0] - (1 << 60): r[1] for r in large.collect()} == {r[0]: r[1] for r in got}  # ids beyond the doubles


def test_samples_in_one_pass(spark):
    reads = spark.range(1, 1051).select(F.col("id").alias("rec_idx"), F.lit("x").alias("name"))
    every = sampling.sample_levels(reads, [50, 3, 10], 100)
    own = lambda n: {r[0] for r in every.filter(F.col("level") == n).select("rec_idx").collect()}
    assert own(3) < own(10) < own(50) and all(own(n) == {r[0] for r in sampling.sample_fraction(reads, n, 100).collect()} for n in (3, 10, 50))
    assert every._jdf.queryExecution().executedPlan().toString().count("Range (1, 1051") <= 2 and len(own(3)) in range(30, 34)
    for n in (0, 1, 7, 1049, 1050, 5000):
        got = [r[0] for r in sampling.sample_number(reads, n).collect()]
        assert len(got) == len(set(got)) == min(n, 1050) and (n < 7 or set(got) >= {r[0] for r in sampling.sample_number(reads, 7).collect()})


def test_pairs_are_trimmed_together(spark):
    """Against each mate trimmed by itself: both or none; orientation, actions, scores, fixed cuts, filters, nulls."""
    rng = random.Random(31)
    p, q = "ACGTTGCA", "GGCATTAC"
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    near = lambda x: x[: (k := rng.randrange(8))] + rng.choice("ACGT") + x[k + 1 :]
    rows = []
    for i in range(120):
        a, b = (rng.choice(["", word(3)]) + rng.choice([x, near(x), ""]) + word(15) for x in ((p, q) if i % 3 else (q, p)))
        rows.append((i, a, "".join(chr(33 + rng.choice([2, 20, 38])) for _ in a), b, "".join(chr(33 + rng.choice([2, 20, 38])) for _ in b)))
    rows += [(500, None, None, p + "ACGT", "I" * 12), (501, "", "", "", "")]
    df = spark.createDataFrame(rows, "rec_idx long, seq_R1 string, qual_R1 string, seq_R2 string, qual_R2 string")
    one = lambda mate, primer, action: {r["rec_idx"]: (r["s"], r["q"]) for r in sequence.trim_primer(df.select("rec_idx", F.col(f"seq_{mate}").alias("s"), F.col(f"qual_{mate}").alias("q")), primer, 0.15, 8, action=action, seq="s", qual="q").collect()}
    for action in ("trim", "retain", "mask", "lowercase", "none"):
        a, b, c, d = one("R1", p, action), one("R2", q, action), one("R1", q, action), one("R2", p, action)
        got = {r["rec_idx"]: (r["orient"], r["seq_R1"], r["qual_R1"], r["seq_R2"], r["qual_R2"]) for r in sequence.trim_pairs(df, p, q, 0.15, 8, action, either=True).collect()}
        want = {i: ("rev", *c[i], *d[i]) for i in c if i in d} | {i: ("fwd", *a[i], *b[i]) for i in a if i in b}
        assert got == want and {x[0] for x in got.values()} == {"fwd", "rev"}, action
    assert set(one("R1", p, "trim")) & set(one("R2", q, "trim")) == {r[0] for r in sequence.trim_pairs(df, p, q, 0.15, 8).collect()}
    assert sequence.trim_pairs(df, p, q, discard=False).count() == len(rows)
    with pytest.raises(ValueError):
        sequence.trim_pairs(df, p, q, action="cut")

    def low(scores, cutoff):
        total, best, cut = 0, 0, 0
        for k, x in enumerate(reversed(scores), 1):
            total += cutoff - x
            if total < 0:
                break
            if total > best:
                best, cut = total, k
        return cut

    got = {r["rec_idx"]: r for r in sequence.trim_pairs(df, p, q, discard=False, action="none", cut_R1=(2, -3), truncQ_R1=(10, 15), truncQ_R2=(5,), min_length=6).collect()}
    want = {}
    for i, a, x, b, y in rows:
        if a is not None:
            a, x = a[2:][:-3], x[2:][:-3]
            s = [ord(c) - 33 for c in x]
            u, v = low(s[::-1], 10), low(s, 15)
            a = a[u : max(u, len(a) - v)]
            w = low([ord(c) - 33 for c in y], 5)
            b = b[: len(b) - w]
            if len(a) >= 6 and len(b) >= 6:
                want[i] = (a, b)
    assert {i: (r["seq_R1"], r["seq_R2"]) for i, r in got.items()} == want and 50 < len(want) < 120


def test_denoised_pairs_are_merged_once(spark):
    from seqmill.functions.dna import CODES, COMPLEMENTS

    rc = lambda x: x.translate(str.maketrans(CODES, COMPLEMENTS))[::-1]
    whole, lone = "ACGTTGCATTGACCATGGATCCTAGGAC", "TTTTTTTTTTTTTTTTTTTT"
    pairs = [(whole[:22], rc(whole[8:])), (whole[:24], rc(whole[8:])), (lone, rc(whole[8:])), (None, rc(whole))]
    reads = spark.createDataFrame([(i, s, *pairs[i % 4]) for i, s in enumerate(["a", "a", "b", None, "a"] * 20)], "rec_idx long, sample string, seq_fwd string, seq_rev string")
    merged, rejected, where = sequence.merge_denoised(reads)
    rows = reads.collect()
    want = {}
    for r in rows:
        if r["rec_idx"] % 4 < 2:
            want[r["sample"]] = want.get(r["sample"], 0) + 1
    assert {(r["sample"], r["seq"]): (r["abundance"], r["n_pairs"]) for r in merged.collect()} == {(s, whole): (n, 2) for s, n in want.items()}
    assert sum(r["abundance"] for r in rejected.collect()) == 25 and {r["seq_fwd"] for r in rejected.collect()} == {lone}
    assert {r["rec_idx"]: r["seq"] for r in where.collect()} == {r["rec_idx"]: whole if r["rec_idx"] % 4 < 2 else None for r in rows}


def test_places_are_spread(spark):
    """Blocks are few bytes, and their places, many more, are not made in one task."""
    reads = spark.range(1, 5001).select(F.col("id").alias("rec_idx"))
    parts = sampling._places(reads, 10, 1, "rec_idx").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(r["count"] for r in parts) == 5000


def test_levels_of_spread_places(spark):
    reads = spark.range(1, 1001).select(F.col("id").alias("rec_idx"))
    got = sampling.sample_levels(reads, [2, 7], 10)
    assert {(r["level"], r["n"]) for r in got.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()} == {(2, 200), (7, 700)}


def test_ranks_are_looked_up_in_rows_of_blocks(spark, monkeypatch):
    """No sort, window or broadcast of places; the same reads as by a window, for odd ids, copies, and all numerators."""
    ids = [(i, f"n{i}") for i in [*range(1, 1000, 3), 5, 5, 0, -7, 10**12, 10**12 + 1]] + [(None, "none")]
    reads = spark.createDataFrame(ids, "rec_idx long, name string")
    kept = lambda df: sorted(map(tuple, df.collect()), key=repr)
    cases = [lambda: sampling.sample_levels(reads, [2, 7, 0], 10), lambda: sampling.sample_levels(reads, [0], 10)]
    cases += [lambda n=n: sampling.sample_fraction(reads, n, 10) for n in (0, 3, 10)]
    got = [kept(c()) for c in cases]
    run = cases[0]()
    run.collect()
    plan = run._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ShuffledHashJoin" in plan and not any(x in plan for x in ("Sort ", "Window ", "Broadcast"))
    monkeypatch.setattr(sampling, "WIDE", 0)
    assert got == [kept(c()) for c in cases] and got[1] == got[2] == [] and len(got[4]) == len(ids) - 1


def test_chimeras_send_no_table(spark):
    """Parts and counts of samples are dealt to tasks, however small their files look; the driver gathers none to send it."""
    table = spark.range(400).selectExpr("id % 20 sample", "id % 50 seq_idx", "1 + id % 9 nread")
    seqs = spark.range(50).selectExpr("id seq_idx", "concat('ACGTTGCA', if(id % 3 = 0, 'GGCC', 'TTAA'), id % 7) seq")
    out = chimera.flag_samples(table, seqs, max_shift=2)
    assert out.count() == 50 and len(out.collect()) == 50
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_chimera_ends_are_kept(monkeypatch):
    """Ends of two texts are found once a worker, and are the same where nothing can be kept."""
    import random

    rng = random.Random(3)
    texts = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 20))) for _ in range(40)]
    texts = list(dict.fromkeys(texts))
    asked, real = [], chimera.overlaps
    monkeypatch.setattr(chimera, "overlaps", lambda child, parents, size, shift: (asked.append(len(size)), real(child, parents, size, shift))[1])
    kept, few = chimera.Ends(2), chimera.Ends(2, most=12)
    for _ in range(8):
        kids, old = rng.sample(texts, 10), rng.sample(texts, 15)
        want = [real(c, *chimera._matrix(old), 2) for c in kids]
        for ends in (kept, few):
            left, right = ends.of(kids, old)
            assert [x.tolist() for x in left] == [x.tolist() for x, _ in want] and [x.tolist() for x in right] == [x.tolist() for _, x in want]
    del asked[:]
    kept.of(texts, texts)
    kept.of(texts[:9], texts)
    assert sum(asked) < len(texts) ** 2
