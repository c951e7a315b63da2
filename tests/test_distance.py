"""Pairs by distance and clusters of them: brute force, numbers of candidates, tiles, long chains, thresholds by taxon."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqmill.operators import cluster, curation, distance


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def changed(rng, s, n):
    x = list(s)
    for _ in range(n):
        k = rng.randrange(len(x) + 1)
        x[k : k + rng.randrange(2)] = rng.choice(["", "A", "C", "GT"])
    return "".join(x)


def family(rng, n, size, most):
    """Random sequences, each with relatives at up to ``most`` edits."""
    out = []
    for _ in range(n):
        base = "".join(rng.choice("ACGT") for _ in range(rng.randrange(size // 2, size)))
        out += [base, changed(rng, base, rng.randrange(most)), changed(rng, base, most)]
    return out


@pytest.mark.parametrize("t", [0.0, 0.03, 0.1, 0.25, 0.6])
def test_edit_pairs(spark, t):
    rng = random.Random(4)
    words = [*family(rng, 8, 60, 5), *family(rng, 4, 12, 2), "", "", "A", "A", "C", "A" * 40, "A" * 42, "AC" * 20, "AC" * 21, "ACGTACGT" * 5]
    rows = [(i, rng.choice(["x", "y", None]), w) for i, w in enumerate(words)] + [(900, "x", None)]
    df = spark.createDataFrame(rows, "id long, block string, seq string")
    want = {}
    for i, b, s in rows[:-1]:
        for j, c, z in rows[:-1]:
            top = max(len(s), len(z))
            if i < j and b == c and abs(len(s) - len(z)) <= int(top * t + 1e-9) and (e := edits(s, z)) <= int(top * t + 1e-9):
                want[i, j] = (b, e / max(top, 1))
    got = distance.edit_pairs(df, None, "block", t).collect()
    assert {(r["id"], r["id2"]): (r["block"], r["dist"]) for r in got} == want and len(got) == len(want)
    left, right = df.filter("id % 2 = 0"), df.filter("id % 2 = 1")
    both = {(r["id"], r["id2"]) for r in distance.edit_pairs(left, right, "block", t).collect()}
    assert both == {(min(p, key=lambda x: x % 2), max(p, key=lambda x: x % 2)) for p in want if (p[0] + p[1]) % 2}


def test_candidates_are_few(spark):
    """At 300 letters and a tenth, random sequences have next to no candidates, and relatives few beyond the near ones."""
    rng = random.Random(1)
    seqs = ["".join(rng.choice("ACGT") for _ in range(300)) for _ in range(1000)]
    kin = []
    for s in seqs[:40]:
        kin += [changed(rng, s, rng.randrange(1, 60)) for _ in range(10)]
    df = spark.createDataFrame(list(enumerate(seqs + kin)), "seq_idx long, seq string")
    rows = df.select(F.lit(0).alias("block"), F.col("seq_idx").alias("id"), "seq", F.lit(0).alias("side"), F.lit(0.1).alias("_t"))
    found = distance.candidates(rows).count()
    near = curation.near_pairs(df, 0.1).count()
    assert 300 < near <= found <= 5 * near  # siblings are at up to twice as many edits as the limit


def test_hot_segments(spark):
    """A stretch that all sequences share is left out of what is looked for, as long as enough others are there."""
    rng = random.Random(2)
    shared = "ACGTACGGTTACGATC"
    df = spark.createDataFrame([(i, 0, shared + "".join(rng.choice("ACGT") for _ in range(284)), 0, 0.1) for i in range(600)], "id long, block int, seq string, side int, _t double")
    assert distance.candidates(df).count() < 10


def test_pairs_of_samples_alone(spark):
    """Equal sequences that never meet in a sample are no candidates."""
    seqs = spark.range(400).select(F.col("id").alias("seq_idx"), F.lit("ACGT" * 20).alias("seq"))
    table = spark.range(400).select((F.col("id") % 200).alias("sample"), F.col("id").alias("seq_idx"), F.lit(3).alias("nread"))
    got = curation.sample_matches(table, seqs, 0.1)
    assert {(r["seq_idx1"], r["seq_idx2"]) for r in got.collect()} == {(i, i + 200) for i in range(200)}


def test_hamming_pairs(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("ACGT") for _ in range(40)) for _ in range(4)]
    words = ["".join(c if rng.random() > 0.15 else rng.choice("ACGT-.acgt") for c in rng.choice(base)) for _ in range(50)] + ["-" * 40, "ACGT", "", None]
    df = spark.createDataFrame([(i, i % 3 or None, w) for i, w in enumerate(words)], "id long, block int, seq string")
    want = {}
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            if i < j and a and b and len(a) == len(b) and i % 3 == j % 3:
                at = [(x, y) for x, y in zip(a.upper(), b.upper(), strict=True) if not {x, y} & set("-.")]
                if len(at) >= 20 and sum(x != y for x, y in at) / len(at) <= 0.2 + 1e-9:
                    want[i, j] = round(sum(x != y for x, y in at) / len(at), 9)
    for tile in (512, 5):
        got = distance.hamming_pairs(df, None, "block", 0.2, min_overlap=20, tile=tile).collect()
        assert {(r["id"], r["id2"]): round(r["dist"], 9) for r in got} == want and len(got) == len(want) > 10


def test_tiles_have_bounded_sides(spark):
    """One block with 20,000 rows on the left: no group has more than about two tiles, and no pair is lost."""
    rng = np.random.default_rng(0)
    left = spark.createDataFrame([(i, 0, [float(i % 97), 1.0]) for i in range(20_000)], "id long, block int, v array<double>")
    right = spark.createDataFrame([(100_000 + i, 0, [float(i), 1.0]) for i in range(300)], "id long, block int, v array<double>")
    sizes = []

    def kernel(x, y):
        sizes.append((len(x), len(y)))
        assert len(x) < 700 and len(y) < 700
        return distance._cosine(x, y)

    got = distance.tile_pairs(left, right, "block", 1e-9, F.size("v"), kernel, 512)
    assert got.groupBy("id").count().count() == 20_000
    same = distance.vector_pairs(left.filter("id < 2000"), None, "block", 1e-9, 256)
    want = sum(n * (n - 1) // 2 for n in np.bincount(np.arange(2000) % 97))
    assert same.count() == same.distinct().count() == want and same.filter("id >= id2").count() == 0
    assert rng is not None


def test_null_block_and_map(spark):
    df = spark.createDataFrame([(i, b, "ACGTACGTAC" + x) for i, (b, x) in enumerate([("a", "AA"), ("a", "AT"), ("b", "AA"), ("b", "AT"), (None, "AA"), (None, "AT"), ("c", "AA"), ("c", "AT")])], "id long, block string, seq string")
    pairs = lambda t: {(r["id"], r["id2"]) for r in distance.edit_pairs(df, None, "block", t).collect()}
    assert pairs({"a": 0.1, "_NA_": 0.0}) == {(0, 1)}
    assert pairs({"a": 0.0, "_NA_": 0.1}) == {(2, 3), (4, 5), (6, 7)}
    assert pairs({"b": 0.1}) == {(2, 3)}
    with pytest.raises(ValueError):
        pairs({"a": 1.0})
    with pytest.raises(ValueError):
        distance.configured("none")


def waves(links, known):
    """References of the closure by plain waves; ``known`` are what was matched first."""
    ref, wave = dict(known), dict(known)
    while wave:
        best = {}
        for (i, j), d in links.items():
            for a, b in ((i, j), (j, i)):
                if b in wave and a not in ref:
                    best[a] = min(best.get(a, (9, 0)), (d, wave[b]))
        wave = {a: r for a, (_, r) in best.items()}
        ref |= wave
    return ref


@pytest.mark.parametrize("most", [500_000, 0])
def test_closure(spark, monkeypatch, most):
    """Small blocks in one task, large ones by joins; strings by edits; ties and copies."""
    monkeypatch.setattr(cluster, "LINKS", most)
    rng = random.Random(8)
    start = family(rng, 6, 50, 1)
    unknown = []
    for s in start[:12]:
        for _ in range(4):
            s = changed(rng, s, 3)
            unknown.append(s)
    known = spark.createDataFrame([(i, s, "x") for i, s in enumerate(start)], "id long, seq string, block string")
    rest = spark.createDataFrame([(100 + i, s, "x") for i, s in enumerate(unknown)], "id long, seq string, block string")
    near = {(r["id"], r["id2"]): r["dist"] for r in distance.edit_pairs(rest, known, "block", 0.15).collect()}
    first = {i: min((d, k) for (x, k), d in near.items() if x == i)[1] for i in {i for i, _ in near}}
    links = {(r["id"], r["id2"]): r["dist"] for r in distance.edit_pairs(rest, None, "block", 0.15).collect()}
    got = cluster.closed_reference(rest, known, "block", 0.15, closure=True, distance="edit").collect()
    assert dict(map(tuple, got)) == waves(links, first) and len(got) == len({r["id"] for r in got}) > len(first)
    assert dict(map(tuple, cluster.closed_reference(rest, known, "block", 0.15, distance="edit").collect())) == first


def test_long_chain(spark):
    """A chain of 200 steps from one reference, found without a limit of rounds."""
    angle = np.linspace(0, 3, 201)
    rows = [(i, 0, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angle)]
    v = spark.createDataFrame(rows, "id long, block int, v array<double>")
    got = cluster.closed_reference(v.filter("id > 0"), v.filter("id = 0"), "block", 0.00015, closure=True).collect()
    assert dict(map(tuple, got)) == {i: 0 for i in range(1, 201)}


@pytest.mark.parametrize("most", [500_000, 7])
def test_thresholds_by_taxon(spark, monkeypatch, most):
    """Nested clusters at thresholds of each taxon and of all others, cut from one forest or joined level by level."""
    monkeypatch.setattr(cluster, "LINKS", most)
    rng = random.Random(9)
    rows = [(i, rng.choice(["x", "y", "z", None]), s) for i, s in enumerate(family(rng, 15, 50, 6))]
    df = spark.createDataFrame(rows, "id long, block string, seq string")
    t = {"species": {"x": 0.04, "_NA_": 0.08}, "genus": {"x": 0.12, "y": 0.3, "_NA_": 0.2}, "family": 0.3}
    got = {r["id"]: r for r in cluster.denovo(df, "block", t, "edit").collect()}
    assert len(got) == len(rows)
    for name, limit in t.items():
        up = {i: i for i, _, _ in rows}
        root = lambda x, up=up: x if up[x] == x else root(up[x])
        for i, b, s in rows:
            own = limit.get(b, limit["_NA_"]) if isinstance(limit, dict) else limit
            for j, c, z in rows:
                if j > i and b == c and edits(s, z) <= int(max(len(s), len(z)) * own + 1e-9):
                    x, y = sorted((root(i), root(j)))
                    up[y] = x
        assert {i: r[name] for i, r in got.items()} == {i: root(i) for i in up}, name
    assert [k for k, _ in cluster.levels(t)] == ["species", "genus", "family"]
    with pytest.raises(ValueError):
        cluster.levels({"a": {"x": 0.5, "_NA_": 0.1}, "b": 0.2})


def test_ids_and_blocks_are_strings(spark):
    """Groups without a pair, and ids and blocks that are strings."""
    rows = [("a", "p", "ACGTACGTAC"), ("b", "p", "ACGTACGTAT"), ("c", "p", "TTTTTTTTTT"), ("d", "q", "ACGTACGTAC"), ("e", "q", "GGGGGGGGGG"), ("f", "r", "CCCCCCCCCC")]
    df = spark.createDataFrame(rows, "id string, block string, seq string")
    for method in ("edit", "hamming"):
        assert [(r["block"], r["id"], r["id2"]) for r in distance.configured({"method": method})(df, None, "block", 0.1).collect()] == [("p", "a", "b")]
        got = cluster.closed_reference(df.filter("id <> 'a'"), df.filter("id = 'a'"), "block", 0.1, closure=True, distance=method)
        assert list(map(tuple, got.collect())) == [("b", "a")]
        assert {r["id"]: r["x"] for r in cluster.denovo(df, "block", {"x": 0.1}, method).collect()} == {"a": "a", "b": "a", "c": "c", "d": "d", "e": "e", "f": "f"}


def measured_rows(monkeypatch):
    """How many pairs each search measures."""
    seen, real = [], distance.measured
    monkeypatch.setattr(distance, "measured", lambda pairs: (seen.append(pairs.count()), real(pairs))[1])
    return seen


def copies(spark, n):
    """Three texts of a block, two of them near, ``n`` times each, with ids that change places, a null and the block that is null."""
    texts = ["AAAACCCCGGGGTTTT", "AAAACCCCGGGGTTTA", "TTTTTTTTTTTTTTTT"]
    rows = [(b, 1000 * k + 3 * i + (i + j) % 3, t) for k, b in enumerate(["x", None]) for i in range(n) for j, t in enumerate(texts)]
    return rows, spark.createDataFrame([*rows, ("x", 5000, None)], "block string, id long, seq string")


def test_closed_reference_measures_copies_once(spark, monkeypatch):
    rows, df = copies(spark, 30)
    unknown, known = df.filter("id % 2 = 0 or seq is null"), df.filter("id % 2 = 1")
    seen = measured_rows(monkeypatch)
    got = dict(map(tuple, cluster.closed_reference(unknown, known, "block", 0.1, distance="edit").collect()))
    best = lambda b, t: min((sum(x != y for x, y in zip(t, u, strict=True)), i) for c, i, u in rows if c == b and i % 2)[1]
    assert got == {i: best(b, t) for b, i, t in rows if i % 2 == 0}
    assert sum(seen) <= 2 * 9


def test_clusters_measure_copies_once(spark, monkeypatch):
    rows, df = copies(spark, 30)
    seen = measured_rows(monkeypatch)
    got = {r["id"]: (r["tight"], r["loose"]) for r in cluster.denovo(df, "block", {"tight": {"x": 0.01}, "loose": 0.1}, "edit").collect()}
    least = lambda b, kinds: min(i for c, i, t in rows if c == b and t in kinds)
    near = {"AAAACCCCGGGGTTTT", "AAAACCCCGGGGTTTA"}
    # a block without a threshold keeps its copies apart
    want = {i: (least(b, {t}) if b else i, least(b, near if t in near else {t})) for b, i, t in rows}
    assert got == want | {5000: (5000, 5000)}
    assert sum(seen) <= 2 * 9


def test_matches_measure_copies_once(spark, monkeypatch):
    rows, df = copies(spark, 12)
    seqs = df.filter("block = 'x' or seq is null").select(F.col("id").alias("seq_idx"), "seq")
    t = seqs.select((F.col("seq_idx") % 2).alias("sample"), "seq_idx", (F.col("seq_idx") + 1).alias("nread"))
    text = {i: s for b, i, s in rows if b}
    apart = lambda i, j: sum(x != y for x, y in zip(text[i], text[j], strict=True)) / 16
    want = {(i % 2, i, j, i + 1, j + 1, apart(i, j)) for i in text for j in text if i < j and i % 2 == j % 2 and apart(i, j) <= 0.1}
    seen, real = [], curation.measured
    monkeypatch.setattr(curation, "measured", lambda pairs: (seen.append(pairs.count()), real(pairs))[1])
    got = curation.sample_matches(t, seqs, 0.1).collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want
    assert sum(seen) <= 9


def test_matches_of_texts_and_members(spark):
    """Without copies: pairs between the smallest of each text of a sample, and each other one with its smallest."""
    rows, df = copies(spark, 12)
    seqs = df.filter("block = 'x'").select(F.col("id").alias("seq_idx"), "seq")
    t = seqs.select((F.col("seq_idx") % 2).alias("sample"), "seq_idx", F.col("seq_idx").alias("nread"))
    every = curation.sample_matches(t, seqs, 0.1, gaps=True).collect()
    first = {}
    text = {i: s for b, i, s in rows if b}
    for i in sorted(text):
        first.setdefault((i % 2, text[i]), i)
    stands = lambda i: first[i % 2, text[i]]
    got = curation.sample_matches(t, seqs, 0.1, gaps=True, copies=False).collect()
    want = {tuple(r) for r in every if text[r[1]] != text[r[2]] and stands(r[1]) == r[1] and stands(r[2]) == r[2] or text[r[1]] == text[r[2]] and stands(r[2]) == r[1]}
    assert len(got) == len(want) and set(map(tuple, got)) == want
    # what is left out follows from what is there
    linked = {frozenset((r["seq_idx1"], r["seq_idx2"])) for r in got}
    assert all(text[r[1]] == text[r[2]] or frozenset((stands(r[1]), stands(r[2]))) in linked for r in every)


def test_hamming_compares_copies_once(spark, monkeypatch):
    texts = ["ACGTACGTACGT", "acgtacgtacga", "AC----------", None]
    rows = [("x", 4 * i + (i + j) % 4, t) for i in range(10) for j, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "block string, id long, seq string")
    seen, real = [], distance.tile_pairs
    monkeypatch.setattr(distance, "tile_pairs", lambda left, *a: (seen.append(left.count()), real(left, *a))[1])
    got = distance.hamming_pairs(df, None, "block", 0.1, min_overlap=3).collect()
    known = [(i, t.upper()) for _, i, t in rows if t and "-" not in t]
    want = {(i, j, round(sum(x != y for x, y in zip(s, t, strict=True)) / 12, 9)) for i, s in known for j, t in known if i < j}
    assert len(got) == len(want) and {(r["id"], r["id2"], r["dist"]) for r in got} == want
    assert seen == [3]


def test_shared_beginnings_are_no_segments(spark):
    """Names that differ behind a long beginning: few candidates, where segments of the beginning would meet all of a block."""
    rows = [(i, i % 2, f"Supplier#{i:09d}", 0, 0.1) for i in range(3000)]
    df = spark.createDataFrame([*rows, (9000, 2, "Supplier#", 0, 0.1), (9001, None, "", 0, 0.1)], "id long, block int, seq string, side int, _t double")
    found = distance.candidates(df)
    near = distance.edit_pairs(df.select("block", "id", "seq"), None, "block", 0.1)
    want = sum(1 for i in range(3000) for p in (1, 10, 100, 1000) for v in range(i + p, i + 10 * p, p) if v < 3000 and v // p % 10 > i // p % 10 and v // (10 * p) == i // (10 * p) and v % 2 == i % 2)
    assert near.count() == want and found.count() < 80 * 3000


def test_blocks_where_all_are_near_meet_in_tiles(spark):
    """Short texts at many edits: each pair once, from tiles, and texts that are no longer than their edits."""
    texts = ["abcd"[: i % 5] + "".join("xyz"[i // 3**k % 3] for k in range(3)) for i in range(60)] + ["a", "", "abcdxyzxyzxyz"]
    df = spark.createDataFrame([(i, 0, "pre" + t, 0, 0.6) for i, t in enumerate(dict.fromkeys(texts))], "id long, block int, seq string, side int, _t double")
    texts = {r["id"]: r["seq"] for r in df.collect()}
    found = [frozenset((r["x"], r["y"])) for r in distance.candidates(df, tile=8).collect()]
    assert len(found) == len(set(found))
    top = lambda i, j: int(max(len(texts[i]), len(texts[j])) * 0.6 + 1e-9)
    assert {frozenset((i, j)) for i in texts for j in texts if i < j and edits(texts[i], texts[j]) <= top(i, j)} <= set(found)


def test_gaps_of_many_pairs(monkeypatch):
    """Many pairs at a time give what each gives alone, and the other order's longest run beside it."""
    rng = random.Random(5)
    pairs = [tuple("".join(rng.choice("AB☃") for _ in range(rng.randrange(12))) for _ in "ab") for _ in range(300)] + [("XYXAY", "XY")]
    d = np.array([edits(a, b) for a, b in pairs])
    for cells in (1 << 20, 200):
        monkeypatch.setattr(curation, "CELLS", cells)
        columns, gaps, longest, turned = curation.gap_table([a for a, _ in pairs], [b for _, b in pairs], d)
        for k, (a, b) in enumerate(pairs):
            assert (columns[k], gaps[k], longest[k]) == curation.gap_stats(a, b, d[k]) and turned[k] == curation.gap_stats(b, a, d[k])[2]
            assert gaps[k] >= abs(len(a) - len(b)) and 2 * columns[k] == len(a) + len(b) + gaps[k]
    assert (longest[-1], gaps[-1]) == (2, 3)
