"""The probabilistic leaf model against plain loops; search against all pairs."""

import math
import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from seqmill.operators import bayes, search
from tests.test_distance import changed, edits


def plain(refs, seq, k, smooth):
    """Posteriors of leaves, one k-mer at a time."""
    kmers = ["".join(x) for x in product("ACGT", repeat=k)]
    cut = lambda s: [s[i : i + k] for i in range(len(s) - k + 1) if set(s[i : i + k]) <= set("ACGT")]
    paths = sorted({p for _, p in refs})

    def p(prefix):
        own = [x for s, path in refs if (path + ",").startswith(prefix + "," if prefix else "") for x in cut(s.upper())]
        up = {x: 1 / len(kmers) for x in kmers} if not prefix else p(prefix.rpartition(",")[0])
        return {x: (own.count(x) + smooth * up[x]) / (len(own) + smooth) for x in kmers}

    log = {}
    for path in paths:
        own = p(path)
        n = sum(q == path for _, q in refs)
        log[path] = math.log((n + 1) / (len(refs) + len(paths))) + sum(math.log(own[x]) for x in cut(seq.upper()))
    top = max(log.values())
    every = sum(math.exp(v - top) for v in log.values())
    return {x: math.exp(v - top) / every for x, v in log.items()}


def test_posteriors(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    leaves = {p: word(60) for p in ("K,P1,C1", "K,P1,C2", "K,P2,C3", "K,P2,C4", "K")}
    refs = [(changed(rng, s, 4), p) for p, s in leaves.items() for _ in range(3)] + [("acgtNNacgt", "K,P2,C5")]
    queries = [(i, changed(rng, s, 6)) for i, s in enumerate(leaves.values())] + [(10, word(40)), (11, "AC"), (12, None), (13, ""), (14, "acgtnACGTTT")]
    r = spark.createDataFrame([*refs, (None, "K,P1,C1"), ("ACGT", None)], "seq string, path string")
    q = spark.createDataFrame(queries, "seq_id long, seq string")
    model = bayes.fit(r, 3, 8.0).cache()
    monkeypatch.setattr(bayes, "WINDOW", 7)
    assert sorted(map(str, bayes.fit(r, 3, 8.0).collect())) == sorted(map(str, model.collect()))
    for tile in (2048, 2):
        monkeypatch.setattr(bayes, "LEAVES", tile)
        monkeypatch.setattr(bayes, "QUERIES", tile)
        got = {}
        for x in bayes.posteriors(q, model, 3).collect():
            got.setdefault(x["seq_id"], {})[x["path"]] = x["prob"]
        assert set(got) == {i for i, s in queries if s and len(s) >= 3}
        for i, own in got.items():
            want = plain(refs, dict(queries)[i], 3, 8.0)
            assert all(abs(own.get(p, 0) - v) < 1e-9 for p, v in want.items())
    rows = bayes.predict(q, model, 3, most=None, least=0.0).collect()
    sums = {}
    for x in rows:
        sums[x["seq_id"], x["parent_taxonomy"]] = sums.get((x["seq_id"], x["parent_taxonomy"]), 0) + x["prob"]
    own = {(x["seq_id"], ",".join(filter(None, [x["parent_taxonomy"], x["taxon"]]))): x["prob"] for x in rows}
    assert all(abs(v - (1 if p is None else own[i, p])) < 1e-9 for (i, p), v in sums.items() if p != "K")
    assert all(sums[i, "K"] <= own[i, "K"] + 1e-9 for i, p in sums if p == "K")  # a leaf may lie above others
    best = {}
    for x in bayes.posteriors(q.filter("seq_id < 5"), model, 3).collect():
        best[x["seq_id"]] = max(best.get(x["seq_id"], (0, "")), (x["prob"], x["path"]))
    assert [best[i][1] for i in range(5)] == list(leaves)
    assert bayes.posteriors(q, model.limit(0), 3).count() == 0 and bayes.posteriors(q.limit(0), model, 3).count() == 0
    with pytest.raises(ValueError):
        bayes.posteriors(q, model, 4)


def test_global_hits(spark):
    rng = random.Random(13)
    base = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(30, 60))) for _ in range(12)]
    refs = [(100 + i, s) for i, s in enumerate(base + [changed(rng, s, 2) for s in base] + base[:2])] + [(500, None)]
    query = [(i, changed(rng, rng.choice(base), rng.randrange(8))) for i in range(40)] + [(90, None), (91, "ACGT")]
    q, r = spark.createDataFrame(query, "id long, seq string"), spark.createDataFrame(refs, "id long, seq string")
    want = {}
    for i, s in query:
        near = sorted((edits(s, t) / max(len(s), len(t)), j) for j, t in refs if s and t)
        near = [(d, j) for d, j in near if d <= 0.1 + 1e-9]
        for place, (d, j) in enumerate(near[:2], 1):
            want[i, place] = (j, round(100 * (1 - d), 6))
    got = {(x["seq_id"], x["place"]): (x["ref_id"], round(x["identity"], 6)) for x in search.global_hits(q, r, 0.9, 2).collect()}
    assert got == want and len(want) > 30
    one = {x["seq_id"]: x["ref_id"] for x in search.global_hits(q, r, 0.9).collect()}
    assert one == {i: j for (i, place), (j, _) in want.items() if place == 1}
    assert search.global_hits(q, r.filter(F.lit(False))).count() == 0


def test_global_hits_measure_copies_once(spark, monkeypatch):
    from seqmill.operators import distance

    texts = ["ACGTACGTACGTACGTACGT", "ACGTACGTACGTACGTACGA", "CCCCCCCCCCCCCCCCCCCC"]
    q, r = ([(100 * side + 3 * i + (i + j) % 3, t) for i in range(20) for j, t in enumerate(texts)] for side in (1, 2))
    seen, real = [], distance.measured
    monkeypatch.setattr(distance, "measured", lambda pairs: (seen.append(pairs.count()), real(pairs))[1])
    got = sorted(tuple(x) for x in search.global_hits(spark.createDataFrame([*q, (9, None)], "id long, seq string"), spark.createDataFrame(r, "id long, seq string"), 0.9, 3).select("seq_id", "place", "ref_id").collect())
    best = lambda t: sorted((sum(x != y for x, y in zip(t, u, strict=True)), i) for i, u in r)[:3]
    assert got == sorted((i, k + 1, ref) for i, t in q for k, (_, ref) in enumerate(best(t)))
    one = {x["seq_id"]: x["ref_id"] for x in search.global_hits(spark.createDataFrame(q, "id long, seq string"), spark.createDataFrame(r, "id long, seq string"), 0.9).collect()}
    assert one == {i: best(t)[0][1] for i, t in q}
    assert sum(seen) <= 2 * 9


def test_counts_of_a_text(spark):
    import collections

    from seqmill.operators import bayes as by

    for text in ("", "ACG", "ACGT", "ACGTNACGTTT", "É" * 5 + "ACGTACGT", "A" * 1000):
        found = by._counts(text, 4)
        want = collections.Counter(text[i : i + 4] for i in range(len(text) - 3) if set(text[i : i + 4]) <= set("ACGT"))
        assert {i: int(c) for i, c in enumerate(found) if c} == {sum("ACGT".index(x) * 4 ** (3 - j) for j, x in enumerate(w)): c for w, c in want.items()}
