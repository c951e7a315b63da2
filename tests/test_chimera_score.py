import random

from seqmill.operators import chimera_score as cs


def _word(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def _worn(rng, s, share, gaps=0):
    out = [rng.choice("ACGT") if rng.random() < share else c for c in s]
    for _ in range(gaps):
        at = rng.randrange(10, len(out) - 10)
        out[at : at + 1] = rng.choice([[], [out[at], rng.choice("ACGT")]])
    return "".join(out)


def _slow_alignment(q, r):
    """The whole table, a cell at a time."""
    n, m = len(q), len(r)
    value, step = [[0] * (m + 1) for _ in range(n + 1)], [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            both, alone, other = value[i - 1][j - 1] + (2 if q[i - 1] == r[j - 1] else -4), value[i - 1][j] - 6, value[i][j - 1] - 6
            value[i][j], step[i][j] = (both, 1) if both >= alone else (alone, 2)
            if other > value[i][j]:
                value[i][j], step[i][j] = other, 3
    _, i, j = min((-value[i][j], i, j) for i in range(n + 1) for j in range(m + 1) if i == n or j == m)
    same, gap = [False] * n, [True] * n
    cut = []
    while step[i][j]:
        if step[i][j] == 1:
            i, j = i - 1, j - 1
            same[i], gap[i] = q[i] == r[j], False
        elif step[i][j] == 2:
            i -= 1
        else:
            j -= 1
            cut += [i - 1, i]
    for x in cut:
        if 0 <= x < n:
            gap[x] = True
    return same, [any(gap[max(x - 1, 0) : x + 2]) for x in range(n)]


def _slow(q, refs):
    """Every pair of references at every crossing."""
    n, best = len(q), (0.0, None, None, None)
    if n < 32:
        return best
    told = [(i, *_slow_alignment(q, r)) for i, r in sorted(refs)]
    alone = max(sum(m) for _, m, _ in told)
    for i, a, near in told:
        for j, b, far in told:
            for x in range(n + 1):
                count = [0] * 6
                for p in range(n):
                    if not (near[p] or far[p]):
                        mine, other = (a, b) if p < x else (b, a)
                        if mine[p] and not other[p]:
                            count[3 * (p >= x)] += 1
                        elif other[p] and not mine[p]:
                            count[3 * (p >= x) + 1] += 1
                        elif not mine[p]:
                            count[3 * (p >= x) + 2] += 1
                y, o, t, y2, o2, t2 = count
                if y > o and y2 > o2 and y + o + t >= 3 and y2 + o2 + t2 >= 3 and (sum(a[:x]) + sum(b[x:]) - alone) * 100 >= 0.8 * n:
                    h = y / (8 * (o + 1.4) + t) * (y2 / (8 * (o2 + 1.4) + t2))
                    if h > best[0] + 1e-12:
                        best = (h, i, j, x)
    return best


def test_scores_against_all_pairs(spark):
    rng = random.Random(8)
    base = _word(rng, 70)
    refs = [(10 + i, _worn(rng, base, 0.25, 1)) for i in range(4)] + [(5, _word(rng, 66))]
    texts = [refs[0][1], _worn(rng, refs[1][1], 0.04, 1)]
    texts += [_worn(rng, refs[i][1][: (k := rng.randrange(18, 50))] + refs[j][1][k:], 0.03, g) for i in range(4) for j in range(4) if i != j for g in (0, 1)][:12]
    texts += [texts[3], None, "", "ACGT", _word(rng, 40), "ACGT" * 12]
    seqs = spark.createDataFrame(list(enumerate(texts)), "seq_idx long, seq string").selectExpr("*", "1 AS key", "'x' AS ids")
    known = spark.createDataFrame([*refs, (90, None), (91, "ACG")], "ref_id long, seq string")
    want = {i: _slow(t or "", refs) for i, t in enumerate(texts)}
    assert sum(h > cs.LEAST for h, *_ in want.values()) > 5
    for letters in (1 << 20, 1024):
        got = cs.reference_scores(seqs, known, most=9, band=150, query_letters=letters, ref_letters=letters).collect()
        assert len(got) == len(texts)
        for r in got:
            h, left, right, crossing = want[r["seq_idx"]]
            assert abs(r["score"] - h) < 1e-9 and (r["left_ref"], r["right_ref"], r["crossing"]) == (left, right, crossing) and r["is_chimera"] == (h >= cs.LEAST)
    assert not cs.reference_scores(seqs, known.limit(0)).filter("score <> 0 or is_chimera or left_ref is not null").count()
    assert not cs.reference_scores(seqs.limit(0), known).count()


def test_planted_chimeras(spark):
    """Of many families of references, with errors, gaps and shifts: planted chimeras are found, worn references are none."""
    rng = random.Random(3)
    refs = [_worn(rng, base, 0.08) for base in (_word(rng, 280) for _ in range(10)) for _ in range(6)]
    rows, made = [], {}
    for i in range(60):
        rows.append((i, _worn(rng, refs[i], 0.01, i % 2)[i % 5 :]))
        a, b = rng.sample(range(10), 2)
        k = rng.randrange(80, 200)
        left, right = a * 6 + rng.randrange(6), b * 6 + rng.randrange(6)
        rows.append((100 + i, _worn(rng, refs[left][:k] + refs[right][k:], 0.01, i % 2)[i % 5 :]))
        made[100 + i] = (left, right, k - i % 5)
    seqs = spark.createDataFrame(rows, "seq_idx long, seq string")
    known = spark.createDataFrame(list(enumerate(refs)), "ref_id int, seq string")
    got = {r["seq_idx"]: r for r in cs.reference_scores(seqs, known).collect()}
    assert {i for i, r in got.items() if r["is_chimera"]} == set(made)
    assert sum((got[i]["left_ref"], got[i]["right_ref"]) == m[:2] and abs(got[i]["crossing"] - m[2]) < 12 for i, m in made.items()) > 50


def test_long_query():
    """Candidates of a long query are aligned few at a time, with the same result."""
    rng = random.Random(5)
    a, b = _word(rng, 9000), _word(rng, 9000)
    refs = [a, b, *(_word(rng, 9000) for _ in range(4))]
    h, left, right, crossing = cs.score(_worn(rng, a[:4000] + b[4000:], 0.02), refs, band=800)
    assert h > 1 and (left, right) == (0, 1) and abs(crossing - 4000) < 20
