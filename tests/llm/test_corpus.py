"""Corpus operators against brute force, the public libraries, round trips and held-out accuracy; and on odd tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seqmill.llm import bpe, chat, fsttok, langid, mpegaudio, neardup, packing, quality, queries, shingles, topk, urlrules, vocab
from tests.oracle import same

ODD = [
    "", " ", "\0", "a", "'", "'s's't", " 're", "  're", "\n're", "\n\n're", "don't  ", "x  ", "  \n ", "a<|endoftext|>'s<|startoftext|>", "<|ENDOFTEXT|>", "\0\0<|endoftext|>",
    "ΑΣ ΣΑΣ", "İstanbul", "é ẞ ﬁ", "²½Ⅷ١٢", "日本語テキスト", "😀😀👍🏽", "a" * 3000, " " * 2000, "\ud7ff", "Σ́日ࣽ՘",
]


def fuzz(n, seed, alphabet="abcstdmrvel''\n\t <|!*%Éé½２日😀Σ"):
    rng = random.Random(seed)
    parts = [*alphabet, "<|endoftext|>", "the", "ing", " "]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(50))) for _ in range(n)]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty, very long and repeated rows, and columns whose names the operators use themselves."""
    rows = [(None, "no id", "en", 1, "x"), (1, None, None, 2, None), (2, "", "en", 3, "x"), (3, "word " * 60_000, "en", None, "x"), (4, "same text here again", "de", 1, "x"), (4, "same text here again", "de", 1, "x"), (5, "same text here again", None, 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, node long, key string").withColumns({"label": F.lit(1), "score": F.lit("s"), "ids": F.lit(0), "sig": F.lit(None).cast("string"), "part": F.lit(9), "tile": F.lit(2)})


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, sf_dir, name):
    same(spark, sf_dir, queries.QUERIES[name], queries.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, tmp_path, name, sf_dir):
    for t in ("documents", "labels", "pages", "embeddings", "conversations"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == (1 if name.startswith("op9") else 0)


# 1 language


def test_language_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = langid.op1_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r["lang"] == r["lang_pred"] for r in got if r["held_out"]]
    assert len(held) > 200 and np.mean(held) > 0.98


def test_language_kernel():
    texts, langs = ["der die das und nicht", "the and of that with", "las los que para una"] * 4, ["de", "en", "es"] * 4
    m = langid.fit(texts, langs)
    k = m.kernel(["der the"])[0]

    def grams(t):
        s = "".join(c if c.isalpha() else " " for c in t.lower())
        return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}

    x = grams("der the")
    marks = [t for g in ("de", "en", "es") for t, lang in zip(texts, langs, strict=True) if lang == g]
    want = [len(x & grams(t)) / (len(x) * len(grams(t))) ** 0.5 for t in marks]
    assert np.allclose(k[0], want, atol=1e-5)
    assert m.predict(["die und das", "", "123 !!"])[0] == ["de", "und", "und"]
    # a text counts as the language that it has more of, whatever it repeats
    assert m.predict(["the and of that with " * 300 + "der die das und nicht " * 100])[0] == ["en"]
    assert m.predict(["der die das und nicht " * 300 + "the and of that with " * 100])[0] == ["de"]


def test_language_passages():
    """Cutting into passages, kernel values, regression and means by length against plain loops."""
    langs = ["de", "en", "es"] * 3
    m = langid.fit([f"{x} {x[::-1]} the and of that {i} der die das" * (1 + i) for i, x in enumerate(langs)], langs)
    spectrum = langid.Spectrum(m.alphabet)
    marks = [{int(m.grams[i]) for i in np.flatnonzero(row)} for row in np.unpackbits(m.packed, axis=0, count=len(m.grams)).T]
    rng = random.Random(6)
    for text in ("the and of " * 200, "".join(rng.choice("dertha  1É") for _ in range(1700)), "x", "éé das! das? ", "der " * 128, "a1b22c" * 300):
        symbols = []
        for c in text:
            s = int(spectrum.symbol[ord(c)])
            if s or not symbols or symbols[-1]:
                symbols.append(s)
        many = max(1, len(symbols) // langid.PASSAGE)
        parts = [[s for i, s in enumerate(symbols) if i * many // len(symbols) == k] for k in range(many)]
        mean = np.zeros(len(m.langs))
        for p in parts:
            base = langid.SYMBOLS
            own = {s for s in p} | {base + a * base + b for a, b in zip(p, p[1:], strict=False)} | {base + base**2 + (a * base + b) * base + c for a, b, c in zip(p, p[1:], p[2:], strict=False)}
            k = [len(own & x) / len(own) ** 0.5 / norm for x, norm in zip(marks, m.norms, strict=True)]
            mean += len(p) * (np.array(k) @ m.weights) / len(symbols)
        (lang,), (value,) = m.predict([text])
        assert lang == m.langs[int(np.argmax(mean))] and abs(value - np.clip((mean.max() + 1) / 2, 0, 1)) < 1e-4


def test_language_odd(spark, odd):
    got = langid.score(odd, langid.fit(*langid.sample(odd)), keep=("label", "score")).collect()
    assert len(got) == 7 and [r["lang_pred"] for r in got if r["doc_id"] in (1, 2)] == ["und", "und"]


def test_samples_hold_rare_classes_and_repeated_rows(spark):
    """A language of five rows beside many, and one id with most of all rows."""
    many = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    rare = spark.createDataFrame([(-1 - i, f"rare {i}", "xx") for i in range(5)], "doc_id long, text string, lang string")
    hot = spark.range(60_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("hot").alias("text"), F.lit("en").alias("lang"))
    docs = many.union(rare).union(hot)
    texts, langs = langid.sample(docs, 50)
    assert sorted(t for t, x in zip(texts, langs, strict=True) if x == "xx") == [f"rare {i}" for i in range(5)]
    assert langs.count("en") == 50 and texts.count("hot") <= 1
    assert langid.sample(docs, 50, 20)[1].count("xx") == 4  # whole texts until there are 20 bytes
    labels = docs.select("doc_id", (F.col("doc_id") < 20_000).cast("int").alias("quality"))
    texts, y, held = quality.sample(docs, labels, 200)
    assert len(texts) == 200 and texts.count("hot") <= 1 and 60 < sum(y) < 140 and 20 < sum(held) < 60


def test_three_hundred_languages(spark, tmp_path, monkeypatch):
    """All labels are learned, however many: texts and landmarks a language fall instead; the pipeline's stage keeps all of them."""
    monkeypatch.setattr(langid, "ALL_TEXTS", 1200)
    rng = random.Random(12)
    words = {f"l{k:03}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(12)] for k in range(300)}
    rows = [(k * 300 + i, " ".join(rng.choice(words[g]) for _ in range(50)), g) for k in range(8) for i, g in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(4)
    texts, langs = langid.sample(docs)
    assert len(set(langs)) == 300 and all(0 < langs.count(g) <= 4 for g in words)
    model = langid.fit(texts, langs)
    assert model.langs == sorted(words) and len(model.norms) <= langid.ALL_LANDMARKS
    new = [" ".join(rng.choice(words[g]) for _ in range(50)) for g in words]
    assert np.mean([a == b for a, b in zip(model.predict(new)[0], words, strict=True)]) > 0.95
    kept = corpus_pipeline.known_language(spark, docs, str(tmp_path)).groupBy("lang").count()
    assert kept.count() == 300


def test_letters_beyond_the_symbols():
    """A rarer script has n-grams though other scripts fill the symbols."""
    latin, greek, cyrillic = "abcdefghijklmnopqrstuvwxyzéèêëàâäöüßñçøåæœ", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщъыьэюя"
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(6))
    words = {g: [word(x) for _ in range(40)] for g, x in {"la": latin, "el": greek, "e2": greek, "ru": cyrillic}.items()}
    text = lambda g: " ".join(rng.choice(words[g]) for _ in range(60))
    langs = [g for g in words for _ in range(40 if g == "la" else 10)]
    model = langid.fit([text(g) for g in langs], langs)
    assert model.predict([text(g) for g in words])[0] == list(words)


# 2 URLs


def test_urls():
    index = urlrules.RuleIndex(urlrules.RULES)
    cases = {
        None: ("", "", None, "allow"), "no scheme": ("", "", None, "allow"), "http://A.B.COM/en/x?y#z": ("a.b.com", "/en/x", "com/en/", "block"), "http://example.com/en/77": ("example.com", "/en/77", "example.com/en/7", "allow"),
        "http://notexample.com/en/7": ("notexample.com", "/en/7", "com/en/", "block"), "x://m.example.net/de/8.html": ("m.example.net", "/de/8.html", "example.net/de/8", "block"), "http://a.org": ("a.org", "", None, "allow"),
        "http://a.org?q=/es/": ("a.org", "", None, "allow"), "http://É.ORG/es/": ("É.org", "/es/", "org/es/", "block"), "a://b://com/en/": ("b:", "//com/en/", None, "allow"),
    }
    for url, want in cases.items():
        assert index.judge(url) == want


def test_urls_allowed_by_a_rule():
    """The contract allows net/de/, but for what a longer rule blocks."""
    index = urlrules.RuleIndex(urlrules.RULES)
    assert index.judge("http://blog.example.net/de/7") == ("blog.example.net", "/de/7", "net/de/", "allow")
    assert index.judge("http://blog.example.net/de/80") == ("blog.example.net", "/de/80", "example.net/de/8", "block")
    assert {(r.text, r.action) for r in urlrules.RULES} == {("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")}


def test_urls_by_token_are_all_rules():
    rng = random.Random(1)
    rules = [urlrules.Rule(rng.choice(["allow", "block"]), rng.choice(["a.com", "com", "b.org", ""]) + rng.choice(["", "/", "/x/", "/x/y", "/x/y/z"])) for _ in range(40)]
    rules = [r for r in dict.fromkeys(rules) if r.text]
    import re

    index = urlrules.RuleIndex(rules)
    for _ in range(500):
        url = "http://" + rng.choice(["a.com", "q.a.com", "com", "b.org", "xb.org"]) + rng.choice(["", "/", "/x", "/x/", "/x/y", "/x/y/z", "/x/yy"])
        host, path = urlrules.split(url)
        fit = [(-len(r.text), k, r) for k, r in enumerate(rules) if re.match(r.pattern, host + path)]
        want = min(fit)[2] if fit else None
        assert index.judge(url)[2] == (want.text if want else None)


def test_urls_odd(spark):
    """Nulls, a very long url, repeated rows and columns named as the result's."""
    long = "http://A.com/en/" + "x" * 300_000
    rows = [(None, None, "h", 1), (1, long, None, 2), (1, long, None, 2), (2, "", "h", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule int").withColumns({"path": F.lit(0), "verdict": F.lit(None).cast("string")})
    got = sorted(((r["page_id"], r["host"], len(r["path"]), r["rule"], r["verdict"]) for r in urlrules.judge(df, urlrules.RULES).collect()), key=repr)
    assert got == sorted([(None, "", 0, None, "allow"), (1, "a.com", 300_004, "com/en/", "block"), (1, "a.com", 300_004, "com/en/", "block"), (2, "", 0, None, "allow")], key=repr)


# 3 near duplicates


def brute_groups(docs, size, threshold):
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                up[root(i)] = root(j)
    least = defaultdict(lambda: 1 << 60)
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(least[root(i)], d)
    return {d: (len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(docs)}


def test_template_families(spark):
    """Texts that share a template at a similarity of 0.7 and don't link: the pairs held against each other stay few, also across tiles."""
    rng = random.Random(21)
    template = [rng.getrandbits(60) for _ in range(140)]
    sets = [np.array(sorted({*template, *(rng.getrandbits(60) for _ in range(30))}), np.uint64) for _ in range(5000)]
    for i in range(0, 100, 2):  # some pairs are near copies
        sets[i + 1] = np.array(sorted({*sets[i].tolist()[:-4], *(rng.getrandbits(60) for _ in range(4))}), np.uint64)
    sig = neardup.signatures(np.concatenate(sets), np.concatenate([[0], np.cumsum(list(map(len, sets)))]))[0]
    rows = [(i, i, sig[i].tobytes(), x.tobytes()) for i, x in enumerate(sets)]
    tile = neardup.Tile(rows, 80)
    held = []
    tile._met = lambda values, owner, y: held.append(len(y)) or (met := neardup.Tile._met(values, owner, y), held.append(len(met)))[0]
    found = {(i, j) for i in range(200) for j in tile.linked(*rows[i][1:]).tolist()}
    assert found == {(i, i ^ 1) for i in range(100)}
    assert sum(held[1::2]) < 200 * 60  # of 200 x 5,000 pairs


@pytest.mark.parametrize("size,threshold", [(3, 85), (5, 80)])
def test_near_duplicates_in_tiles(spark, monkeypatch, size, threshold):
    """Groups far larger than a tile, and tables that are too many to broadcast, against brute force."""
    monkeypatch.setattr(neardup, "TILE_BYTES", 1 << 14)
    monkeypatch.setattr(neardup, "FEW_IDS", 3)
    rng = random.Random(31)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    docs = []
    for i in range(160):  # a chain of drifting texts, and texts that share most of the base
        if i % 3:
            base = list(base)
            base[rng.randrange(len(base))] = f"v{i}"
            docs.append((i, " ".join(base)))
        else:
            own = list(base)
            for _ in range(rng.choice([2, 4, 6, 8])):
                own[rng.randrange(len(own))] = f"u{i}-{rng.random()}"
            docs.append((i, " ".join(own)))
    docs += [(500 + i, docs[i][1]) for i in range(0, 60, 7)] + [(3, docs[90][1]), (600, None), (601, " ")]
    rng.shuffle(docs)
    found = neardup.groups(spark.createDataFrame(docs, "doc_id long, text string"), size, threshold).collect()
    whole = brute_groups([(k, t) for k, (_, t) in enumerate(docs)], size, threshold)  # by row, and then rows of one id together
    up = list(range(len(docs)))

    def root(x):
        return x if up[x] == x else root(up[x])

    for k in range(len(docs)):
        up[root(k)] = root(whole[k][1])
    first = {}
    for k, (d, t) in enumerate(docs):
        if (t or "").split():
            up[root(k)] = root(first.setdefault(d, k))
    least = defaultdict(lambda: 1 << 60)
    for k, (d, _) in enumerate(docs):
        least[root(k)] = min(least[root(k)], d)
    assert sorted((r[0], r[1], r[2]) for r in found) == sorted((d, whole[k][0], least[root(k)]) for k, (d, _) in enumerate(docs))
    assert len(set(least.values())) > 3


@pytest.mark.parametrize("size,threshold", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, threshold):
    rng = random.Random(size)
    words = [f"w{i}" for i in range(400)]
    docs, k = [], 0
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 4, 30, 120]))]
        for _ in range(rng.choice([1, 2, 8, 30])):
            own = [w if rng.random() > rng.choice([0, 0.01, 0.03, 0.06]) else rng.choice(words) for w in base]
            docs.append((k, rng.choice([" ", "\n", "  "]).join(own)))
            k += 1
    docs += [(k, None), (k + 1, "  "), (k + 2, docs[5][1].upper())]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r[0]: (r[1], r[2]) for r in neardup.groups(df, size, threshold).collect()}
    assert got == brute_groups(docs, size, threshold)


def test_near_duplicates_odd(spark, odd):
    got = sorted(map(tuple, neardup.groups(odd, 3, 85).collect()), key=repr)
    assert [(r[0], r[2]) for r in got if r[0] in (4, 5)] == [(4, 4), (4, 4), (5, 4)]
    assert [(r[1], r[2]) for r in got if r[0] is None] == [(1, None)]
    assert [(r[0], r[1], r[2]) for r in got if r[0] in (1, 2)] == [(1, 0, 1), (2, 0, 2)]


def test_shingles_and_estimates():
    texts = ["A b\tC d", "a  B", "", "É é", "x\x0by z"] + fuzz(300, 5)
    values, begins = shingles.sets(texts)
    for i, t in enumerate(texts):
        w = t.encode().lower().split()
        want = {tuple(w[j : j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
        assert begins[i + 1] - begins[i] == len(want)
    rng = np.random.default_rng(0)
    for j in (0.5, 0.85, 0.95):
        n = 2000
        common = int(2 * n * j / (1 + j))
        x = rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64)
        sig, _ = neardup.signatures(np.concatenate([np.sort(x[:n]), np.sort(x[n - common :])]), np.array([0, n, 2 * n]))
        assert abs(neardup.estimate(sig[0], sig[1]) - j) < 0.13


def test_bands_by_threshold():
    assert neardup.shape(0.85) == (28, 5)
    for t in (0.2, 0.5, 0.8, 0.85, 0.95):
        many, rows = neardup.shape(t)
        assert many * rows <= neardup.HASHES and (1 - t**rows) ** many <= 1e-6


# 4 quality


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = quality.op4_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [(r["score"], r["quality"]) for r in got if r["held_out"]]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([g >= 0.3 for g in good]) > 0.97


def test_quality_odd(spark, odd):
    none = quality.fit([], [], [])
    assert {r["score"] for r in quality.score(odd, none, keep=("label",)).select("score").collect()} == {0.5}
    labels = spark.createDataFrame([(2, 1), (3, 0), (4, 1), (4, 0), (None, 1), (5, None)], "doc_id long, quality int")
    texts, y, held = quality.sample(odd, labels)
    # a row counts once, however often it is repeated
    assert len(texts) == 3 and sorted(y) == [0, 0, 1]
    assert all(0 <= r["score"] <= 1 for r in quality.score(odd, quality.fit(texts, y, [False] * 3)).collect())


def test_quality_slow_version():
    """Vectors, pooling, network and temperature against plain loops."""
    import math
    import re

    rng = random.Random(8)
    words = ["alpha", "Beta", "GAMMA", "deLta", "12", "--", "epsilon", "!!", "zeta", "x"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", "\n"]) for _ in range(rng.randrange(1, 60))) for _ in range(60)] + [""]
    labels = [int("zeta" in t) for t in texts]
    held = [i % 4 == 0 for i in range(len(texts))]
    m = quality.fit(texts, labels, held)
    seen = [re.findall(r"[^\W\d_]+|\d+|[^\s\w]+|_+", t) for t in texts]
    learned = [w for w, h in zip(seen, held, strict=True) if not h]
    count = defaultdict(int)
    for ws in learned:
        for w in ws:
            count[w] += 1
    names = [*quality.SHAPES, *sorted((w for w in count if count[w] > 1), key=lambda w: (-count[w], w))]
    number = {w: i for i, w in enumerate(names)}
    of = lambda w: number.get(w, quality.shape(w))
    context = np.zeros((len(names), quality.DIMENSIONS))
    for ws in learned:
        for i, w in enumerate(ws):
            for j in range(max(0, i - quality.NEAR), min(len(ws), i + quality.NEAR + 1)):
                if i != j:
                    context[of(w)] += quality.index_vector(names[of(ws[j])])
    total = sum(count.values())
    vectors = [(quality.index_vector(w) / quality.ONES**0.5 + c / max(np.linalg.norm(c), 1e-6)) * (1e-2 / (1e-2 + (count[w] / total if i >= len(quality.SHAPES) else 1 / 50))) for i, (w, c) in enumerate(zip(names, context, strict=True))]
    assert m.vocabulary == names[len(quality.SHAPES) :] and np.allclose(m.vectors, vectors, atol=1e-5)
    logit = []
    for t, ws in zip(texts, seen, strict=True):
        x = np.zeros(quality.DIMENSIONS + len(quality.SHAPES) + quality.EXTRA)
        if n := len(ws):
            x[: quality.DIMENSIONS] = sum(vectors[of(w)] for w in ws) / n
            for k in range(len(quality.SHAPES)):
                x[quality.DIMENSIONS + k] = math.sqrt(sum(of(w) == k for w in ws) / n)
            lines = t.split("\n")
            again, marks = sum(a == b for a, b in zip(ws, ws[1:], strict=False)), sum(not w[0].isalnum() and (w[0] not in ".,;:'\"-?" or len(w) > 1) for w in ws)
            x[-quality.EXTRA :] = math.log1p(n), math.sqrt(again / n), math.sqrt(1 - len(set(lines)) / len(lines)), len(set(ws)) / n**0.8, math.sqrt(marks / n), math.log1p(len(t) / len(lines)), math.log1p(len(t) / n)
        a, b, c, d = m.weights
        hidden = [math.tanh(sum((x[i] - m.mean[i]) / m.scale[i] * a[i, h] for i in range(len(x))) + b[h]) for h in range(quality.HIDDEN)]
        logit.append(sum(v * w for v, w in zip(hidden, c, strict=True)) + d[0])
    assert np.allclose(m.score(texts), [1 / (1 + math.exp(-v / m.temperature)) for v in logit], atol=1e-3)

    def loss(temperature):
        return np.mean([math.log1p(math.exp(-(v if y else -v) / temperature)) for v, y, h in zip(logit, labels, held, strict=True) if h])

    assert loss(m.temperature) <= min(loss(g) for g in np.exp(np.linspace(np.log(0.2), np.log(10), 60))) + 1e-4


# 5 packing


def test_packing(spark, odd):
    rng = random.Random(2)
    docs = [(i, None if i % 50 == 0 else " ".join(rng.choice(["one", "two", "unlikelihood"]) for _ in range(rng.choice([0, 5, 300, 2500])))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = packing.pack(df).collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocab.default_path("word_bpe_49k.json"))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    assert sorted(by_seq) == list(range(len(by_seq)))
    used = 0
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        used += at
    assert used / 2048 > 0.98 * len(by_seq) - 1
    assert packing.pack(odd).filter("doc_id = 4").count() == 2


def test_packing_ids():
    from tokenizers import Tokenizer

    path = vocab.default_path("word_bpe_49k.json")
    own = packing.LibraryIds(path, vocab.library_ranges())
    tok = Tokenizer.from_file(path)
    texts = [t for t in ODD if "\ud7ff" not in t] + fuzz(3000, 3)
    assert [x.tolist() for x in own.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_ids_of_more_pieces_than_slots():
    from tokenizers import Tokenizer

    path = vocab.default_path("word_bpe_49k.json")
    own = packing.LibraryIds(path, vocab.library_ranges())
    own.BITS, own.KEPT = 6, 20
    own.reset()
    tok = Tokenizer.from_file(path)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n)) for n in (20, 3000, 40, 500)]
    for t in [*texts, *texts]:  # each text a chunk
        assert own.encode([t])[0].tolist() == tok.encode(t, add_special_tokens=False).ids


def test_plans_use_all():
    rng = np.random.default_rng(3)
    for _ in range(5):
        hist = np.zeros(2049, np.int64)
        np.add.at(hist, rng.integers(1, 2049, rng.integers(0, 3000)), 1)
        plan, stream = packing.make_plan(hist)
        used = np.zeros_like(hist)
        for k, n in stream:
            used[k] += n
        for parts, n in plan:
            assert sum(k * v for k, v in parts.items()) <= 2048 and n > 0
            for k, v in parts.items():
                used[k] += n * v
        assert (used == hist).all()


def test_stream_of_one_length():
    """Copies of one awkward length are cut, and their parts fill windows without gaps."""
    for size in (1266, 1, 2047, 1025, 32):
        n = 500
        hist = np.zeros(2049, np.int64)
        hist[size] = n
        places = packing.Places(*packing.make_plan(hist))
        row, at, length, seq, offset = places.find(np.full(n, size), np.arange(n))
        assert np.bincount(row, length, n).tolist() == [size] * n
        ends = defaultdict(int)
        for s, o, k in sorted(zip(seq.tolist(), offset.tolist(), length.tolist(), strict=True)):
            assert o == ends[s]
            ends[s] += k
        assert max(ends.values()) <= 2048 and sorted(ends) == list(range(places.sequences))
        assert places.sequences <= n * size / 2048 * 1.04 + 1


def test_checksum_of_a_tail():
    raw = random.Random(1).randbytes(8000)
    for k in (1, 128, 4096, 7999):
        got = packing.tail_crc(np.array([zlib.crc32(raw[:k])]), np.array([zlib.crc32(raw)]), np.array([len(raw) - k]))
        assert got[0] == zlib.crc32(raw[k:])


# 6 media


def test_media_round_trip():
    for text in ["", "a" * 576, "a" * 577, "é" * 9000, *fuzz(50, 6)]:
        n, payload = mpegaudio.payload_of(text)
        assert len(payload) % 576 == 0 and len(payload) >= 576
        data = mpegaudio.write(payload, n)
        s = mpegaudio.read(data)
        assert mpegaudio.payload_from(data, s) == payload and s.tags["bytes"] == str(n)
        assert s.bad == 0 and s.checked == len(s.offsets) + 1 and s.vbr == "Xing" and s.vbr_frames == len(s.offsets)
        assert s.duration[0] / s.duration[1] == pytest.approx(len(s.offsets) * 1152 / 32000)


def test_media_damage():
    data = mpegaudio.write(*reversed(mpegaudio.payload_of("x" * 20_000)))
    whole = mpegaudio.read(data)
    k = whole.offsets[3]
    s = mpegaudio.read(data[: k + 2] + b"\0junk" + data[k + 40 :])
    assert s.resyncs == 1 and len(s.offsets) == len(whole.offsets) - 1
    bad = bytearray(data)
    bad[k + 10] ^= 1
    assert mpegaudio.read(bytes(bad)).bad == 1
    for junk in (b"", b"\xff", b"ID3", b"\xff\xfb", random.Random(1).randbytes(5000), b"ID3\x04\0\0\x7f\x7f\x7f\x7f"):
        mpegaudio.read(junk)


def test_media_headers():
    h = mpegaudio.header(0xFFFB9064)
    assert (h.version, h.layer, h.bitrate, h.rate, h.size, h.samples) == (1, 3, 128, 44100, 417, 1152)
    h = mpegaudio.header(0xFFF38064)
    assert (h.version, h.layer, h.rate, h.samples) == (2, 3, 22050, 576)
    assert mpegaudio.header(0xFFFFF064) is None and mpegaudio.header(0) is None


def test_media_columns(spark, odd):
    f = mpegaudio.media_features(mpegaudio.encode_media(odd))
    assert f.filter("bad_checksums = 0 and frames >= 1 and size(seek_offsets) = frames").count() == 7
    d = mpegaudio.digests(odd)
    assert d.filter("doc_id in (4, 5)").select("media_sha256", "feature").distinct().count() == 1


# 7 top-k


def brute_top(rows, k):
    vec = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in {i: min(v for j, v in vec if j == i) for i, _ in vec if i % 10 == 0}.items():
        s = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in vec if j != q)[:k]
        out += [(q, r, j, -x) for r, (x, j) in enumerate(s, 1)]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.01, 1, 30])).astype("f4").tolist()) for i in range(700)]
    rows += [(i, rows[i % 7][1]) for i in range(700, 760)] + [(760, None), (770, [1.0, None] + [0.0] * 6), (780, [float("nan")] * 8), (790, [0.0] * 8), (11, rows[11][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    v = topk.scaled(df)
    got = sorted(tuple(r) for r in topk.top_k(v.filter("vec_id % 10 = 0"), v, 10).collect())
    assert got == brute_top(rows, 10)


def test_top_k_few(spark):
    v = topk.scaled(spark.createDataFrame([(0, [1.0]), (1, [2.0, 3.0]), (100, [-1.0])], "vec_id long, embedding array<float>"))
    got = sorted(tuple(r) for r in topk.top_k(v.filter("vec_id % 100 = 0"), v).collect())
    assert got == [(0, 1, 1, 1024 * 2048), (0, 2, 100, -(1024**2)), (100, 1, 0, -(1024**2)), (100, 2, 1, -1024 * 2048)]


# 8 and 10 tokens


def test_bpe_is_the_library():
    from tokenizers import Tokenizer

    path = vocab.default_path("word_bpe_49k.json")
    own, tok = bpe.WordBpe(path), Tokenizer.from_file(path)
    for t in ODD + fuzz(3000, 8):
        ids = own.encode([t])[0]
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids
        assert own.decode(ids.tolist()) == own.decoded([ids])[0].decode() == tok.decode(ids, skip_special_tokens=False)


def test_bpe_digests(spark, odd):
    own = {r["id"]: (r["ids"], r["decoded"]) for r in bpe.encode(odd).collect()}
    for r in bpe.digests(odd).collect():
        ids, text = own[r["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_merges_in_order():
    """The index against one word at a time, best pair first, leftmost of equals."""
    rng = random.Random(9)
    merges, n = {}, 4
    for rank in range(12):
        pair = (rng.randrange(n), rng.randrange(n))
        if pair not in merges:
            merges[pair] = (rank, n)
            n += 1
    words = [[rng.randrange(4) for _ in range(rng.randrange(30))] for _ in range(300)]

    def slow(w):
        w = list(w)
        while True:
            found = [(merges[w[i], w[i + 1]][0], i) for i in range(len(w) - 1) if (w[i], w[i + 1]) in merges]
            if not found:
                return w
            i = min(found)[1]
            w[i : i + 2] = [merges[w[i], w[i + 1]][1]]

    assert bpe.apply_merges(words, merges) == [slow(w) for w in words]


def test_counts_are_the_library():
    from tokenizers import Tokenizer

    path = vocab.default_path("byte_bpe_50k.json")
    own, tok = fsttok.TokenCounter(path, vocab.library_ranges()), Tokenizer.from_file(path)
    texts = ODD + fuzz(5000, 10)
    want = [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert own.counts(texts).tolist() == want
    own.counter.KEPT = 0  # compiled anew in between
    assert own.counts(texts).tolist() == want


@pytest.mark.parametrize("entries", [1, 64])
def test_counts_of_long_pieces(monkeypatch, entries):
    """Composed chunk maps, and what is left in order, against the library."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(fsttok, "ENTRIES", entries)
    monkeypatch.setattr(fsttok, "LONG", 100)
    monkeypatch.setattr(fsttok, "SPAN", 32)
    monkeypatch.setattr(fsttok, "LEAD", 5)
    monkeypatch.setattr(fsttok, "BLOCK", 1000)
    path = vocab.default_path("byte_bpe_50k.json")
    own, tok = fsttok.TokenCounter(path, vocab.library_ranges()), Tokenizer.from_file(path)
    rng = random.Random(12)
    texts = ["a" * 3000, "=" * 2500, " " * 5000, "ab" * 700, "abcdefghijklm" * 300, "日本語" * 300, "x" * 100, "y" * 99]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(90, 4000))) for letters in ("ab", "the", "antion", "0123456789", "aàéü", "abcdefghijklmnopqrstuvwxyz") for _ in range(6)]
    texts.append(" ".join(texts))
    want = [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert own.counts(texts).tolist() == want
    own.counter.KEPT = 50
    assert own.counts(texts).tolist() == want


def test_counts_odd(spark, odd):
    got = {(r["doc_id"], r["n_bytes"], r["over_limit"]) for r in fsttok.token_counts(odd).collect()}
    assert (1, 0, False) in got and (2, 0, False) in got and (3, 300_000, True) in got


# 9 chat


def test_chat_round_trip():
    rng = random.Random(3)
    parts = ["\\", "###", "</turn>", "\n", "a", "#", "<", "/turn>", " ", "é", "\n</turn>\n"]
    for _ in range(20_000):
        role, text = ("".join(rng.choice(parts) for _ in range(rng.randrange(n))) for n in (4, 9))
        shown = chat.render(role, text)
        ((r, t, a, b),) = chat.parse(shown)
        assert (r, t) == (role, text) and chat.unescape(shown[a:b]) == text
    assert [t[:2] for t in chat.parse("".join(chat.render("u", x) for x in ("a", "\\### x", "")))] == [("u", "a"), ("u", "\\### x"), ("u", "")]
    for bad in ("x", "### a", "### a\nb", "### a\n###\n</turn>\n"):
        with pytest.raises(chat.Broken):
            chat.parse(bad)


def test_chat_long_and_clashing(spark):
    """Time grows with the text and not its square, and columns may have the names that are used inside."""
    import time

    for text in ("\\" * 500_001, "\\###" * 100_000, "</turn>\\" * 100_000, "\n" * 300_000):
        t = time.process_time()
        shown = chat.render("user", text)
        ((_, got, a, b),) = chat.parse(shown)
        assert got == text and chat.unescape(shown[a:b]) == text and time.process_time() - t < 2
    rows = spark.createDataFrame([(1, 0, "assistant", "long " * 100_000, "x", 5), (1, 0, "assistant", None, None, None)], "conv_id long, turn long, role string, text string, rendered string, position int")
    (got,) = chat.digests(rows).collect()
    assert got["n_turns"] == 2 and got["loss_chars"] == 500_000


def test_chat_spans(spark):
    rows = spark.createDataFrame([(1, 1, "assistant", "b </turn>"), (1, 0, "user", "a"), (None, None, None, None), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    got = chat.format_conversations(rows).filter("conv_id = 1").orderBy("position").collect()
    whole = "".join(r["rendered"] for r in got)
    assert "".join(chat.unescape(whole[r["loss_start"] : r["loss_end"]]) for r in got if r["loss_start"] is not None) == "b </turn>c"
    assert chat.digests(rows).count() == 2


# the pipeline


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir).cache()
        assert out.columns == docs.columns and out.subtract(docs).count() == 0
        kept = {r["doc_id"] for r in out.select("doc_id").collect()}
        if name == "quality":
            assert np.mean([d in kept for d, q in labels.items() if q]) > 0.97 and np.mean([d in kept for d, q in labels.items() if not q]) < 0.3
        if name == "language":
            letters = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
            assert kept == letters
        if name == "near_dedup":
            want = brute_groups([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80)
            assert kept == {d for d, (_, c) in want.items() if d == c}
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_pipeline_odd(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "key", "node")
    assert corpus_pipeline.near_dedup(spark, docs, "").filter("doc_id in (4, 5)").count() == 1
    assert corpus_pipeline.known_language(spark, docs, "").filter("text is null or text = ''").count() == 0


def test_pipeline_stages_odd(spark, odd, tmp_path):
    """Each stage, and all together, on nulls, repeats, very long texts and clashing columns, and on no rows."""
    docs = odd.drop("score")
    spark.createDataFrame([(2, 0, 1), (3, 1, 0), (4, 1, None), (4, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality", "language", "near_dedup"):
        out = stages[name](spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.exceptAll(docs).count() == 0
        assert stages[name](spark, docs.limit(0), str(tmp_path)).count() == 0
    kept = stages["near_dedup"](spark, docs, str(tmp_path))
    assert sorted((r["doc_id"] or 0) for r in kept.select("doc_id").collect()) == [0, 1, 2, 3, 4]
    pieces = stages["packing"](spark, docs, str(tmp_path)).groupBy("doc_id").agg(F.countDistinct("start").alias("n"), F.sum("length").alias("ids")).collect()
    assert {r["doc_id"] for r in pieces} == {None, 1, 2, 3, 4, 5} and {r["ids"] for r in pieces if r["doc_id"] in (1, 2)} == {1}
    assert stages["packing"](spark, docs.limit(0), str(tmp_path)).count() == 0
    whole = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()
    assert {r["doc_id"] for r in whole} <= {None, 3, 4}


def test_top_k_odd(spark):
    """Nulls, repeated rows, a very long vector and clashing columns."""
    rows = [(0, [1.0, 2.0], "x"), (0, [1.0, 2.0], "x"), (1, [0.5] * 3000, None), (2, None, "x"), (3, [1.0, None], "x"), (4, [float("nan")], "x"), (None, [1.0], "x"), (5, [-1.0, 3.0], None), (6, [], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").withColumns({"n2": F.lit(1), "v": F.lit(2), "grp": F.lit(3)})
    side = topk.scaled(df)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(side.filter("vec_id = 0"), side, 2).collect())
    assert got == [(0, 1, 5, (-1 + 6) * 1024**2), (0, 2, 1, 3 * 512 * 1024)]
    assert topk.top_k(side.limit(0), side, 2).count() == 0 and topk.top_k(side, side.limit(0), 2).count() == 0


def test_pipeline_rejects_unlearned_and_noise(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) >= 400 and lang <> 'fr'").select("doc_id", "text", "lang")
    other = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) >= 400 and lang = 'fr'").select("doc_id", "text", F.lit(None).cast("string").alias("lang"))
    rng = random.Random(9)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/   ") for _ in range(2000)) for _ in range(20)]
    noise += ["Η γλώσσα είναι ένα σύστημα επικοινωνίας", "日本語は日本で話されている言語です。"]
    letters = [f"{c} 1 2 3" for c in "abcdefghijklmnopqrstuvwxyz"]
    strange = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(noise + letters)], "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in corpus_pipeline.known_language(spark, docs.union(other).union(strange), "").select("doc_id").collect()}
    assert not any(-1 - i in kept for i in range(len(noise)))
    assert sum(-1 - len(noise) - i in kept for i in range(len(letters))) < len(letters) / 2
    assert np.mean([r["doc_id"] in kept for r in docs.collect()]) > 0.99
    assert np.mean([r["doc_id"] in kept for r in other.collect()]) < 0.05


def test_language_margins_without_held_back():
    assert langid.calibrated([], []).accepts(["the"]) == [False]
    assert langid.calibrated(["the and of"], ["en"]).accepts(["the", "12"]) == [True, False]


def test_pipeline_null_and_repeated_ids(spark):
    rows = [(None, "one text without an id here", 1), (None, "another text without any id", 2), (None, None, 3), (7, "zebras come last in this order", 4), (7, "apples come first in this order", 5), (7, "apples come first in this order", 6), (8, "a text that is by itself", 7)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, n long").repartition(3)
        assert sorted(r["n"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 2, 3, 5, 7]
