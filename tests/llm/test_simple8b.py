"""Token files: words and blocks against plain loops, round trips, the tokenizers library, ranges, odd tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqmill.llm import simple8b, vocab


def test_words_are_greedy_and_read_back_one_by_one():
    """A plain reader of the format, and the most ids a word that fit."""
    rng = random.Random(3)
    for _ in range(60):
        ids = np.array([rng.randrange(1 << rng.choice([1, 2, 4, 9, 16, 16, 31, 60, 64])) for _ in range(rng.choice([1, 3, 60, 61, 150]))], np.uint64)
        words, firsts = simple8b.packed(ids, np.array([len(ids)]))
        got, k = [], 0
        assert firsts.tolist() == [0]
        while k < len(words):
            w = int(words[k])
            s = w >> 60
            if not s:
                got.append(int(words[k + 1]))
                assert got[-1] >= 1 << 60
                k += 2
                continue
            count, bits = simple8b.COUNTS[s - 1], simple8b.WIDTHS[s - 1]
            rest = [int(x) for x in ids[len(got) :]]
            best = next(n for n, b in zip(simple8b.COUNTS, simple8b.WIDTHS, strict=True) if all(x < 1 << b for x in rest[:n]))
            assert count == best
            got += [w >> bits * i & (1 << bits) - 1 for i in range(min(count, len(rest)))]
            k += 1
        assert got == [int(x) for x in ids]


@pytest.mark.parametrize("block", [1, 7, 64, 1024])
def test_documents_and_ranges(block):
    rng = random.Random(block)
    for _ in range(40):
        docs = [np.array([rng.choice([1, rng.randrange(1 << rng.randrange(1, 65)), rng.randrange(50_000)]) for _ in range(rng.choice([1, 2, 60, 63, 200]))], np.uint64) for _ in range(rng.randrange(1, 6))]
        made = simple8b.encode(docs, block)
        got = simple8b.decode([w for w, _ in made], [o for _, o in made], [len(d) for d in docs], block)
        assert all(np.array_equal(a, b) for a, b in zip(docs, got, strict=True))
        for d, (w, o) in zip(docs, made, strict=True):
            a = rng.randrange(len(d) + 1)
            b = rng.randrange(a, len(d) + 3)
            assert np.array_equal(simple8b.part_of(w, o, len(d), a, b, block), d[a:b])
    assert simple8b.decode([], [], []) == []


def wanted(docs):
    """Ids of the library, documents in ascending order, null ids last."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocab.default_path("word_bpe_49k.json"))
    tok.no_truncation()
    tok.no_padding()
    return [(d, [*tok.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in docs]


@pytest.mark.parametrize("size", [1 << 30, 1 << 14])
def test_files_hold_what_the_library_says(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(simple8b, "SHARD_BYTES", size)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    at, want, every = 0, [], []
    for d, ids in wanted([(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]):
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        every += ids
        at += len(ids)
    assert sorted(map(tuple, simple8b.op11_token_files(spark, "/root/testdata/sf0.001").select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want
    path = simple8b.write(docs, str(tmp_path / "files"))
    got = simple8b.read(spark, path).orderBy("start").collect()
    assert [x for r in got for x in r["ids"]] == every
    for start, length in ((0, 10), (1000, 5000), (len(every) - 3, 100), (len(every), 5)):
        part = simple8b.window(spark, path, start, length).orderBy("start").collect()
        assert [x for r in part for x in r["ids"]] == every[start : start + length]
    # each file's documents ascend, and so do the files
    files = spark.read.parquet(path).select("shard", "nth", "doc_id").orderBy("shard", "nth").collect()
    assert [r["doc_id"] for r in files] == sorted(r["doc_id"] for r in files)
    assert len({r["shard"] for r in files}) > 3 or size > 1 << 20


def test_odd_tables(spark, tmp_path, monkeypatch):
    """Nulls in any column, empty, long and repeated texts, ids that repeat, special strings and clashing columns."""
    monkeypatch.setattr(simple8b, "SHARD_BYTES", 200)
    rows = [(None, f"none {i % 3}") for i in range(40)] + [(None, None), (1, None), (2, ""), (3, "word " * 60_000), (4, "b"), (4, "a"), (4, "a"), (-5, "<|endoftext|> É'll 12")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"shard": F.lit("x"), "ids": F.lit(1), "words": F.lit(None).cast("string"), "n_ids": F.lit(2), "start": F.lit(0)})
    got = simple8b.read(spark, simple8b.write(docs, str(tmp_path / "odd"))).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids"]) for r in got) == sorted((d is None, d or 0, ids) for d, ids in wanted(rows))
    order = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in order] == np.cumsum([0, *[len(r["ids"]) for r in order]])[:-1].tolist()
    known = [r["doc_id"] for r in order if r["doc_id"] is not None]
    assert known == sorted(known) and all(r["doc_id"] is None for r in order[len(known) :])
    empty = simple8b.write(docs.limit(0), str(tmp_path / "empty"))
    assert simple8b.read(spark, empty).count() == 0 and simple8b.window(spark, empty, 0, 5).count() == 0
