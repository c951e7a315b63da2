"""Operator 8: byte-pair encoding and decoding with a pair occurrence index.

A chunk of a partition's texts is cut to the vocabulary's pieces; its pieces not
met before in this process are laid out as linked lists of symbols, one index
maps each adjacent pair to all its positions in them, and the pairs that have a
merge are applied in ascending rank. Each merge takes its positions from the
index, joins the symbols and updates the lists of the pairs that it makes. Every
text is then the concatenation of its pieces' ids, and is decoded from these.

Nulls are empty texts; an empty text has no ids. Texts are encoded whole.
Special strings inside a text are their special ids, as the library has them.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import vocab
from .common import chunks, out_batch, prepare, table, texts_of
from .pieces import PieceIds

#: Tokens whose names are gathered at once.
NAMES = 1 << 16


def apply_merges(words: list[list[int]], merges: dict[tuple[int, int], tuple[int, int]]) -> list[list[int]]:
    """Encode words, given as lists of symbol ids, by a pair occurrence index over all of them.

    ``merges`` maps a pair of ids to its rank and the id that it becomes. Ranks
    are applied in ascending order, occurrences of a pair from left to right.
    """
    symbols: list[int] = []
    follow: list[int] = []
    before: list[int] = []
    heads: list[int] = []
    for word in words:
        at = len(symbols)
        heads.append(at if word else -1)
        symbols += word
        n = len(word)
        follow += range(at + 1, at + n + 1)
        before += range(at - 1, at + n - 1)
        if n:
            follow[-1] = -1
            before[at] = -1
    index: dict[tuple[int, int], list[int]] = {}
    for i, j in enumerate(follow):
        if j >= 0:
            pair = (symbols[i], symbols[j])
            if pair in index:
                index[pair].append(i)
            elif pair in merges:
                index[pair] = [i]
    active = [(merges[pair][0], pair) for pair in index]
    active.sort()
    while active:
        _, pair = heappop(active)
        left, right = pair
        new = merges[pair][1]
        places = index.pop(pair)
        if left == right:
            places.sort()
        for i in places:
            if symbols[i] != left:
                continue
            j = follow[i]
            if j < 0 or symbols[j] != right:
                continue
            symbols[i] = new
            symbols[j] = -1
            k = follow[j]
            follow[i] = k
            if k >= 0:
                before[k] = i
                made = (new, symbols[k])
                if made in index:
                    index[made].append(i)
                elif made in merges:
                    index[made] = [i]
                    heappush(active, (merges[made][0], made))
            h = before[i]
            if h >= 0:
                made = (symbols[h], new)
                if made in index:
                    index[made].append(h)
                elif made in merges:
                    index[made] = [h]
                    heappush(active, (merges[made][0], made))
    out = []
    for at in heads:
        ids = []
        while at >= 0:
            ids.append(symbols[at])
            at = follow[at]
        out.append(ids)
    return out


class WordBpe(PieceIds):
    """The vocabulary ``word_bpe_49k.json`` or one of the same form: NFC, lower case, pieces, byte symbols, merges, word ends."""

    def __init__(self, path: str, ranges: dict | None = None):
        super().__init__(path, ranges or vocab.library_ranges())
        model = vocab.load(path)["model"]
        ids: dict[str, int] = model["vocab"]
        end: str = model.get("end_of_word_suffix") or ""
        self.names = {i: s for s, i in ids.items()} | {i: s for s, i in self.special.items()}
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(model["merges"])}
        chars = vocab.byte_chars()
        self.inner = [ids[c] for c in chars]
        self.last = [ids[c + end] for c in chars]
        raw = [(self.names.get(i, "") + " ").encode("utf-8") if i in self.names else b"" for i in range(max(self.names, default=-1) + 1)]
        self.name_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.name_size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.name_at = np.cumsum(self.name_size) - self.name_size

    def learned(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces, by one index over all of them."""
        inner, last = self.inner, self.last
        words = []
        for p in pieces:
            raw = p.encode("utf-8")
            word = [inner[b] for b in raw]
            word[-1] = last[raw[-1]]
            words.append(word)
        return apply_merges(words, self.merges)

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by spaces, special tokens kept: the vocabulary names no decoder."""
        return " ".join(self.names[i] for i in ids if i in self.names)

    def decoded(self, ids: list[np.ndarray]) -> list[bytes]:
        """``decode`` of each text's ids, in UTF-8, gathered from the names of all tokens."""
        every = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        raw, ends = bytearray(), [np.zeros(1, np.int64)]
        for i in range(0, len(every), NAMES):
            n = self.name_size[every[i : i + NAMES]]
            end = np.cumsum(n)
            at = np.repeat(self.name_at[every[i : i + NAMES]] - end + n, n) + np.arange(int(n.sum()))
            ends.append(end + len(raw))
            raw += self.name_bytes[at].tobytes()
        bounds = np.concatenate(ends)[np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])].tolist()
        return [bytes(raw[a : max(a, b - 1)]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


_OPEN: dict[str, WordBpe] = {}


def opened(path: str, ranges: dict) -> WordBpe:
    """The process's encoder for a file, so that its memo lasts from task to task."""
    if path not in _OPEN:
        _OPEN[path] = WordBpe(path, ranges)
    return _OPEN[path]


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids array<int>, decoded string`` of every text; null texts are empty. Other columns don't matter."""
    prepare(docs.sparkSession)
    path, ranges = path or vocab.default_path("word_bpe_49k.json"), vocab.library_ranges()
    docs = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches):
        bpe = opened(path, ranges)
        for batch in batches:
            for a, b in chunks(batch, "text"):
                ids = bpe.encode(texts_of(batch, "text", a, b))
                yield out_batch(schema, (batch.column("id").slice(a, b - a), [x.astype("i4") for x in ids], [x.decode("utf-8") for x in bpe.decoded(ids)]))

    return docs.mapInArrow(run, "id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text its token count and the SHA-256 of its ids and of its decoded text.

    The ids' bytes are hashed where they are made, so no array leaves Python.
    """
    prepare(docs.sparkSession)
    path, ranges = path or vocab.default_path("word_bpe_49k.json"), vocab.library_ranges()
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        bpe = opened(path, ranges)
        sha = hashlib.sha256
        for batch in batches:
            for a, b in chunks(batch, "text"):
                ids = bpe.encode(texts_of(batch, "text", a, b))
                yield out_batch(schema, (batch.column("doc_id").slice(a, b - a), [len(x) for x in ids], [sha(x.astype("<u4").tobytes()).hexdigest() for x in ids], [sha(x).hexdigest() for x in bpe.decoded(ids)]))

    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
