"""Pieces of the word vocabulary: texts are cut by a transducer, and pieces met before are looked up in a table."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np

from . import vocab
from .fsttok import _CLASSES, BLANK, E_, END, L_, LETTER, NUMBER, OTHER, QUOTE, RV, SPACE, STDM, Cutter
from .shingles import _BYTE_PLAIN, _powers, mix

#: Characters that are cut and looked up at once, where white space lets them be parted.
SEGMENT = 1 << 18
_SPACE = re.compile(r"[ \n]")


def normal(text: str) -> str:
    """NFC and lower case, one code point at a time as the library does it: a capital sigma has no final form."""
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


#: States of the word vocabulary's cutter.
_GAP, _LETTERS, _NUMBER, _OTHERS, _QUOTE, _QUOTE_RV, _QUOTE_L, _CONTRACTED = range(8)


def _word_tables() -> tuple[np.ndarray, np.ndarray]:
    """The cutter of letters, contractions, single numbers and other marks; white space is cut off character by character."""
    step, mark = np.zeros((8, _CLASSES), np.uint8), np.zeros((8, _CLASSES), np.uint8)
    letters = (LETTER, STDM, RV, E_, L_)
    fresh = {END: _GAP, SPACE: _GAP, BLANK: _GAP, NUMBER: _NUMBER, OTHER: _OTHERS, QUOTE: _QUOTE, **{c: _LETTERS for c in letters}}
    inside = {(_LETTERS, c): _LETTERS for c in letters} | {(s, c): _OTHERS for s in (_OTHERS, _QUOTE) for c in (OTHER, QUOTE)}
    inside |= {(_QUOTE, STDM): _CONTRACTED, (_QUOTE, RV): _QUOTE_RV, (_QUOTE, L_): _QUOTE_L, (_QUOTE_RV, E_): _CONTRACTED, (_QUOTE_L, L_): _CONTRACTED}
    for s in range(8):
        for c in range(_CLASSES):
            step[s, c], mark[s, c] = (inside[s, c], 0) if (s, c) in inside else (fresh[c], 1)
            if s in (_QUOTE_RV, _QUOTE_L) and step[s, c] != _CONTRACTED:  # no contraction: the letter before began a piece
                mark[s, c] = 2 if c in letters else 3
    return step.ravel(), mark.ravel()


class PieceIds:
    """Ids of texts, a chunk of texts at a time; ``learned`` encodes the pieces not met before.

    Pieces are cut by a transducer and known by two 64-bit hashes; the ids of
    pieces met before are gathered from a pool, and all new pieces of a chunk
    are encoded at once. The memo begins anew at a chunk when it has more than
    ``KEPT`` pieces. Within a chunk, which may be one long text, its table
    doubles before it is half full.
    """

    KEPT, BITS = 500_000, 17

    def __init__(self, path: str, ranges: dict):
        added = vocab.load(path)["added_tokens"]
        self.special = {t["content"]: t["id"] for t in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cutter = Cutter(ranges, _word_tables())
        self.other = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.reset()

    def learned(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece."""
        raise NotImplementedError

    def reset(self) -> None:
        self._empty(self.BITS)
        self.pool, self.used, self.filled = np.zeros(1 << 16, np.uint32), 0, 0

    def _empty(self, bits: int) -> None:
        self.bits = bits
        self.key = np.zeros((2, 1 << bits), np.uint64)
        self.at = np.zeros(1 << bits, np.int64)
        self.size = np.zeros(1 << bits, np.int32)

    def _room(self, more: int) -> None:
        """Doubles the table until it is at most half full with ``more`` pieces."""
        bits = self.bits
        while 2 * (self.filled + more) > 1 << bits:
            bits += 1
        if bits > self.bits:
            old = np.flatnonzero(self.size)
            key, at, size = self.key[:, old], self.at[old], self.size[old]
            self._empty(bits)
            self._put(key[0], key[1], at, size)

    def _put(self, k1: np.ndarray, k2: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        left = np.arange(len(k1))
        while len(left):  # of keys that want the same slot one gets it, and the others look again
            slot, first = np.unique(self._slots(k1[left], k2[left]), return_index=True)
            i = left[first]
            self.key[0, slot], self.key[1, slot] = k1[i], k2[i]
            self.at[slot], self.size[slot] = at[i], size[i]
            left = np.delete(left, first)

    def _slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """The slot of each key, or the free one where it belongs."""
        last = (1 << self.bits) - 1
        slot = (k1 >> np.uint64(64 - self.bits)).astype(np.int64)
        wrong = np.flatnonzero((self.size[slot] > 0) & ((self.key[0][slot] != k1) | (self.key[1][slot] != k2)))
        while len(wrong):
            slot[wrong] = slot[wrong] + 1 & last
            s = slot[wrong]
            wrong = wrong[(self.size[s] > 0) & ((self.key[0][s] != k1[wrong]) | (self.key[1][s] != k2[wrong]))]
        return slot

    def _learn(self, k1: np.ndarray, k2: np.ndarray, pieces: list[str]) -> None:
        self._room(len(pieces))
        found = self.learned(pieces)
        ids = np.array([i for x in found for i in x], np.uint32)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in found])])
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        self._put(k1, k2, self.used + ends[:-1], np.diff(ends))
        self.used += len(ids)
        self.filled += len(pieces)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        parts, owner, size = [], [], 0
        for i, text in enumerate(texts):
            for k, x in enumerate(self.cut.split(text) if self.cut else [text]):
                if k % 2:  # a special string, after what comes before it
                    self._encode(parts, owner, out)
                    parts, owner, size = [], [], 0
                    out[i].append(np.array([self.special[x]], np.uint32))
                    continue
                for part in _segments(normal(x)):
                    if size + len(part) > SEGMENT:
                        self._encode(parts, owner, out)
                        parts, owner, size = [], [], 0
                    parts.append(part)
                    owner.append(i)
                    size += len(part)
        self._encode(parts, owner, out)
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.uint32) for x in out]

    def _encode(self, parts: list[str], owner: list[int], out: list[list[np.ndarray]]) -> None:
        """Appends each part's ids to its owner's."""
        if not parts:
            return
        joined = "\n".join(parts) + "\n"
        classes = self.cutter.classes[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        classes[ends] = END
        starts = np.flatnonzero(self.cutter.starts(classes))
        data = np.frombuffer(joined.encode("utf-8"), np.uint8)
        place = starts if len(data) == len(classes) else np.flatnonzero((data & 0xC0) != 0x80)[starts]
        stop = np.append(place[1:], len(data))
        first = classes[starts]
        keep = np.flatnonzero((first != END) & (first != SPACE) & (first != BLANK))
        part = np.searchsorted(ends, starts[keep], side="left")
        a, b = place[keep], stop[keep]
        up, down = _powers(len(data) + 1)
        keys = []
        total = np.zeros(len(data) + 1, np.uint64)
        for byte in (_BYTE_PLAIN, self.other):
            np.cumsum(byte[data] * up[:-1], out=total[1:])
            keys.append(mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64)))
        k1, k2 = keys
        if self.filled > self.KEPT:
            self.reset()
        slot = self._slots(k1, k2)
        new = np.flatnonzero(self.size[slot] == 0)
        if len(new):
            new = new[np.unique(k1[new], return_index=True)[1]]
            raw = data.tobytes()
            self._learn(k1[new], k2[new], [raw[a[i] : b[i]].decode("utf-8") for i in new.tolist()])
            slot = self._slots(k1, k2)
        size = self.size[slot].astype(np.int64)
        at = np.repeat(self.at[slot] - np.cumsum(size) + size, size) + np.arange(size.sum())
        ids = self.pool[at]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(part, size, len(parts)).astype(np.int64))])
        for k, i in enumerate(owner):
            out[i].append(ids[bounds[k] : bounds[k + 1]])


def _segments(text: str) -> Iterator[str]:
    """A long text in parts that end before white space, where no piece goes on."""
    at = 0
    while len(text) - at > SEGMENT and (m := _SPACE.search(text, at + SEGMENT)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text
