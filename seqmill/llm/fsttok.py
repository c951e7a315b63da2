"""Operator 10: token counts by compiled finite-state transducers.

Two deterministic transducers run one after the other.

The *cutter* reads character classes and marks where the vocabulary's pieces
begin. Its twelve states make a chunk's effect a map from entry state to exit
state; the chunks' maps are found side by side, composed by a parallel prefix
scan, and each chunk is then run from the entry state that the scan gives it.

The *counter* reads a piece's bytes. A state holds the longest suffix that can
still grow into a token, and for each position in it the last token of the
encoding up to there and that encoding's token count relative to now. The last
token of the longer prefix is the one suffix token that may stand after the
last token before it; whether two tokens may stand side by side depends on
those two alone. Every transition is annotated with the change in the count of
tokens. Transitions are compiled when first taken and kept in a dense table.
A piece resets the counter, so that the counts of pieces add up. A long piece is
cut into chunks that are run side by side. Their maps hold the entry states met
so far, at first those that the bytes just before a chunk lead to; a prefix scan
composes the maps up to the first chunk whose entry state no map has, and that
state is then run through all chunks.

Defined results: null texts are empty, empty texts have no tokens, texts are
read whole, repeated rows are counted once each, null ids are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import vocab
from .common import chunks, out_batch, prepare, table, texts_of

# character classes of the cutter; letters that occur in contractions have classes of their own
END, SPACE, BLANK, LETTER, NUMBER, OTHER, QUOTE, STDM, RV, E_, L_ = range(11)
_CLASSES = 11
# states: what the last characters were
START, SPACE_1, SPACE_N, BLANK_1, BLANK_N, IN_LETTERS, IN_NUMBERS, IN_OTHERS, FREE_QUOTE, QUOTE_RV, QUOTE_L, CONTRACTED = range(12)
_STATES = 12
#: Characters of a chunk, and the steps after which entry states are first looked at for having met.
CHUNK, MEET = 512, 8
#: UTF-8 bytes of the texts whose pieces are run side by side.
CHUNK_BYTES = 1 << 21
#: Bytes from which a piece is long, of its chunks, read before a chunk to guess its entry state, and of a long piece that are run side by side.
LONG, SPAN, LEAD, BLOCK = 4096, 256, 48, 1 << 20
#: Entry states that are run through all chunks of a block; what then is left of the block is run in order.
ENTRIES = 64


def _cutter() -> tuple[np.ndarray, np.ndarray]:
    """Next states, and marks: 1 where a piece begins at this character, 2 where one begins at the character before."""
    step = np.zeros((_STATES, _CLASSES), np.uint8)
    mark = np.zeros((_STATES, _CLASSES), np.uint8)
    letters = (LETTER, STDM, RV, E_, L_)
    blanks = {SPACE: (SPACE_1, SPACE_N), BLANK: (BLANK_1, BLANK_N)}
    fresh = {**{c: IN_LETTERS for c in letters}, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: FREE_QUOTE}
    for s in range(_STATES):
        for c in range(_CLASSES):
            to, at = START, 1
            if c in blanks:
                run = s in (SPACE_1, SPACE_N, BLANK_1, BLANK_N)
                to, at = blanks[c][run], 0 if run else 1
            elif c != END:
                to = fresh[c]
                if s in (SPACE_1, SPACE_N):  # a space belongs to the piece after it, and a quote after it isn't free
                    to, at = IN_OTHERS if c == QUOTE else to, 2 if s == SPACE_N else 0
                elif s == BLANK_N:
                    at = 3
                elif s == IN_LETTERS and c in letters or s == IN_NUMBERS and c == NUMBER:
                    at = 0
                elif s in (IN_OTHERS, FREE_QUOTE) and c in (OTHER, QUOTE):
                    to, at = IN_OTHERS, 0
                elif s == FREE_QUOTE and c in (STDM, RV, L_):
                    to, at = {STDM: CONTRACTED, RV: QUOTE_RV, L_: QUOTE_L}[c], 0
                elif s == QUOTE_RV and c == E_ or s == QUOTE_L and c == L_:
                    to, at = CONTRACTED, 0
                elif s in (QUOTE_RV, QUOTE_L) and c in letters:
                    at = 2
            if s in (QUOTE_RV, QUOTE_L) and to != CONTRACTED:
                at |= 2  # no contraction after all: the letter before began a piece
            step[s, c], mark[s, c] = to, at
    return step.ravel(), mark.ravel()


class Cutter:
    """Piece starts of texts by a transducer's tables, with classes as the tokenizers library has them."""

    def __init__(self, ranges: dict[str, list[tuple[int, int]]], tables: tuple[np.ndarray, np.ndarray] | None = None):
        self.classes = np.full(0x110000, OTHER, np.uint8)
        for name, c in (("L", LETTER), ("N", NUMBER), ("S", BLANK)):
            for a, b in ranges[name]:
                self.classes[a : b + 1] = c
        for chars, c in ((" ", SPACE), ("'", QUOTE), ("stdm", STDM), ("rv", RV), ("e", E_), ("l", L_)):
            for x in chars:
                self.classes[ord(x)] = c
        self.step, self.mark = tables or _cutter()
        self.states = len(self.step) // _CLASSES

    def starts(self, classes: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each character; a text ends with the class END, which is a piece of its own."""
        n = len(classes)
        rows = -(-n // CHUNK)
        cells = np.full(rows * CHUNK, END, np.uint8)
        cells[:n] = classes
        columns = np.ascontiguousarray(cells.reshape(rows, CHUNK).T)
        before = np.empty((CHUNK, rows), np.uint8)
        # maps of all entry states, until they have met in every chunk
        maps = np.repeat(np.arange(self.states, dtype=np.uint8)[:, None], rows, 1)
        t = 0
        while t < CHUNK:
            for _ in range(min(MEET, CHUNK - t)):
                maps = self.step[maps.astype(np.int16) * _CLASSES + columns[t]]
                t += 1
            if (maps == maps[0]).all():
                maps = maps[:1]
                break
        met = t
        state = maps[0]
        if len(maps) == 1:  # one lane is enough from here on
            for t in range(met, CHUNK):
                before[t] = state
                state = self.step[state.astype(np.int16) * _CLASSES + columns[t]]
            maps = np.repeat(state[None], self.states, 0)
        # inclusive prefix scan over the chunks: after each round a map spans twice as many chunks
        scan = maps.T.copy()
        span = 1
        while span < rows:
            scan[span:] = np.take_along_axis(scan[span:], scan[:-span].astype(np.intp), 1)
            span *= 2
        state = np.concatenate(([START], scan[:-1, START])).astype(np.uint8)
        for t in range(met):
            before[t] = state
            state = self.step[state.astype(np.int16) * _CLASSES + columns[t]]
        marks = self.mark[before.astype(np.int16) * _CLASSES + columns].T.ravel()[:n]
        out = (marks & 1).astype(bool)
        out[:-1] |= (marks[1:] & 2).astype(bool)
        return out


class Counter:
    """The counting transducer of a byte-level merge list."""

    #: Transitions that the table keeps between chunks; beyond that it is compiled anew.
    KEPT = 600_000
    #: Slots of the table, as a power of two; it doubles where one chunk alone brings it past half.
    BITS = 21

    def __init__(self, merges: list[tuple[str, str]]):
        to_byte = {c: i for i, c in enumerate(vocab.byte_chars())}
        raw = lambda s: bytes(to_byte[c] for c in s)
        self.token: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        self.split: list[tuple[int, int] | None] = [None] * 256
        self.pair: dict[tuple[int, int], int] = {}
        for a, b in merges:
            x, y = raw(a), raw(b)
            parts = self.token[x], self.token[y]
            self.pair[parts] = self.token[x + y] = len(self.split)
            self.split.append(parts)
        self.prefixes = {t[:k] for t in self.token for k in range(1, len(t) + 1)}
        self.beside: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.keys = [(b"", (-1,), (0,))]
        self.number = {self.keys[0]: 0}
        self._slots(self.BITS)

    def _slots(self, bits: int) -> None:
        """An open-addressed table from state and byte to next state and change; slots that are free hold -1."""
        self.bits, self.filled = bits, 0
        self.slot = np.full(1 << bits, -1, np.int64)
        self.value = np.zeros(1 << bits, np.int32)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _put(self, key: int, value: int) -> None:
        if 2 * self.filled > 1 << self.bits:
            slot, old = self.slot, self.value
            self._slots(self.bits + 1)
            for i in np.flatnonzero(slot >= 0).tolist():
                self._put(int(slot[i]), int(old[i]))
        at = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 64 - self.bits
        while self.slot[at] >= 0:
            at = at + 1 & (1 << self.bits) - 1
        self.slot[at], self.value[at] = key, value
        self.filled += 1

    def look(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys; those that are missing are compiled."""
        at = self._home(keys)
        there = self.slot[at]
        out = self.value[at]
        wrong = np.flatnonzero(there != keys)
        while len(wrong):
            free = there[wrong] < 0
            if free.any():
                for key in dict.fromkeys(keys[wrong[free]].tolist()):
                    self._put(key, self.compile(key >> 8, key & 255))
                at[wrong] = self._home(keys[wrong])  # begin again: the table may have grown
            else:
                at[wrong] = at[wrong] + 1 & len(self.slot) - 1
            there[wrong] = self.slot[at[wrong]]
            out[wrong] = self.value[at[wrong]]
            wrong = wrong[there[wrong] != keys[wrong]]
        return out

    # The id of a merged token is its rank. A side's outermost symbol lives until the merge that takes it in.
    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        out = [(token, 1 << 30)]
        while self.split[token]:
            out.append((self.split[token][side], token))
            token = self.split[token][side]
        return out

    def _crossing(self, a: int, b: int) -> set[tuple[int, int]]:
        """Pairs of symbols across the border of a and b that would merge while both live; of equal ranks the left one goes first."""
        pair = self.pair
        right = self._edge(b, 0)
        return {(x, y) for x, dies_x in self._edge(a, 1) for y, dies_y in right if (r := pair.get((x, y))) is not None and r < dies_x and r <= dies_y}

    def may_follow(self, a: int, b: int) -> bool:
        """Whether a's text followed by b's is encoded as these two tokens."""
        found = self.beside.get((a, b))
        if found is None:
            found = self.beside[a, b] = self.is_whole(b) and not self._crossing(a, b)
        return found

    def is_whole(self, t: int) -> bool:
        """Whether a token's own text is encoded as that token."""
        if not self.split[t]:
            return True
        if t not in self.whole:
            a, b = self.split[t]
            self.whole[t] = self.is_whole(a) and self.is_whole(b) and self._crossing(a, b) == {(a, b)}
        return self.whole[t]

    def compile(self, state: int, byte: int) -> int:
        """Make one transition: next state and change of the count, packed."""
        suffix, lasts, counts = self.keys[state]
        grown = suffix + bytes([byte])
        for k in range(len(grown)):
            t = self.token.get(grown[k:])
            if t is not None and (self.is_whole(t) if lasts[k] < 0 else self.may_follow(lasts[k], t)):
                break
        else:
            raise AssertionError("no token ends here")
        change = counts[k] + 1
        for k in range(len(grown) + 1):
            if k == len(grown) or grown[k:] in self.prefixes:
                break
        # only where a token may still begin does what stands before matter
        live = [j for j in range(k, len(grown)) if grown[j:] in self.prefixes]
        last, count = [None] * (len(grown) - k), [0] * (len(grown) - k)
        for j in live:
            last[j - k], count[j - k] = lasts[j], counts[j] - change
        key = (grown[k:], (*last, t), (*count, 0))
        to = self.number.setdefault(key, len(self.keys))
        if to == len(self.keys):
            self.keys.append(key)
        return to << 8 | change + 128

    def count(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Token counts of byte ranges: long ones by composed maps, the others all a step at a time, ``BLOCK`` bytes at once."""
        out = np.zeros(len(begin), np.int64)
        long = length >= LONG
        for i in np.flatnonzero(long).tolist():
            out[i] = self._long(data[begin[i] : begin[i] + length[i]])
        short = np.flatnonzero(~long)
        block = np.cumsum(length[short]) // BLOCK
        for k in np.unique(block).tolist():
            own = short[np.searchsorted(block, k, "left") : np.searchsorted(block, k, "right")]
            if self.filled > self.KEPT:
                self.reset()
            out[own] = self._run(data, begin[own], length[own], np.zeros(len(own), np.int64))[1]
        return out

    def _run(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit states and token counts of byte ranges, each from its entry state."""
        order = np.argsort(-length, kind="stable")
        at, size = begin[order], length[order]
        state = entry[order]
        total = np.zeros(len(at), np.int64)
        active = len(at)
        for t in range(int(size[0]) if active else 0):
            while active and size[active - 1] <= t:
                active = int(np.searchsorted(-size, -t, side="left"))
            found = self.look(state[:active] << 8 | data[at[:active] + t])
            state[:active] = found >> 8
            total[:active] += (found & 255) - 128
        exits, out = np.empty_like(state), np.empty_like(total)
        exits[order], out[order] = state, total
        return exits, out

    def _long(self, data: np.ndarray) -> int:
        """Token count of one long piece, ``BLOCK`` bytes after another."""
        state, total = 0, 0
        for a in range(0, len(data), BLOCK):
            if self.filled > self.KEPT:  # the state outlives the table
                key = self.keys[state]
                self.reset()
                state = self.number.setdefault(key, len(self.keys))
                if state == len(self.keys):
                    self.keys.append(key)
            state, many = self._block(data[max(0, a - LEAD) : a + BLOCK], min(a, LEAD), state)
            total += many
        return total

    def _block(self, data: np.ndarray, first: int, state: int) -> tuple[int, int]:
        """Exit state and token count of ``data`` from ``first`` on."""
        begin = np.arange(first, len(data), SPAN)
        length = np.minimum(SPAN, len(data) - begin)
        rows = len(begin)
        lead = np.minimum(begin, LEAD)
        guess = self._run(data, begin - lead, lead, np.zeros(rows, np.int64))[0]
        # the maps: a column for each known entry state, after a column for each chunk's own guess
        entry = [guess]
        exits, counts = (x[:, None] for x in self._run(data, begin, length, guess))
        known = [state]
        while True:
            more = self._run(data, begin, length, np.full(rows, known[-1], np.int64))
            entry.append(np.full(rows, known[-1], np.int64))
            exits, counts = np.column_stack([exits, more[0]]), np.column_stack([counts, more[1]])
            # the column at which the next chunk has this exit state, or one beyond all where it has none
            none = len(entry)
            hop = np.full((rows, none + 1), none, np.int64)
            for c in reversed(range(none)):
                hop[:-1, :none][exits[:-1] == entry[c][1:, None]] = c
            scan, span = hop[:-1].copy(), 1
            while span < rows - 1:
                scan[span:] = np.take_along_axis(scan[span:], scan[:-span], 1)
                span *= 2
            column = np.append(1, scan[:, 1])  # the first chunk's entry state is the first that is known
            lost = np.flatnonzero(column == none)
            if not len(lost):
                at = np.arange(rows)
                return int(exits[-1, column[-1]]), int(counts[at, column].sum())
            k = int(lost[0])
            state = int(exits[k - 1, column[k - 1]])
            if len(known) == ENTRIES:
                at = np.arange(k)
                last, many = self._run(data, begin[k : k + 1], np.array([len(data) - begin[k]]), np.array([state]))
                return int(last[0]), int(counts[at, column[:k]].sum() + many[0])
            known.append(state)


class TokenCounter:
    """Counts as ``byte_bpe_50k.json`` or a file of the same form gives them."""

    def __init__(self, path: str, ranges: dict[str, list[tuple[int, int]]]):
        spec = vocab.load(path)
        self.cutter = Cutter(ranges)
        self.counter = Counter([tuple(m) for m in spec["model"]["merges"]])
        self.special = [t["content"] for t in spec["added_tokens"]]

    def counts(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for i, text in enumerate(texts):
            own = [text]
            for s in self.special:  # special strings are one token each, and texts end before them
                if s in text:
                    own = [x for part in own for x in part.split(s)]
            total[i] += len(own) - 1
            parts += own
            owner += [i] * len(own)
        joined = "\n".join(parts) + "\n"
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        classes = self.cutter.classes[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        ends = np.cumsum(sizes + 1) - 1
        classes[ends] = END
        starts = np.flatnonzero(self.cutter.starts(classes))
        data = np.frombuffer(joined.encode("utf-8"), np.uint8)
        place = starts if len(data) == len(classes) else np.flatnonzero((data & 0xC0) != 0x80)[starts]
        length = np.diff(place, append=len(data))
        piece = classes[starts] != END
        text = np.searchsorted(ends, starts[piece], side="left")
        found = self.counter.count(data, place[piece], length[piece])
        per_part = np.bincount(text, found, len(parts)).astype(np.int64)
        np.add.at(total, np.array(owner, np.int64), per_part)
        return total


_OPEN: dict[str, TokenCounter] = {}


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text its bytes, tokens, and whether the tokens are more than ``limit``."""
    prepare(docs.sparkSession)
    path, ranges = path or vocab.default_path("byte_bpe_50k.json"), vocab.library_ranges()
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches):
        import pyarrow.compute as pc

        if path not in _OPEN:
            _OPEN[path] = TokenCounter(path, ranges)
        for batch in batches:
            for a, b in chunks(batch, "text", CHUNK_BYTES):
                n = _OPEN[path].counts(texts_of(batch, "text", a, b))
                size = pc.fill_null(pc.binary_length(batch.column("text").slice(a, b - a)), 0).cast(pa.int64())
                yield out_batch(schema, (batch.column("doc_id").slice(a, b - a), size, pa.array(n), pa.array(n > limit)))

    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
