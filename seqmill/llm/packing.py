"""Operator 5: packing documents into training sequences by non-negative least squares.

A document's ids are cut into full windows and one remainder. Full windows are
sequences by themselves. The remainders' lengths make a histogram of at most
``window - 1`` bins, whatever the corpus; on it, shallow combinations of
lengths that fill a window exactly are enumerated, their repeat counts are
solved for by non-negative least squares, rounded and capped by what is there,
and what is left is packed greedily where that fills windows well. What then
still is left, such as thousands of copies of one awkward length, is laid end
to end, on a grid of a few ids, and cut where windows end. The plan has a few
thousand rows at most.

Each remainder then finds its place by its ordinal among the pieces of its
length: tasks number their own pieces, and a running sum of the tasks' counts
gives each task its first ordinal. No piece list meets in one task. A piece's
checksums up to each grid point are stored with it, so that the checksums of
its parts follow without its ids.

Defined results: a null or empty text is the closing id alone; repeated rows
are packed once each; null ids are kept; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vocab
from .common import chunks, out_batch, prepare, stored, table, texts_of
from .pieces import PieceIds

WINDOW = 2048
#: UTF-8 bytes that are cut and looked up at once.
CHUNK = 1 << 18
#: The id that closes each document.
CLOSING_ID = 1
#: Remainders are cut at multiples of so many ids. It divides the window.
GRID = 32
#: Ids that a greedily packed window may always leave empty; where it would leave more, pieces are laid end to end if that leaves less.
LEAST_ROOM = 8
#: Rounds of the multiplicative solver, and quantile lengths that combinations of three and of four take their inner lengths from.
ROUNDS, INNER_3, INNER_4 = 300, 24, 8


class LibraryIds(PieceIds):
    """Ids as the tokenizers library gives them: its own model encodes new pieces."""

    def __init__(self, path: str, ranges: dict):
        from tokenizers import Tokenizer

        super().__init__(path, ranges)
        self.model = Tokenizer.from_file(path).model
        self.shown = dict(enumerate(vocab.byte_chars()))

    def learned(self, pieces: list[str]) -> list[list[int]]:
        # the byte characters of a piece
        return [[t.id for t in self.model.tokenize(p.encode("utf-8").decode("latin-1").translate(self.shown))] for p in pieces]


_OPEN: dict[str, LibraryIds] = {}


def combinations(hist: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rows of four lengths, 0 for none, ascending, that add up to ``window``; each length occurs in ``hist``."""
    there = np.flatnonzero(hist)
    there = there[(there > 0) & (there < window)]
    if not len(there):
        return np.zeros((0, 4), np.int64)
    present = np.zeros(window + 1, bool)
    present[there] = True
    mass = np.cumsum(hist[there] * there)

    def inner(k: int) -> np.ndarray:
        at = np.searchsorted(mass, mass[-1] * (np.arange(k) + 0.5) / k)
        return np.unique(there[np.minimum(at, len(there) - 1)])

    a = there
    found = [np.stack([0 * a, 0 * a, a, window - a], 1)]
    x, b = (m.ravel() for m in np.meshgrid(a, inner(INNER_3), indexing="ij"))
    found.append(np.stack([0 * x, x, b, window - x - b], 1))
    q = inner(INNER_4)
    x, b, c = (m.ravel() for m in np.meshgrid(a, q, q, indexing="ij"))
    found.append(np.stack([x, b, c, window - x - b - c], 1)[b <= c])
    rows = np.concatenate(found)
    rows = rows[rows[:, 3] > 0]
    rows = rows[present[rows[:, 3]]]
    return np.unique(np.sort(rows, axis=1), axis=0)


def nonnegative(rows: np.ndarray, hist: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 of the combinations that bring their lengths' use near the histogram, by multiplicative updates."""
    n = len(hist)
    h = hist.astype(float)
    h[0] = 0

    def use(x: np.ndarray) -> np.ndarray:
        out = np.bincount(rows.ravel(), np.repeat(x, rows.shape[1]), n)
        out[0] = 0
        return out

    top = h[rows].sum(1)
    x = np.where(rows > 0, h[rows], np.inf).min(1) / max(1.0, len(rows) / n)
    for _ in range(rounds):
        x *= top / np.maximum(use(x)[rows].sum(1), 1e-12)
    return x


def make_plan(hist: np.ndarray, window: int = WINDOW) -> tuple[list[tuple[dict[int, int], int]], list[tuple[int, int]]]:
    """Windows, as lengths with how often each occurs and repeats, and what is laid end to end, as lengths with counts; together the whole histogram."""
    left = np.asarray(hist, np.int64).copy()
    left[0] = 0
    plan: list[tuple[dict[int, int], int]] = []
    if left[window]:
        plan.append(({window: 1}, int(left[window])))
        left[window] = 0
    rows = combinations(left, window)
    if len(rows):
        x = np.rint(nonnegative(rows, left)).astype(np.int64)
        for k in np.argsort(-x, kind="stable"):
            if not x[k]:
                break
            lengths, times = np.unique(rows[k][rows[k] > 0], return_counts=True)
            n = min(int(x[k]), int((left[lengths] // times).min()))
            if n:
                left[lengths] -= n * times
                plan.append((dict(zip(lengths.tolist(), times.tolist(), strict=True)), n))
    sizes, stream = np.flatnonzero(left).tolist(), {}
    while sizes:
        room, parts = window, {}
        while room > 0:
            k = bisect_right(sizes, room) - 1
            while k >= 0 and left[sizes[k]] <= parts.get(sizes[k], 0):
                k -= 1
            if k < 0:
                break
            size = sizes[k]
            n = min(room // size, int(left[size]) - parts.get(size, 0))
            parts[size] = parts.get(size, 0) + n
            room -= n * size
        n = min(int(left[size]) // times for size, times in parts.items())
        top = max(parts)
        step = -(-top // GRID) * GRID
        if room > LEAST_ROOM and room * step > (step - top) * window and int(left @ np.arange(len(left))) > window:
            # the largest of the lengths goes to the stream, where it leaves less empty, and the others try again
            parts, n = {top: 1}, int(left[top])
            stream[top] = n
        else:
            plan.append((parts, n))
        for size, times in parts.items():
            left[size] -= n * times
            if not left[size]:
                sizes.remove(size)
    return plan, sorted(stream.items(), reverse=True)


class Places:
    """From a piece's length and its ordinal among that length's pieces to its sequences and offsets there."""

    def __init__(self, plan: list[tuple[dict[int, int], int]], stream: list[tuple[int, int]] = (), window: int = WINDOW):
        self.window = window
        used: dict[int, int] = {}
        rows: list[tuple[int, int, int, int, int]] = []
        first = 0
        for parts, n in plan:
            at = 0
            for size in sorted(parts, reverse=True):
                times = parts[size]
                rows.append((size, used.get(size, 0), first, times, at))
                used[size] = used.get(size, 0) + n * times
                at += size * times
            first += n
        rows.sort()
        self.size, self.start, self.first, self.times, self.at = np.array(rows, np.int64).reshape(-1, 5).T
        self.keys = (self.size << 48) + self.start
        # the stream: pieces begin on the grid, and the gaps behind them close again inside each window
        self.base_seq = first
        self.stream_from = np.full(window + 1, np.iinfo(np.int64).max, np.int64)
        self.stream_base = np.zeros(window + 1, np.int64)
        bases, steps, gaps, before, pos, gap = [0], [1], [0], [0], 0, 0
        for size, n in stream:
            step = -(-size // GRID) * GRID
            self.stream_from[size], self.stream_base[size] = used.get(size, 0), pos
            bases.append(pos)
            steps.append(step)
            gaps.append(step - size)
            before.append(gap)
            pos, gap = pos + n * step, gap + n * (step - size)
        self.bases, self.steps, self.gaps, self.before = (np.array(x, np.int64) for x in (bases, steps, gaps, before))
        self.sequences = first + -(-pos // window)

    def _gap(self, pos: np.ndarray) -> np.ndarray:
        """All gaps before positions of the stream that lie in pieces."""
        k = np.searchsorted(self.bases, pos, side="right") - 1
        return self.before[k] + (pos - self.bases[k]) // self.steps[k] * self.gaps[k]

    def find(self, length: np.ndarray, ordinal: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, start in the piece, length, sequence and offset of every part; a piece has one part, or two where it is cut."""
        streamed = ordinal >= self.stream_from[length]
        i = np.flatnonzero(~streamed)
        n, o = length[i], ordinal[i]
        k = np.searchsorted(self.keys, (n << 48) + o, side="right") - 1
        since = o - self.start[k]
        out = [(i, np.zeros_like(n), n, self.first[k] + since // self.times[k], self.at[k] + since % self.times[k] * n)]
        i = np.flatnonzero(streamed)
        if len(i):
            n, w = length[i], self.window
            pos = self.stream_base[n] + (ordinal[i] - self.stream_from[n]) * (-(-n // GRID) * GRID)
            seq = pos // w
            head = np.minimum(n, (seq + 1) * w - pos)
            begin = seq * w
            out.append((i, np.zeros_like(n), head, self.base_seq + seq, pos - begin - (self._gap(pos) - self._gap(begin))))
            cut = np.flatnonzero(head < n)
            out.append((i[cut], head[cut], n[cut] - head[cut], self.base_seq + seq[cut] + 1, np.zeros(len(cut), np.int64)))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _zero_bytes() -> np.ndarray:
    """For each k the columns of the matrix that takes a checksum over 2**k zero bytes."""
    column = np.array([0xEDB88320] + [1 << i for i in range(31)], np.uint64)  # one zero bit
    out = []
    for k in range(3 + 14):
        if k >= 3:
            out.append(column)
        column = _times(column, column)
    return np.array(out)


def _times(columns: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros_like(values)
    for bit in range(32):
        out ^= np.where(values >> np.uint64(bit) & np.uint64(1), columns[bit], np.uint64(0))
    return out


_ZEROS = _zero_bytes()


def tail_crc(head: np.ndarray, whole: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksum of the last ``size`` bytes, from that of what is before them and that of all."""
    moved = head.astype(np.uint64)
    for k in range(len(_ZEROS)):
        there = (size >> k & 1).astype(bool)
        moved[there] = _times(_ZEROS[k], moved[there])
    return (moved ^ whole.astype(np.uint64)).astype(np.int64)


def cut(docs: DataFrame, path: str | None = None, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise and cut: full windows from the start, then the remainder.

    ``grid`` has a remainder's checksums up to each grid point. ``part`` and ``nth`` number the pieces of each length in each task; they hold once the result is stored.
    """
    prepare(docs.sparkSession)
    path, ranges = path or vocab.default_path("word_bpe_49k.json"), vocab.library_ranges()
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    types = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "part": pa.int32(), "nth": pa.int64(), "grid": pa.binary()}
    schema = pa.schema(list(types.items()))

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        closing = np.array([CLOSING_ID], "<u4").tobytes()
        if path not in _OPEN:
            _OPEN[path] = LibraryIds(path, ranges)
        counts = [0] * (window + 1)
        for batch in batches:
            for a, b in chunks(batch, "text", CHUNK):
                ids = batch.column("doc_id").slice(a, b - a).to_pylist()
                rows = []
                for doc, own in zip(ids, _OPEN[path].encode(texts_of(batch, "text", a, b)), strict=True):
                    raw = own.astype("<u4").tobytes() + closing
                    n = len(raw) // 4
                    for start in range(0, n, window):
                        length, crc, grid = min(window, n - start), 0, []
                        step = 4 * (window if length == window else GRID)
                        for at in range(4 * start, 4 * (start + length), step):
                            crc = zlib.crc32(raw[at : min(at + step, 4 * (start + length))], crc)
                            grid.append(crc)
                        rows.append((doc, start, length, crc, n, part, counts[length], None if length == window else np.array(grid, "<u4").tobytes()))
                        counts[length] += 1
                yield out_batch(schema, map(list, zip(*rows, strict=True)))

    return docs.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long, grid binary")


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``; sequences are gapless from 0.

    The cut pieces are a table in the shared folder, about 50 bytes a piece, so
    that a lost executor renumbers nothing.
    """
    pieces = stored(cut(docs, path, window, id_col, text_col), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    hist = np.zeros(window + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # window rows at most
        hist[r["length"]] = r["n"]
    places = Places(*make_plan(hist, window), window)
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    placed = pieces.join(base, ["length", "part"]).select(*names, "grid", (F.col("base") + F.col("nth")).alias("ordinal"))
    schema = pa.schema([(c, pa.int64()) for c in (*names, "sequence_id", "offset")])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                row, at, size, seq, offset = places.find(batch.column("length").to_numpy(), batch.column("ordinal").to_numpy())
                doc, start, length, crc, tokens = (batch.column(c).take(pa.array(row)).to_numpy(zero_copy_only=False) if c != "doc_id" else batch.column(c).take(pa.array(row)) for c in names)
                crc = crc.copy()
                cut_ = np.flatnonzero(size < length)
                if len(cut_):
                    grid = batch.column("grid").take(pa.array(row[cut_])).to_pylist()
                    split = np.where(at[cut_] > 0, at[cut_], size[cut_])  # where the piece is cut
                    head = np.array([int.from_bytes(g[k : k + 4], "little") for g, k in zip(grid, (4 * (split // GRID - 1)).tolist(), strict=True)], np.int64)
                    crc[cut_] = np.where(at[cut_] > 0, tail_crc(head, crc[cut_], 4 * size[cut_]), head)
                yield out_batch(schema, [doc, *(pa.array(x) for x in (start + at, size, crc, tokens, seq, offset))])

    return placed.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def padding(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Tokens, sequences and padded slots; a sequence whose length is a power of two has none."""
    size = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    whole = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    return size.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("sequences"), F.sum(F.when(whole, 0).otherwise(window - F.col("n"))).alias("padded"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
