"""Operator 1: language identification with string kernels.

The kernel of two passages is the blended-spectrum presence kernel: the number
of n-grams of one to three symbols that both have, divided by the root of the
product of their own numbers. A bounded, per-language sample of labelled rows
is read and cut into passages of some hundred symbols; some passages are
Nyström landmarks, and one ridge regression per language, each against the
rest, is fitted on the kernel values of the passages against the landmarks. A
text is scored passage by passage, by two matrix products over a batch:
presences by landmark presences, and kernel values by coefficients; its values
are the passages' mean by length. So a text in two languages counts as the one
of which it has more, and not as the one with more different n-grams.

Symbols are the most frequent lower-case letters of the sample; its other letters
share these symbols by code point, so that texts in a rarer script have n-grams
too; all letters that the sample has not are one symbol, and any run of
characters that are no letters is one.

Defined results: a text that is null or has no letter is ``und`` with score 0,
as is every text where no row is labelled; ties go to the language that sorts
first; texts are read whole; repeated rows are scored alike.

``calibrated`` adds a rejection for the pipeline: a text's margin is how far the
best language of each passage is above the second, and it has to reach a share
of the median margin that held-back labelled texts with about as many n-grams
have. Texts that fail are cut into short passages and held against short
passages' margins. So a text in no learned language, or noise, goes, and a
short text is not held to the margin of a long one; a text stays that goes
from one learned language to another inside a passage.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, prepare, stored, table, texts_of

UNKNOWN = "und"
SYMBOLS = 48
GRAMS = SYMBOLS + SYMBOLS**2 + SYMBOLS**3
#: Symbols of a passage, and of a short one.
PASSAGE, SHORT = 512, 128
#: Bounds of what is learned from, by language: texts, their bytes but for the last text, landmarks; and passages of one text.
SAMPLE, SAMPLE_BYTES, LANDMARKS, PER_TEXT = 400, 8 << 20, 32, 16
#: The same of all languages, which share these where they are many; each has one text and one landmark at least.
ALL_TEXTS, ALL_BYTES, ALL_LANDMARKS = 20_000, 256 << 20, 1024
#: Passages whose presences are held at once, and UTF-8 bytes of the texts that are scored at once.
ROWS, CHUNK = 64, 1 << 18
RIDGE = 1e-3
#: Share of the held-back texts' median margin that a text needs, held-back texts that a median is taken of at least, and the number of n-grams below which no less is asked for.
SHARE, LEAST_HELD, LEAST_GRAMS = 0.4, 8, 16


def _letters() -> np.ndarray:
    """Lower case of each code point where it is a letter, else 0."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


class Spectrum:
    """Texts to presences of n-grams."""

    def __init__(self, alphabet: list[int]):
        #: 0: no letter, 1: another letter, from 2 on: the alphabet, whose letters beyond the symbols share them
        lower = _letters()
        rank = np.zeros(0x110000, np.uint8)
        rank[lower > 0] = 1
        place = np.zeros(0x110000, np.uint8)
        own, shared = alphabet[: SYMBOLS - 2], np.array(alphabet[SYMBOLS - 2 :], np.int64)
        place[own] = np.arange(2, 2 + len(own), dtype=np.uint8)
        place[shared] = 2 + shared % (SYMBOLS - 2)
        known = place[lower]
        self.symbol = np.where(known > 0, known, rank).astype(np.uint8)

    def passages(self, texts: list[str], size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts, the passage of each, and the text and the length of each passage; a text without symbols has none."""
        joined = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        owner = np.repeat(np.arange(len(texts)), sizes)
        s = self.symbol[joined]
        keep = np.ones(len(s), bool)  # one symbol for a run of characters that are no letters
        keep[1:] = (s[1:] > 0) | (s[:-1] > 0) | (owner[1:] != owner[:-1])
        s, owner = s[keep].astype(np.int32), owner[keep]
        n = np.bincount(owner, minlength=len(texts))
        many = np.where(n > 0, np.maximum(1, n // size), 0)
        first = np.cumsum(many) - many
        at = np.arange(len(s)) - (np.cumsum(n) - n)[owner]
        passage = first[owner] + at * many[owner] // np.maximum(n, 1)[owner]
        return s, passage, np.repeat(np.arange(len(texts)), many), np.bincount(passage, minlength=int(many.sum()))

    def presences(self, s: np.ndarray, passage: np.ndarray, first: int, rows: int) -> np.ndarray:
        """A row of n-gram presences for each of ``rows`` passages from ``first`` on."""
        a, b = np.searchsorted(passage, [first, first + rows])
        s, owner = s[a:b], passage[a:b] - first
        seen = np.zeros((rows, GRAMS), bool)
        flat, base = seen.ravel(), owner * GRAMS
        flat[base + s] = True
        if len(s) > 1:
            two = s[:-1] * SYMBOLS + s[1:]
            flat[(base[:-1] + (SYMBOLS + two))[owner[1:] == owner[:-1]]] = True
            if len(s) > 2:
                three = two[:-1] * SYMBOLS + s[2:]
                flat[(base[:-2] + (SYMBOLS + SYMBOLS**2 + three))[owner[2:] == owner[:-2]]] = True
        return seen


class LanguageModel:
    """Landmarks' n-grams and the coefficients of each language."""

    def __init__(self, langs: list[str], alphabet: list[int], grams: np.ndarray, landmarks: np.ndarray, norms: np.ndarray, weights: np.ndarray):
        self.langs, self.alphabet = langs, alphabet
        self.grams, self.packed, self.norms, self.weights = grams, landmarks, norms, weights
        self._spectrum = self._marks = None

    def __getstate__(self):
        return self.__dict__ | {"_spectrum": None, "_marks": None}

    def kernel(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Kernel values of each passage against the landmarks, its text, its length, and whether a text has a letter."""
        k, _, text, length, letters = self._compare(texts)
        return k, text, length, letters

    def _compare(self, texts: list[str], size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``kernel``, with each passage's number of n-grams behind its kernel values."""
        if self._spectrum is None:
            self._spectrum = Spectrum(self.alphabet)
            self._marks = np.unpackbits(self.packed, axis=0, count=len(self.grams)).astype(np.float32)
        s, passage, text, length = self._spectrum.passages(texts, size)
        out, grams = np.empty((len(text), len(self.norms)), np.float32), np.empty(len(text), np.float32)
        for a in range(0, len(text), ROWS):
            seen = self._spectrum.presences(s, passage, a, min(ROWS, len(text) - a))
            own = np.array([np.count_nonzero(row) for row in seen], np.float32)
            common = seen[:, self.grams].astype(np.float32) @ self._marks
            out[a : a + ROWS] = common / np.sqrt(np.maximum(own, 1))[:, None] / self.norms
            grams[a : a + ROWS] = own
        letters = np.bincount(text[passage], s > 0, len(texts)) > 0
        return out, grams, text, length, letters

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score from 0 to 1; a value of the regression of -1 is 0, one of 1 is 1."""
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        k, text, length, letters = self.kernel(texts)
        f = k @ self.weights
        total = np.maximum(np.bincount(text, length, len(texts)), 1)
        mean = np.stack([np.bincount(text, length * f[:, j], len(texts)) / total for j in range(len(self.langs))], 1)
        best = mean.argmax(1)
        value = np.where(letters, np.clip((mean[np.arange(len(texts)), best] + 1) / 2, 0, 1), 0.0)
        return [self.langs[b] if x else UNKNOWN for b, x in zip(best.tolist(), letters.tolist(), strict=True)], value.tolist()

    def margins(self, texts: list[str], size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Margin and number of n-grams of each text, means over its passages by length, and whether it has a letter.

        The margin of a passage is the best language's value less the second's, or the value itself where one language is learned.
        """
        k, grams, text, length, letters = self._compare(texts, size)
        f = np.sort(k @ self.weights, axis=1)
        margin = f[:, -1] - (f[:, -2] if f.shape[1] > 1 else 0)
        total = np.maximum(np.bincount(text, length, len(texts)), 1)
        return np.bincount(text, length * margin, len(texts)) / total, np.bincount(text, length * grams, len(texts)) / total, letters


class Known:
    """A model, and the least margin of texts in its languages by the doublings of their number of n-grams, for passages and for short ones."""

    def __init__(self, model: LanguageModel, least: dict[int, np.ndarray]):
        self.model, self.least = model, least

    def accepts(self, texts: list[str]) -> list[bool]:
        out = np.zeros(len(texts), bool)
        left = np.arange(len(texts) if self.model.langs else 0)
        for size, least in self.least.items():
            if len(left):
                margin, grams, letters = self.model.margins([texts[i] for i in left], size)
                out[left] = letters & (margin >= least[_doublings(grams)])
                left = left[letters & ~out[left]]
        return out.tolist()


def _doublings(grams: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(grams, 1)).astype(int)


def _least(margin: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Least margins by doublings.

    Where a number of n-grams has too few texts, the next longer ones' is taken, over the root of two, as kernel
    values grow with the root of the number of n-grams; from ``LEAST_GRAMS`` down it stays, or a letter would do.
    """
    top = _doublings(np.array([GRAMS]))[0]
    known = [d for d in range(top + 1) if np.count_nonzero(place == d) >= LEAST_HELD]
    least = np.full(top + 1, -np.inf)
    for d in range(top, -1, -1) if known else ():
        if d in known or d > known[-1]:
            least[d] = SHARE * np.median(margin[place == min(d, known[-1])])
        else:
            least[d] = least[d + 1] / (2**0.5 if 2**d >= LEAST_GRAMS else 1)
    return least


def calibrated(texts: list[str], langs: list[str]) -> Known:
    """A model of all the texts, and least margins from what models of either half of them say of the other half's beginnings.

    Equal texts are of one half. With too few texts for any median, only texts without a letter are rejected.
    """
    half = np.array([zlib.crc32(t.encode()) & 1 for t in texts], int)
    found = {size: ([], []) for size in (PASSAGE, SHORT)}
    for h in (0, 1):
        rest, own = np.flatnonzero(half != h), np.flatnonzero(half == h)
        if len(rest) and len(own):
            model = fit([texts[i] for i in rest], [langs[i] for i in rest])
            for size, (margin, place) in found.items():
                m, grams, letters = model.margins([texts[i][: 4 * PASSAGE] for i in own], size)
                margin.extend(m[letters])
                place.extend(_doublings(grams[letters]))
    return Known(fit(texts, langs), {size: _least(np.array(m), np.array(p, int)) for size, (m, p) in found.items()})


def fit(texts: list[str], langs: list[str], landmarks: int = LANDMARKS) -> LanguageModel:
    """Fit on labelled texts held by the driver; each language has at most ``landmarks``, and all together ``ALL_LANDMARKS``, but one at least."""
    known = sorted(set(langs))
    landmarks = min(landmarks, max(1, ALL_LANDMARKS // max(1, len(known))))
    if not known:
        return LanguageModel([], [], np.zeros(0, np.int64), np.zeros((0, 0), np.uint8), np.ones(0, np.float32), np.zeros((0, 0)))
    lower = _letters()
    freq = np.zeros(0x110000, np.int64)
    for t in texts:
        c = lower[np.frombuffer(t.encode("utf-32-le"), np.uint32)]
        freq += np.bincount(c[c > 0], minlength=len(freq))
    alphabet = [int(c) for c in np.argsort(-freq, kind="stable")[: np.count_nonzero(freq)]]
    spectrum = Spectrum(alphabet)
    s, passage, text, _ = spectrum.passages(texts)
    # the first passages of each text are learned from, and the middle one of a language's first texts is a landmark
    rank = np.arange(len(text)) - np.searchsorted(text, text)
    count = np.bincount(text, minlength=len(texts))
    place = {g: k for k, g in enumerate(known)}
    label = np.array([place[langs[i]] for i in text], int)
    chosen = np.concatenate([np.flatnonzero((label == g) & (rank == count[text] // 2))[:landmarks] for g in range(len(known))])
    marks = np.concatenate([spectrum.presences(s, passage, int(i), 1) for i in chosen])
    grams = np.flatnonzero(marks.any(0))
    norms = np.sqrt(np.maximum(marks.sum(1), 1)).astype(np.float32)
    model = LanguageModel(known, alphabet, grams, np.packbits(marks[:, grams].T, axis=0), norms, np.zeros((len(chosen), len(known))))
    k_all = model.kernel(texts)[0].astype(float)
    use = rank < PER_TEXT
    k_nm, k_mm, label = k_all[use], k_all[chosen], label[use]
    y = np.where(label[:, None] == np.arange(len(known))[None], 1.0, -1.0)
    # each language weighs as much as the others together
    w = 1 / np.bincount(label, minlength=len(known))[label]
    normal = k_nm.T @ (w[:, None] * k_nm) + RIDGE * k_mm + 1e-9 * np.eye(len(chosen))
    model.weights = np.linalg.lstsq(normal, k_nm.T @ (w[:, None] * y), rcond=None)[0]
    return model


def sample(labelled: DataFrame, per_lang: int = SAMPLE, most: int = SAMPLE_BYTES) -> tuple[list[str], list[str]]:
    """The ``per_lang`` texts of each language whose hash of id and text is least; fewer where they have over ``most`` bytes.

    Where there are many languages, each has its share of ``ALL_TEXTS`` and ``ALL_BYTES``, one text at least.
    ``labelled`` has ``doc_id, text, lang``. The languages' numbers of ids come first; a share of each language's rows,
    enough for half as many texts again, is then taken where it is read. A row counts once however often it is repeated.
    The rows taken are a small table, of which the driver first gets hashes and lengths, and then the texts it learns from.
    """
    labelled = labelled.filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    ids = F.approx_count_distinct("doc_id") + F.count_if(F.col("doc_id").isNull())
    found = labelled.groupBy("lang").agg(ids.alias("n")).collect()  # one row a language
    if not found:
        return [], []
    per_lang, most = min(per_lang, max(1, ALL_TEXTS // len(found))), min(most, max(1, ALL_BYTES // len(found)))
    share = {r["lang"]: min(1.0, 1.5 * per_lang / max(1, r["n"])) for r in found}
    h = fraction(F.xxhash64(F.lit("langid"), F.col("doc_id"), F.col("text")))
    # one row a language
    wanted = F.broadcast(labelled.sparkSession.createDataFrame(list(share.items()), "lang string, share double"))
    rows = labelled.select("doc_id", "text", "lang").withColumn("h", h).join(wanted, "lang").filter(F.col("h") < F.col("share"))
    rows = stored(rows.groupBy("lang", "h").agg(F.min(F.struct("doc_id", "text")).alias("x")).select("lang", "h", "x.*"), "languages", rows=2 * per_lang * len(share))
    return taken(rows, "lang", per_lang, most)[:2]


def fraction(h):
    """A 64-bit hash as a number from 0 to 1, in steps of 2 ** -53."""
    return F.shiftrightunsigned(h, 11) / float(1 << 53)


def taken(rows: DataFrame, column: str, bound: int, most: int) -> tuple[list[str], list, list]:
    """Texts of the ``bound`` least ``h`` of each value of ``column``, up to the one that brings them to ``most`` bytes, with the values and ids."""
    seen, last = {}, {}
    for r in sorted(rows.select(column, "h", F.octet_length("text").alias("n")).collect(), key=lambda r: r["h"]):
        many, size = seen.get(r[column], (0, 0))
        if many < bound and size < most:
            seen[r[column]], last[r[column]] = (many + 1, size + r["n"]), r["h"]
    cut = rows.sparkSession.createDataFrame(list(last.items()), f"`{column}` {dict(rows.dtypes)[column]}, last double")
    got = rows.join(F.broadcast(cut), column).filter(F.col("h") <= F.col("last")).collect()
    got.sort(key=lambda r: (r[column], r["doc_id"] is None, r["doc_id"], r["text"]))
    return [r["text"] for r in got], [r[column] for r in got], [r["doc_id"] for r in got]


def score(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, lang_pred, score`` of every text, and the columns named in ``keep`` as they are."""
    spark = docs.sparkSession
    prepare(spark)
    cols = [F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    docs = docs.select(*cols, *[F.col(c).alias(f"kept_{c}") for c in keep])
    shared = spark.sparkContext.broadcast(model)  # landmarks by n-grams, one bit each: a few MB, GRAMS * landmarks bits at most
    names = ["doc_id", *[f"kept_{c}" for c in keep]]

    def run(batches):
        model = shared.value
        for batch in batches:
            for a, b in chunks(batch, "text", CHUNK):
                lang, value = model.predict(texts_of(batch, "text", a, b))
                own = [batch.column(c).slice(a, b - a) for c in names]
                yield pa.RecordBatch.from_arrays([*own, pa.array(lang, pa.string()), pa.array(value, pa.float64())], names=[*names, "lang_pred", "score"])

    kinds = dict(docs.dtypes)
    out = docs.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", lang_pred string, score double")
    return out.select("doc_id", *[F.col(f"kept_{c}").alias(c) for c in keep], "lang_pred", "score")


def remainder(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def train(spark: SparkSession, sf_dir: str) -> LanguageModel:
    """Fit on ``documents`` outside the held-out third."""
    return fit(*sample(table(spark, sf_dir, "documents").filter(remainder(3) != 1)))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = score(docs, train(spark, sf_dir))
    return found.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
