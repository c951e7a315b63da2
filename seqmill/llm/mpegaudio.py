"""Operator 6: media columns in MPEG audio frames.

Writing: a payload is stored losslessly in a variable-bitrate MPEG-1 layer III
stream: an ID3v2 tag that holds the payload's unpadded size, a first frame
with a Xing table (frames, bytes and a seek table of 100 entries), and data
frames with checksums. Each data frame's side information says that no main
data is to be decoded, so players hear silence, and the bytes after it, which
the format leaves free, are the payload: one or two slots of 576 bytes by the
frame's bitrate.

Reading knows nothing of the writer: it skips ID3v2 tags, looks for a frame
header that another header or the stream's end follows, reads frames from
there, looks again wherever a header is broken, verifies checksums, parses
Xing, Info and VBRI tables, stops at an ID3v1 tag, and returns exact durations
(samples over rate) and each frame's offset.

Defined results: null texts are empty; a payload has at least one slot; equal
texts have equal streams; texts are stored whole; repeated rows are stored
once each.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import chunks, out_batch, prepare, table, texts_of

#: Fixed values of the format: kbit/s by index for version 1 and for versions 2 and 2.5, by layer; Hz by version.
BITRATES = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {1: (44100, 48000, 32000), 2: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}

SLOT = 576


def _crc_table() -> list[int]:
    out = []
    for b in range(256):
        c = b << 8
        for _ in range(8):
            c = (c << 1 ^ 0x8005 if c & 0x8000 else c << 1) & 0xFFFF
        out.append(c)
    return out


_CRC = _crc_table()
_CRC_SEEN: dict[bytes, int] = {}


def crc16(data: bytes) -> int:
    """The frame checksum: polynomial 0x8005 from 0xFFFF. Side information repeats, so results are remembered."""
    found = _CRC_SEEN.get(data)
    if found is None:
        found = 0xFFFF
        for b in data:
            found = (found << 8 & 0xFFFF) ^ _CRC[found >> 8 ^ b]
        if len(_CRC_SEEN) < 4096:
            _CRC_SEEN[data] = found
    return found


@dataclass(frozen=True)
class Header:
    version: float
    layer: int
    checked: bool
    bitrate: int
    rate: int
    mono: bool
    size: int
    samples: int

    @property
    def side(self) -> int:
        """Bytes of side information of layer III; the other layers have none that is checked whole here."""
        if self.layer != 3:
            return 0
        return (17 if self.mono else 32) if self.version == 1 else (9 if self.mono else 17)


_HEADERS: dict[int, Header | None] = {}


def header(word: int) -> Header | None:
    """The header of four bytes, or None."""
    if word not in _HEADERS:
        if len(_HEADERS) > 4096:
            _HEADERS.clear()
        _HEADERS[word] = _header(word)
    return _HEADERS[word]


def _header(w: int) -> Header | None:
    if w >> 21 != 0x7FF:
        return None
    version = {0: 2.5, 2: 2, 3: 1}.get(w >> 19 & 3)
    layer = 4 - (w >> 17 & 3)
    at, hz = w >> 12 & 15, w >> 10 & 3
    if version is None or layer == 4 or at in (0, 15) or hz == 3 or w & 3 == 2:
        return None
    kbit = BITRATES[1 if version == 1 else 2, layer][at]
    rate = RATES[version][hz]
    pad = w >> 9 & 1
    if layer == 1:
        samples, size = 384, (12 * kbit * 1000 // rate + pad) * 4
    else:
        samples = 1152 if layer == 2 or version == 1 else 576
        size = samples // 8 * kbit * 1000 // rate + pad
    return Header(version, layer, not w >> 16 & 1, kbit, rate, w >> 6 & 3 == 3, size, samples)


@dataclass
class Stream:
    """What reading found."""

    tags: dict[str, str] = field(default_factory=dict)
    vbr: str | None = None
    vbr_frames: int | None = None
    vbr_bytes: int | None = None
    toc: list[int] = field(default_factory=list)
    offsets: list[int] = field(default_factory=list)
    headers: list[Header] = field(default_factory=list)
    checked: int = 0
    bad: int = 0
    resyncs: int = 0
    skipped: int = 0

    @property
    def samples(self) -> int:
        return sum(h.samples for h in self.headers)

    @property
    def duration(self) -> tuple[int, int]:
        """Seconds as an exact fraction; (0, 1) without frames."""
        num, den = 0, 1
        for rate in {h.rate for h in self.headers}:
            n = sum(h.samples for h in self.headers if h.rate == rate)
            num, den = num * rate + n * den, den * rate
            g = gcd(num, den)
            num, den = num // g, den // g
        return num, den

    def seek(self, sample: int) -> int:
        """Offset of the frame that holds a sample."""
        ends = np.cumsum([h.samples for h in self.headers])
        return self.offsets[int(np.searchsorted(ends, sample, side="right"))]


def _syncsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _tags(data: bytes, at: int, out: dict[str, str]) -> int:
    """Read an ID3v2 tag at ``at``; the place after it."""
    if data[at : at + 3] != b"ID3" or len(data) < at + 10:
        return at
    version, size = data[at + 3], _syncsafe(data[at + 6 : at + 10])
    end = min(len(data), at + 10 + size)
    p = at + 10
    while p + 10 <= end and data[p : p + 4].strip(b"\0"):
        name = data[p : p + 4].decode("latin-1")
        n = _syncsafe(data[p + 4 : p + 8]) if version >= 4 else int.from_bytes(data[p + 4 : p + 8])
        body = data[p + 10 : min(end, p + 10 + n)]
        if name.startswith("T") and body:
            text = body[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1"), "replace")
            key, _, value = text.partition("\0") if name == "TXXX" else (name, "", text)
            out[key] = value.rstrip("\0")
        p += 10 + n
    return end


def read(data: bytes) -> Stream:
    """Frames, tags and tables of a stream, damaged or not."""
    out = Stream()
    at, end = _tags(data, 0, out.tags), len(data)
    if data[-128:-125] == b"TAG":
        end -= 128
        out.tags.setdefault("TIT2", data[-125:-95].rstrip(b"\0 ").decode("latin-1"))
    unpack = struct.Struct(">I").unpack_from
    lost = True
    while at + 4 <= end:
        h = header(unpack(data, at)[0])
        whole = h is not None and at + h.size <= end
        if whole and lost:  # a header alone may be chance; another one, or the end, must follow
            after = at + h.size
            whole = after == end or after + 4 <= end and (x := header(unpack(data, after)[0])) is not None and (x.version, x.layer, x.rate) == (h.version, h.layer, h.rate)
        if not whole:
            k = data.find(b"\xff", at + 1, end)
            if not lost:
                out.resyncs += 1
                lost = True
            out.skipped += (k if k >= 0 else end) - at
            at = k if k >= 0 else end
            continue
        lost = False
        side = at + 4 + 2 * h.checked
        if h.checked and h.layer == 3:
            out.checked += 1
            out.bad += crc16(data[at + 2 : at + 4] + data[side : side + h.side]) != int.from_bytes(data[at + 4 : at + 6])
        if not out.offsets and not out.vbr and _table(data, at, side + h.side, h, out):
            at += h.size
            continue
        out.offsets.append(at)
        out.headers.append(h)
        at += h.size
    return out


def _table(data: bytes, frame: int, at: int, h: Header, out: Stream) -> bool:
    """A frame that holds a table of the stream instead of sound."""
    name = data[at : at + 4]
    if name in (b"Xing", b"Info"):
        out.vbr = name.decode()
        flags, p = int.from_bytes(data[at + 4 : at + 8]), at + 8
        if flags & 1:
            out.vbr_frames, p = int.from_bytes(data[p : p + 4]), p + 4
        if flags & 2:
            out.vbr_bytes, p = int.from_bytes(data[p : p + 4]), p + 4
        if flags & 4:
            out.toc = list(data[p : p + 100])
        return True
    p = frame + 36  # this table's place is fixed
    if data[p : p + 4] == b"VBRI" and p + 26 <= frame + h.size:
        out.vbr = "VBRI"
        out.vbr_bytes, out.vbr_frames, n, scale, width = struct.unpack_from(">IIHHH", data, p + 10)
        steps = [int.from_bytes(data[p + 26 + i * width : p + 26 + (i + 1) * width]) * scale for i in range(n)]
        out.toc = np.cumsum(steps).tolist()
        return True
    return False


def _word(kbit: int) -> int:
    """Version 1, layer III, checked, 32 kHz, mono."""
    return 0xFFFA0000 | BITRATES[1, 3].index(kbit) << 12 | 2 << 10 | 3 << 6


#: At 32 kHz a frame has 4.5 bytes a kbit/s: 720 bytes hold one slot, 1440 two.
ONE, TWO = 160, 320
_SIDE = bytes(17)


def _frame(kbit: int) -> np.ndarray:
    word = _word(kbit).to_bytes(4)
    out = np.zeros(header(_word(kbit)).size, np.uint8)
    out[:23] = np.frombuffer(word + crc16(word[2:] + _SIDE).to_bytes(2) + _SIDE, np.uint8)
    return out


_HEAD = 23


def payload_of(text: str) -> tuple[int, bytes]:
    """UTF-8 bytes and their number before padding with 255 to a positive multiple of a slot."""
    raw = text.encode("utf-8")
    return len(raw), raw + b"\xff" * (max(1, -(-len(raw) // SLOT)) * SLOT - len(raw))


def write(payload: bytes, n_bytes: int) -> bytes:
    """A stream that holds the payload: pairs of slots, then a single one."""
    slots = np.frombuffer(payload, np.uint8).reshape(-1, SLOT)
    pairs = len(slots) // 2
    two = np.tile(_frame(TWO), (pairs, 1))
    two[:, _HEAD : _HEAD + 2 * SLOT] = slots[: 2 * pairs].reshape(pairs, 2 * SLOT)
    sound = two.tobytes()
    if len(slots) % 2:
        one = _frame(ONE)
        one[_HEAD : _HEAD + SLOT] = slots[-1]
        sound += one.tobytes()
    first = bytearray(_frame(ONE).tobytes())
    frames, size = pairs + len(slots) % 2, len(first) + len(sound)
    ends = len(first) + np.minimum(np.arange(100) * frames // 100 * 1440, len(sound))
    first[_HEAD : _HEAD + 116] = b"Xing" + struct.pack(">III", 7, frames, size) + (ends * 256 // size).astype(np.uint8).tobytes()
    text = b"\x03bytes\0%d" % n_bytes
    tag = b"TXXX" + _safe(len(text)) + b"\0\0" + text
    return b"ID3\x04\0\0" + _safe(len(tag)) + tag + bytes(first) + sound


def _safe(n: int) -> bytes:
    return bytes((n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127))


def payload_from(data: bytes, stream: Stream) -> bytes:
    """The payload of a stream that ``write`` made, from the frames that reading found."""
    out = bytearray()
    for at, h in zip(stream.offsets, stream.headers, strict=True):
        side = at + 4 + 2 * h.checked + h.side
        out += data[side : side + (2 * SLOT if h.bitrate == TWO else SLOT)]
    return bytes(out)


def feature(stream: Stream) -> str:
    """Exact duration, frames, table, checksums and a digest of the seek offsets, in one string."""
    num, den = stream.duration
    seek = zlib.crc32(np.array(stream.offsets, "<u8").tobytes())
    return f"seconds={num}/{den};frames={len(stream.offsets)};vbr={stream.vbr};table_frames={stream.vbr_frames};crc_ok={stream.checked - stream.bad}/{stream.checked};resyncs={stream.resyncs};seek_crc32={seek:08x}"


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, media binary``: every text as a stream."""
    prepare(docs.sparkSession)
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("media", pa.binary())])

    def run(batches):
        for batch in batches:
            for a, b in chunks(batch, "text"):
                media = [write(p, n) for n, p in map(payload_of, texts_of(batch, "text", a, b))]
                yield out_batch(schema, (batch.column("doc_id").slice(a, b - a), media))

    return docs.mapInArrow(run, "doc_id long, media binary")


_FEATURES = "doc_id long, seconds double, samples long, rate int, frames long, vbr string, checksums long, bad_checksums long, resyncs long, tags map<string,string>, seek_offsets array<long>"


def media_features(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Durations, tables, checksums and frame offsets of streams in a binary column; a null or frameless one has no frames and no rate."""
    prepare(media.sparkSession)
    media = media.select(media[id_col].cast("long").alias("doc_id"), media[media_col].alias("media"))
    kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.list_(pa.int64()))
    schema = pa.schema(list(zip([x.split()[0] for x in _FEATURES.split(", ")], kinds, strict=True)))

    def run(batches):
        for batch in batches:
            for a, b in chunks(batch, "media"):
                rows = []
                for doc, data in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), batch.column("media").slice(a, b - a).to_pylist(), strict=True):
                    s = read(data or b"")
                    num, den = s.duration
                    rows.append((doc, num / den, s.samples, s.headers[0].rate if s.headers else None, len(s.offsets), s.vbr, s.checked, s.bad, s.resyncs, list(s.tags.items()), s.offsets))
                yield out_batch(schema, map(list, zip(*rows, strict=True)))

    return media.mapInArrow(run, _FEATURES)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as a stream, read the stored bytes back, and digest what was read."""
    prepare(docs.sparkSession)
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string()}
    schema = pa.schema(list(kinds.items()))

    def run(batches):
        sha = hashlib.sha256
        for batch in batches:
            for a, b in chunks(batch, "text"):
                rows = []
                for doc, text in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), texts_of(batch, "text", a, b), strict=True):
                    n, payload = payload_of(text)
                    data = write(payload, n)
                    stream = read(data)
                    back = payload_from(data, stream)
                    rows.append((doc, int(stream.tags["bytes"]), len(back), sha(back).hexdigest(), zlib.crc32(back[-32:]), len(data), sha(data).hexdigest(), feature(stream)))
                yield out_batch(schema, map(list, zip(*rows, strict=True)))

    return docs.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
