"""Operator 11: token ids in files of 64-bit words, Simple-8b.

A word's top four bits are a selector, which says how many ids of how many bits
its other sixty hold: from sixty of one bit to one of sixty. The selector 0 is an
escape: the word after it is one id as it is, which has more than sixty bits. A
document's ids are packed greedily, each word as full as the ids that follow
allow, in blocks of ``BLOCK`` ids that begin with a word of their own; the number
of words before each block is stored, so that all blocks are decoded at once, a
selector at a time, and any range of ids is read without what is before it.

Files are Parquet, written and read by Spark, a row for each document:

    shard, nth          the file's number in ascending order of ids, and the row's number in it
    doc_id              as in the input
    first, n_ids        ids before the document in its shard, and its own, the closing id included
    block               ids of a block
    words               64-bit words, little-endian
    offsets             32-bit numbers, little-endian: words before each block

Shards are ranges of document ids between quantiles, as many as the texts' bytes
ask for, so documents are tokenised and moved once, packed. Inside a shard rows
are sorted, and numbered as they stream through. What is before a shard follows
from the shards' sums, one row each.

Defined results: a null or empty text is the closing id alone; rows without an id
come last, dealt to shards of their own by a digest of their ids; rows of one id
are ordered by that digest and lie in one shard, which streams; repeated rows are
written once each; an empty table gives files without rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vocab
from .common import chunks, out_batch, prepare, shared_dir, table, texts_of
from .packing import CHUNK, CLOSING_ID, LibraryIds

#: Ids of a word and their bits, by selector from 1 on; fixed values of the format.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = len(COUNTS)
#: Ids of a block.
BLOCK = 1024
#: Bytes of texts that make a shard, and shards at most, beyond which they grow.
SHARD_BYTES, SHARDS = 32 << 20, 10_000
SCHEMA = "shard int, nth long, doc_id long, first long, n_ids long, block int, words binary, offsets binary"

_COUNT = np.array([*COUNTS, 1], np.int64)
_LIMITS = np.array([1 << w for w in WIDTHS], np.uint64)


def packed(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks, and the first word of each block; ``ends`` are the blocks' ends among the ids, no block is empty."""
    ids, n = ids.astype(np.uint64), len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kind = np.searchsorted(_LIMITS, ids, side="right")  # the narrowest selector that has room for the id
    begins = np.concatenate([[0], ends[:-1]])
    end = np.repeat(ends, ends - begins)
    choice = np.full(n, ESCAPE, np.int8)
    for c in range(ESCAPE - 1, -1, -1):
        at = np.flatnonzero(kind <= c)
        if not len(at):
            break
        last = np.flatnonzero(np.append(np.diff(at) != 1, True))
        stop = np.repeat(at[last] + 1, np.diff(last, prepend=-1))  # where the run of ids that fit ends
        choice[at[np.minimum(at + COUNTS[c], end[at]) <= stop]] = c
    after = np.minimum(np.arange(n) + _COUNT[choice], end)
    # all blocks are walked side by side
    seen, at, own = np.zeros(n, bool), begins, ends
    while len(at):
        seen[at] = True
        at = after[at]
        more = at < own
        at, own = at[more], own[more]
    heads = np.flatnonzero(seen)
    size = 1 + (choice[heads] == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for c in range(ESCAPE):
        i = np.flatnonzero(choice[heads] == c)
        if len(i):
            j = heads[i][:, None] + np.arange(COUNTS[c])
            own = np.where(j < after[heads[i]][:, None], ids[np.minimum(j, n - 1)], np.uint64(0))
            shift = np.arange(COUNTS[c], dtype=np.uint64) * np.uint64(WIDTHS[c])
            words[place[i]] = np.bitwise_or.reduce(own << shift, axis=1) | np.uint64(c + 1) << np.uint64(60)
    raw = np.flatnonzero(choice[heads] == ESCAPE)
    words[place[raw] + 1] = ids[heads[raw]]
    return words, place[np.searchsorted(heads, begins)]


def unpacked(words: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ids of blocks of ``sizes`` ids, whose words begin at ``firsts`` and follow each other."""
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    if not len(out):
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    escape = np.flatnonzero(selector == 0)
    count = np.concatenate([[1], _COUNT[:ESCAPE], [0]])[np.minimum(selector, ESCAPE + 1)]
    count[escape + 1] = 0  # an id as it is
    block = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(words))))
    before = np.cumsum(count) - count
    at = before - before[firsts][block] + (ends - sizes)[block]
    end = ends[block]
    out[at[escape]] = words[escape + 1]
    selector[escape + 1] = ESCAPE + 1
    for c in range(ESCAPE):
        i = np.flatnonzero(selector == c + 1)
        if len(i):
            shift = np.arange(COUNTS[c], dtype=np.uint64) * np.uint64(WIDTHS[c])
            own = words[i][:, None] >> shift & np.uint64((1 << WIDTHS[c]) - 1)
            j = at[i][:, None] + np.arange(COUNTS[c])
            real = j < end[i][:, None]
            out[j[real]] = own[real]
    return out


def encode(texts_ids: list[np.ndarray], block: int = BLOCK) -> list[tuple[bytes, bytes]]:
    """Words and offsets of each document's ids, of which there are some."""
    sizes = np.array([len(x) for x in texts_ids], np.int64)
    many = -(-sizes // block)
    doc = np.repeat(np.arange(len(sizes)), many)
    nth = np.arange(len(doc)) - (np.cumsum(many) - many)[doc]
    starts = np.cumsum(sizes) - sizes
    ends = starts[doc] + np.minimum((nth + 1) * block, sizes[doc])
    words, firsts = packed(np.concatenate(texts_ids), ends)
    head = np.append(firsts[nth == 0], len(words))
    out, raw = [], words.astype("<u8").tobytes()
    bounds = np.append(np.cumsum(many) - many, len(doc))
    for i in range(len(sizes)):
        offsets = firsts[bounds[i] : bounds[i + 1]] - head[i]
        out.append((raw[8 * head[i] : 8 * head[i + 1]], offsets.astype("<u4").tobytes()))
    return out


def decode(words: list[bytes], offsets: list[bytes], sizes: list[int], block: int = BLOCK) -> list[np.ndarray]:
    """Ids of documents."""
    if not words:
        return []
    every = np.frombuffer(b"".join(words), "<u8")
    begin = np.cumsum([0, *[len(w) // 8 for w in words]])
    each = [np.frombuffer(x, "<u4").astype(np.int64) + b for x, b in zip(offsets, begin.tolist(), strict=False)]
    own = [np.minimum(block, n - block * np.arange(len(x))) for n, x in zip(sizes, each, strict=True)]
    return np.split(unpacked(every, np.concatenate(each), np.concatenate(own)), np.cumsum(sizes)[:-1])


def part_of(words: bytes, offsets: bytes, size: int, start: int, stop: int, block: int = BLOCK) -> np.ndarray:
    """Ids from ``start`` to ``stop`` of one document: only the words of the blocks that they lie in are looked at."""
    start, stop = max(0, start), min(stop, size)
    if start >= stop:
        return np.zeros(0, np.uint64)
    a, b = start // block, -(-stop // block)
    at = np.frombuffer(offsets, "<u4").astype(np.int64)
    end = at[b] if b < len(at) else len(words) // 8
    own = np.frombuffer(words, "<u8", int(end - at[a]), int(8 * at[a]))
    ids = unpacked(own, at[a:b] - at[a], np.minimum(block, size - block * np.arange(a, b)))
    return ids[start - a * block : stop - a * block]


_OPEN: dict[str, LibraryIds] = {}


def _ranges(docs: DataFrame) -> tuple[list[int], int]:
    """Upper ends of the shards' ranges of ids, and the number of further shards for rows without an id."""
    size = F.octet_length("text") + F.lit(64)
    r = docs.agg(F.sum(F.when(F.col("doc_id").isNotNull(), size)).alias("own"), F.sum(F.when(F.col("doc_id").isNull(), size)).alias("none")).first()
    shards = min(SHARDS, -(-(r["own"] or 0) // SHARD_BYTES))
    bounds = []
    if shards > 1:
        bounds = docs.agg(F.percentile_approx("doc_id", [k / shards for k in range(1, shards)], 100 * shards)).first()[0]
    return sorted(set(bounds)), min(SHARDS, -(-(r["none"] or 0) // SHARD_BYTES))


def write(docs: DataFrame, path: str, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Tokenise, close each document, pack and write as files in ascending order of ids; the path."""
    prepare(docs.sparkSession)
    vocabulary, ranges = vocabulary or vocab.default_path("word_bpe_49k.json"), vocab.library_ranges()
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    bounds, loose = _ranges(docs)
    upper = np.array(bounds, np.int64)
    names = {"shard": pa.int32(), "doc_id": pa.int64(), "tie": pa.int64(), "n_ids": pa.int64(), "words": pa.binary(), "offsets": pa.binary()}
    schema = pa.schema(list(names.items()))

    def tokenised(batches):
        if vocabulary not in _OPEN:
            _OPEN[vocabulary] = LibraryIds(vocabulary, ranges)
        closing = np.array([CLOSING_ID], np.uint32)
        for batch in batches:
            for a, b in chunks(batch, "text", CHUNK):
                doc = batch.column("doc_id").slice(a, b - a)
                ids = [np.concatenate([x.astype(np.uint32), closing]) for x in _OPEN[vocabulary].encode(texts_of(batch, "text", a, b))]
                tie = [int.from_bytes(hashlib.blake2b(x.astype("<u4").tobytes(), digest_size=8).digest(), "little") >> 1 for x in ids]
                shard = np.searchsorted(upper, doc.fill_null(0).to_numpy(), side="left")
                null = np.flatnonzero(doc.is_null().to_numpy(zero_copy_only=False))
                shard[null] = [len(upper) + 1 + (tie[i] * loose >> 63) for i in null.tolist()]
                yield out_batch(schema, [pa.array(shard.astype(np.int32)), doc, tie, [len(x) for x in ids], *map(list, zip(*encode(ids), strict=True))])

    rows = docs.mapInArrow(tokenised, "shard int, doc_id long, tie long, n_ids long, words binary, offsets binary")
    rows = rows.repartitionById(len(bounds) + 1 + loose, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_last(), "tie")
    # sums run on from batch to batch of a partition
    numbers = pa.schema([("shard", pa.int32()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("block", pa.int32()), ("words", pa.binary()), ("offsets", pa.binary())])

    def laid(batches):
        nth = first = 0
        for batch in batches:
            n = batch.num_rows
            if n:
                own = batch.column("n_ids").to_numpy()
                at = first + np.cumsum(own)
                yield out_batch(numbers, [batch.column("shard"), pa.array(np.arange(nth, nth + n)), batch.column("doc_id"), pa.array(at - own), batch.column("n_ids"), pa.array(np.full(n, BLOCK, np.int32)), batch.column("words"), batch.column("offsets")])
                nth, first = nth + n, int(at[-1])

    rows.mapInArrow(laid, SCHEMA).write.parquet(path)
    return path


def opened(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files, with ``start``: the ids before each document in all files."""
    prepare(spark)
    rows = spark.read.schema(SCHEMA).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    base = rows.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(base), "shard").withColumn("start", F.col("base") + F.col("first")).drop("base")  # 2 * SHARDS rows at most


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids array<long>`` of every document in the files."""
    return _decoded(opened(spark, path), "ids array<long>", pa.list_(pa.int64()), lambda x: x.astype(np.int64))


def _decoded(rows: DataFrame, column: str, kind: pa.DataType, of) -> DataFrame:
    """``doc_id, start, n_ids`` and a column made of each document's decoded ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64()), (column.split()[0], kind)])

    def run(batches):
        for batch in batches:
            for a, b in chunks(batch, "words"):
                doc, start, words, offsets = (batch.column(c).slice(a, b - a) for c in ("doc_id", "start", "words", "offsets"))
                block = batch.column("block")[a].as_py()
                ids = decode(words.to_pylist(), offsets.to_pylist(), batch.column("n_ids").slice(a, b - a).to_pylist(), block)
                yield out_batch(schema, [doc, start, [len(x) for x in ids], [of(x) for x in ids]])

    return rows.select("doc_id", "start", "n_ids", "block", "words", "offsets").mapInArrow(run, f"doc_id long, start long, n_ids long, {column}")


def window(spark: SparkSession, path: str, start: int, length: int) -> DataFrame:
    """``doc_id, start, ids``: the ids from ``start`` on among those of all files, document by document."""
    stop = start + length
    rows = opened(spark, path).filter((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int64()))])
    names = ("doc_id", "start", "n_ids", "block", "words", "offsets")

    def run(batches):
        for batch in batches:
            out = []
            for doc, at, n, block, words, offsets in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                out.append((doc, max(at, start), part_of(words, offsets, n, start - at, stop - at, block).astype(np.int64)))
            if out:
                yield out_batch(schema, map(list, zip(*out, strict=True)))

    return rows.select(*names).mapInArrow(run, "doc_id long, start long, ids array<long>")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write(table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}")
    found = _decoded(opened(spark, path), "ids_crc32 long", pa.int64(), lambda x: zlib.crc32(x.astype("<u4").tobytes()))
    return found.select("doc_id", "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")
