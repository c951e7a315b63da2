"""Random access to FASTA and FASTQ files: an index of byte ranges, and reads of only those ranges.

The index is a table, to be stored as Parquet beside the files:

    file, first_rec     the file, and the number of the first record of a range
    last_rec            the number of its last record
    offset, stop        bytes of the file that have all of these records
    skip                bytes, after decompression, before the first of them
    packed, fastq       whether the file is compressed, and which format it has

Plain files are indexed in splits, a range for each ``every`` records. Compressed
files are indexed member by member, as block compression writes them; each member
decompresses by itself, so a range begins where a member does and no decoder's
state has to be kept. A compressed file of one member is one range: ``blocked``
writes reads as files of small members.

Tasks read their ranges by ``pyarrow.fs``, so files have to be in a store that it
knows; any other is read whole by ``fastx.read_fastx``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.session import importable
from .fastx import FASTQ, SCHEMA, fasta_text, fastq_text

INDEX = "file string, first_rec long, last_rec long, offset long, stop long, skip long, packed boolean, fastq boolean"
#: Records of a range of a plain file, and of a member that ``blocked`` writes.
EVERY = 1000
#: Compressed bytes that are read at once, and records of a bucket that ranges are joined by.
READ, BUCKET = 1 << 20, 4096
#: Names of FASTQ files, or of folders that Spark wrote one to; and of compressed files.
_FASTQ, _PACKED = FASTQ, r"\.gz$"


def _open(file: str):
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(file)
    return store.open_input_file(path)


def build(spark: SparkSession, paths: str | list[str], every: int = EVERY) -> DataFrame:
    """The index of all files."""
    importable(spark)
    paths = paths if isinstance(paths, list) else [paths]
    files = spark.read.format("binaryFile").load(paths).select("path", "length").filter("length > 0")
    return _plain(spark, paths, every).unionByName(_members(files.filter(F.col("path").rlike(_PACKED))))


def _plain(spark: SparkSession, paths: list[str], every: int) -> DataFrame:
    """Ranges of plain files: lines' bytes are added up inside splits, and splits' sums before them."""
    lines = spark.read.text(paths, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"), "value").filter(~F.col("file").rlike(_PACKED))
    lines = lines.select("file", "block", "size", "at", (F.octet_length("value") + 1).alias("bytes"), F.col("value").startswith(">").alias("head"), F.col("file").rlike(_FASTQ).alias("fastq"), (F.length("value") > 0).alias("full"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = lines.groupBy("file", "block").agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"), F.count_if("head").alias("h"))
    base = own.select("file", "block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"base_{c}") for c in "bnh"])  # one row a split
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    at = lines.withColumns({"b": F.sum("bytes").over(inside), "n": F.count(F.lit(1)).over(inside), "h": F.count_if("head").over(inside)}).join(base, ["file", "block"])
    line = F.col("base_n") + F.col("n") - 1
    starts = F.when(F.col("fastq"), (line % 4 == 0) & F.col("full")).otherwise(F.col("head"))
    rec = F.when(F.col("fastq"), F.floor(line / 4) + 1).otherwise(F.col("base_h") + F.col("h"))
    records = at.filter(starts).select("file", "size", "fastq", rec.alias("rec"), (F.col("base_b") + F.col("b") - F.col("bytes")).alias("offset"))
    # a range ends where the next begins, and the last with the file
    per = records.groupBy("file", "size", "fastq", F.floor((F.col("rec") - 1) / every).alias("k")).agg(F.min("rec").alias("first_rec"), F.max("rec").alias("last_rec"), F.min("offset").alias("offset"))
    follow = per.select("file", (F.col("k") - 1).alias("k"), F.col("offset").alias("stop"))
    out = per.join(follow, ["file", "k"], "left")
    return out.select("file", "first_rec", "last_rec", "offset", F.coalesce("stop", "size").alias("stop"), F.lit(0).cast("long").alias("skip"), F.lit(False).alias("packed"), "fastq")


class _Starts:
    """Where records start in a file that goes by in pieces: numbers of lines or of headers, and bytes since a mark."""

    def __init__(self, fastq: bool):
        self.fastq, self.line, self.rec, self.fresh = fastq, 0, 0, True

    def first(self, piece: bytes) -> int | None:
        """Goes on over a piece; the position of the first record that starts in it. ``rec`` counts the records so far."""
        at, found = 0, None
        while at < len(piece):
            if self.fresh:
                head = piece[at : at + 1]
                if (self.line % 4 == 0 and head != b"\n") if self.fastq else head == b">":
                    self.rec += 1
                    found = at if found is None else found
                self.fresh = False
            end = piece.find(b"\n", at)
            if end < 0:
                break
            self.line, self.fresh, at = self.line + 1, True, end + 1
        return found


def _members(files: DataFrame) -> DataFrame:
    """Ranges of compressed files, each streamed by one task, as compression has it."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for file in pdf.path:
                rows, seen, fastq = [], _Starts(bool(re.search(_FASTQ, file))), bool(re.search(_FASTQ, file))
                source, left, offset = _open(file), b"", 0
                while True:
                    # one member, whose text is looked at piece by piece
                    inflate, size, first, number, begin = zlib.decompressobj(31), 0, None, 0, offset
                    while not inflate.eof:
                        data = left or source.read(READ)
                        left = b""
                        if not data:
                            break
                        text = inflate.decompress(data)
                        offset += len(data) - len(inflate.unused_data)
                        before = seen.rec
                        at = seen.first(text)
                        if at is not None and first is None:
                            first, number = size + at, before + 1
                        size += len(text)
                    left = inflate.unused_data
                    if first is not None:
                        rows.append([file, number, seen.rec, begin, offset, first])
                    if not inflate.eof or not left and not (left := source.read(READ)):
                        break
                # a range's last record ends in the member that the next one begins in
                for a, b in zip(rows, rows[1:], strict=False):
                    a[4] = b[4]
                if rows:
                    rows[-1][4] = offset
                yield pd.DataFrame([[*r, True, fastq] for r in rows], columns=["file", "first_rec", "last_rec", "offset", "stop", "skip", "packed", "fastq"])

    return files.select("path").repartition("path").mapInPandas(run, INDEX)


def ranges(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The index's rows that have the records ``file, rec_idx``, each once, with the ``need``ed records."""
    bucket = lambda c: F.floor(F.col(c) / BUCKET)
    cut = index.withColumn("bucket", F.explode(F.sequence(bucket("first_rec"), bucket("last_rec"))))
    ask = wanted.select("file", "rec_idx").distinct().withColumn("bucket", bucket("rec_idx"))
    met = ask.join(cut, ["file", "bucket"]).filter(F.col("rec_idx").between(F.col("first_rec"), F.col("last_rec")))
    return met.groupBy(*index.columns).agg(F.sort_array(F.collect_list("rec_idx")).alias("need"))


def located(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """``req_pos, file, rec_idx`` of ``wanted(req_pos, of_all)``: numbers of records of all files, in order of their names, as one."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = index.groupBy("file").agg(F.max("last_rec").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    cut = files.withColumn("bucket", F.explode(F.sequence(F.floor((F.col("base") + 1) / BUCKET), F.floor((F.col("base") + F.col("n")) / BUCKET))))
    met = wanted.withColumn("bucket", F.floor(F.col("of_all") / BUCKET)).join(cut, "bucket").filter((F.col("of_all") > F.col("base")) & (F.col("of_all") <= F.col("base") + F.col("n")))
    return met.select("req_pos", "file", (F.col("of_all") - F.col("base")).alias("rec_idx"))


def _records(text: bytes, fastq: bool) -> Iterator[tuple[str, str, str | None]]:
    """Header, sequence and scores of each record of whole lines."""
    lines = text.decode("utf-8", "replace").split("\n")
    if fastq:
        for k in range(0, len(lines) - 1, 4):
            if not lines[k]:
                return
            yield lines[k][1:], lines[k + 1], lines[k + 3] if k + 3 < len(lines) else ""
        return
    head, parts = None, []
    for x in lines:
        if x.startswith(">"):
            if head is not None:
                yield head, "".join(parts), None
            head, parts = x[1:], []
        elif head is not None:
            parts.append(x.strip(" "))
    if head is not None:
        yield head, "".join(parts), None


def read(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """``req_pos`` and the record of each ``wanted(req_pos, file, rec_idx)``, repeats and all; only ranges that have one are read."""
    importable(index.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                with _open(r.file) as source:
                    data = source.read_at(int(r.stop - r.offset), int(r.offset))
                if r.packed:
                    text = b""
                    while data:
                        inflate = zlib.decompressobj(31)
                        text += inflate.decompress(data)
                        data = inflate.unused_data
                else:
                    text = data
                need = set(r.need.tolist())
                for k, (head, seq, qual) in enumerate(_records(text[r.skip :], r.fastq), int(r.first_rec)):
                    if k > r.last_rec:
                        break
                    if k in need:
                        name = re.match(r"\S*", head)[0]
                        rows.append((r.file, k, name, head[len(name) + 1 :], seq, qual))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in SCHEMA.split(", ")])

    # ranges are dealt evenly, however they lie in the files
    found = ranges(index, wanted).repartition("file", "offset").mapInPandas(run, SCHEMA)
    return wanted.select("req_pos", "file", "rec_idx").join(found, ["file", "rec_idx"]).select("req_pos", *found.columns)


def blocked(reads: DataFrame, path: str, fastq: bool = True, every: int = EVERY, order: str = "rec_idx") -> str:
    """Reads in order as a folder of compressed files of one member for each ``every`` records; the path.

    A file is written by Spark's text writer, which compresses it as one member.
    """
    text = (fastq_text() if fastq else fasta_text()).alias("value")
    out = reads.select(text, order).repartitionByRange(order).sortWithinPartitions(order)
    out.select("value").write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", every).text(path)
    return path
