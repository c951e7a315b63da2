"""Shared plumbing of the corpus operators: tables, scratch tables, Arrow batches."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])

#: Rows and bytes of a batch that goes to Python, and rows that are read at once; texts are long, so batches are short. One row may have more bytes.
BATCH_ROWS, BATCH_BYTES, READ_ROWS = 2000, 4 << 20, 512
#: UTF-8 bytes that a vectorised kernel works on at once.
CHUNK_BYTES = 1 << 19


def prepare(spark: SparkSession) -> None:
    """Let workers import this package, and keep batches of whole texts small."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH")]))
    env.setdefault("OMP_NUM_THREADS", "1")
    env.setdefault("OPENBLAS_NUM_THREADS", "1")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session has none, a local master gets a temporary folder and any
    other master a folder under the warehouse, which is shared as well.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        made = "file://" + tempfile.mkdtemp(prefix="seqmill-")
    else:
        made = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_seqmill_scratch"
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the session may be gone at exit
        pass


#: The folder of the operator that runs, for tables that only it needs.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``stored`` inside go at the end, but for those to be kept."""
    path = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    token = _SCRATCH.set(path)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        _drop(spark, path)


#: Files of a small table at least, and rows a task from which it has more.
FILES, FILE_ROWS = 8, 250_000


def stored(df: DataFrame, name: str, keep: bool = False, rows: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    ``rows`` is the number of narrow rows that its last stage reads: where they
    are few, few tasks write them, as each file costs more than its rows.

    This cuts the lineage: lost executors cost no recomputation, and what a
    task numbered stays as it was numbered. Inside ``scratch`` the table goes
    with it unless it is to be kept; else when it is discarded or Python exits.
    """
    spark = df.sparkSession
    inside = None if keep else _SCRATCH.get()
    path = f"{inside or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(FILES, -(-rows // FILE_ROWS)))
    df.write.parquet(path)
    if not inside:
        atexit.register(_drop, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored = path
    return out


#: Bytes of a table that a task reads at least, and tasks that it is read by in any case.
SPLIT_BYTES, TASKS = 16 << 20, 24


def merged(df: DataFrame) -> DataFrame:
    """``df`` with small splits read together: a task for each ``SPLIT_BYTES`` of its files, ``TASKS`` at least.

    Whatever the splits of a session are, a table is then written as few files; each file costs the executor more than
    its rows do where tasks are tiny.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.coalesce(min(1 << 20, max(TASKS, -(-size // SPLIT_BYTES))))


def discard(df: DataFrame) -> None:
    """Drop a stored table that nothing reads any more; any other DataFrame stays as it is."""
    if path := getattr(df, "_stored", None):
        _drop(df.sparkSession, path)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` whose texts have about ``limit`` bytes; one long text is a range of its own."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def texts_of(batch: pa.RecordBatch, column: str, start: int, stop: int) -> list[str]:
    """Texts of a row range, null as empty."""
    return [x or "" for x in batch.column(column).slice(start, stop - start).to_pylist()]


def out_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def filtered(docs: DataFrame, text_col: str, keep, shared=None) -> DataFrame:
    """Rows of ``docs``, all columns as they are, whose text ``keep(shared value, texts)`` says yes to."""
    prepare(docs.sparkSession)

    def run(batches):
        value = shared.value if shared is not None else None
        for batch in batches:
            at = batch.schema.names.index(text_col)
            for a, b in chunks(batch, text_col):
                part = batch.slice(a, b - a)
                texts = [x or "" for x in part.column(at).to_pylist()]
                yield part.filter(pa.array(keep(value, texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
