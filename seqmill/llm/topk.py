"""Operator 7: exact top-k inner products by norm-bucketed retrieval.

Vectors are scaled to integers. Candidates are put into buckets by length
(quantiles of the lengths) and packed into blocks of bounded size where they
are read. A bounded seed of the longest vectors gives each query a lower bound
of its k-th score. In a block, that bound over the query's and the longest
candidate's lengths is the query's local cosine threshold: above one, no
candidate can reach it and the block is skipped; if it is high, candidates are
pruned by the interval that the query's largest coordinates leave; if it is
low, by their length. What is left is verified by exact products, and a
window keeps the best k.

Queries travel in blocks to every group of candidate blocks, by a join on the
group; nothing that grows with the data is broadcast.

Defined results: vectors that are null or hold a null or a non-finite component
take no part; vectors of different lengths are compared as if padded with
zeros; a candidate row with the query's id is the query's own; repeated
candidate rows count each; of repeated query rows the smallest vector asks;
ties go to the smaller id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import out_batch, prepare, table

#: Buckets by length, rows of a candidate block, of a query block and of the seed.
BUCKETS, BLOCK, QUERIES, SEED = 16, 2048, 1024, 2048
#: Groups of candidate blocks, as many as a query block is sent to: so many at least, and one for so many full blocks.
GROUPS, PER_GROUP = 48, 16
#: Local cosine threshold from which coordinates prune, and coordinates that are looked at.
COSINE, FOCUS = 0.35, 3
#: Products of a magnitude up to this are exact in doubles.
EXACT = float(1 << 53)


def scaled(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", factor: int = 1024) -> DataFrame:
    """``vec_id, v array<long>, n2``: floor(factor * x) of each component and the squared length."""
    x = F.col(vec_col)
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.filter(F.col("x").isNotNull() & F.col("vec_id").isNotNull() & whole)
    rows = rows.select("vec_id", F.transform("x", lambda c: F.floor(F.lit(float(factor)) * c.cast("double"))).alias("v"))
    return rows.withColumn("n2", F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))


def matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None] < sizes[:, None]] = flat
    return out


def _alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, w - m.shape[1]))) if m.shape[1] < w else m for m in (a, b))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    a, b = _alike(a, b)
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def floor_scores(ids: np.ndarray, q: np.ndarray, seed_ids: np.ndarray, seed: np.ndarray, k: int) -> np.ndarray:
    """A lower bound of each query's k-th score: its k-th best among the seed; -inf where the seed is too small."""
    out = np.full(len(ids), -np.inf)
    if len(seed_ids) > k:
        s = products(q, seed).astype(float)
        s[ids[:, None] == seed_ids[None]] = -np.inf
        out = np.partition(s, len(seed_ids) - k, axis=1)[:, len(seed_ids) - k]
    return out


def search_block(ids: np.ndarray, q: np.ndarray, theta: np.ndarray, cand_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query positions, candidate ids and scores of what a block adds: each query's best k that reach its bound."""
    q, c = _alike(q, c)
    length_q, length_c = np.sqrt((q.astype(float) ** 2).sum(1)), np.sqrt((c.astype(float) ** 2).sum(1))
    slack = 1 - 1e-9
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(theta > 0, theta * slack / (length_q * length_c.max(initial=0)), -1.0)
    alive = np.flatnonzero(~(local > 1))
    near = alive[local[alive] >= COSINE]
    far = alive[local[alive] < COSINE]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(near):  # coordinates
        t = local[near]
        unit_q, unit_c = q[near] / length_q[near, None], c / np.maximum(length_c, 1e-300)[:, None]
        left = np.ones((len(near), len(c)), bool)
        focus = np.argsort(-np.abs(unit_q), axis=1)[:, :FOCUS]
        for f in range(focus.shape[1]):
            at = unit_q[np.arange(len(near)), focus[:, f]]
            width = np.sqrt(np.maximum(0, 1 - at**2) * np.maximum(0, 1 - t**2)) + 1e-9
            value = unit_c.T[focus[:, f]]
            # a cosine of at least t leaves this coordinate no more room; above it only where the cosine of the axis itself is lower
            low = np.where(at >= -t, at * t - width, -1.0)
            high = np.where(at <= t, at * t + width, 1.0)
            left &= (value >= low[:, None]) & (value <= high[:, None])
        left &= length_c[None] * length_q[near, None] >= theta[near, None] * slack
        a, b = np.nonzero(left)
        if len(a) > 0.2 * left.size:
            s = products(q[near], c)[a, b]
        else:
            s = np.concatenate([np.zeros(0, np.int64), *((q[near[a[i : i + 65536]]] * c[b[i : i + 65536]]).sum(1) for i in range(0, len(a), 65536))])
        found.append((near[a], b, s))
    if len(far):  # lengths: block rows are sorted, longest first
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(theta[far] > 0, theta[far] * slack / length_q[far], 0.0)
        last = int((length_c >= need.min()).sum())
        s = products(q[far], c[:last])
        a, b = np.nonzero((s >= theta[far, None]) & (length_c[None, :last] >= need[:, None]))
        found.append((far[a], b, s[a, b]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    a, b, s = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = (s >= theta[a]) & (ids[a] != cand_ids[b])
    a, b, s = a[keep], cand_ids[b[keep]], s[keep]
    order = np.lexsort((b, -s, a))
    a, b, s = a[order], b[order], s[order]
    first = np.searchsorted(a, a, side="left")
    best = np.arange(len(a)) - first < k
    return a[best], b[best], s[best]


def _packed(ids: np.ndarray, m: np.ndarray) -> tuple[bytes, bytes, int]:
    small = np.abs(m).max(initial=0) < 1 << 31
    return ids.astype("<i8").tobytes(), m.astype("<i4" if small else "<i8").tobytes(), m.shape[1] * (1 if small else -1)


def _unpacked(ids: bytes, raw: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, "<i8")
    return i, np.frombuffer(raw, "<i4" if width >= 0 else "<i8").astype(np.int64).reshape(len(i), abs(width))


def _pack_candidates(edges: np.ndarray, groups: int):
    """Blocks of one bucket each, longest rows first; a task holds a block's rows of each bucket at most."""
    schema = pa.schema([("grp", pa.int32()), ("ids", pa.binary()), ("raw", pa.binary()), ("width", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def block(bucket: int):
            nonlocal made
            parts = waiting.pop(bucket)
            width = max(p[1].shape[1] for p in parts)
            ids, n2 = np.concatenate([p[0] for p in parts]), np.concatenate([p[2] for p in parts])
            m = np.concatenate([np.pad(p[1], ((0, 0), (0, width - p[1].shape[1]))) for p in parts])
            order = np.lexsort((ids, -n2))
            for a in range(0, len(order), BLOCK):
                made += 1
                yield out_batch(schema, [[x] for x in (zlib.crc32(b"%d %d" % (part, made)) % groups, *_packed(ids[order[a : a + BLOCK]], m[order[a : a + BLOCK]]))])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, m, n2 = batch.column("vec_id").to_numpy(), matrix(batch.column("v")), batch.column("n2").to_numpy()
            bucket = np.searchsorted(edges, n2)
            for x in np.unique(bucket).tolist():
                own = bucket == x
                waiting.setdefault(x, []).append((ids[own], m[own], n2[own]))
                if sum(len(p[0]) for p in waiting[x]) >= BLOCK:
                    yield from block(x)
        for x in sorted(waiting):
            yield from block(x)

    return run


def _pack_queries(seed_ids: np.ndarray, seed: np.ndarray, k: int):
    schema = pa.schema([("q_ids", pa.binary()), ("q_raw", pa.binary()), ("q_width", pa.int32()), ("theta", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for a in range(0, batch.num_rows, QUERIES):
                part = batch.slice(a, QUERIES)
                ids, m = part.column("vec_id").to_numpy(), matrix(part.column("v"))
                yield out_batch(schema, [[x] for x in (*_packed(ids, m), floor_scores(ids, m, seed_ids, seed, k).tobytes())])

    return run


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                ids, q = _unpacked(row["q_ids"], row["q_raw"], row["q_width"])
                cand, c = _unpacked(row["ids"], row["raw"], row["width"])
                a, b, s = search_block(ids, q, np.frombuffer(row["theta"]), cand, c, k)
                if len(a):
                    yield out_batch(schema, [pa.array(ids[a]), pa.array(b), pa.array(s)])

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the best k; both sides as ``scaled`` gives them."""
    spark = queries.sparkSession
    prepare(spark)
    seed = candidates.orderBy(F.desc("n2"), "vec_id").limit(SEED).collect()  # SEED rows at most
    seed_ids = np.array([r["vec_id"] for r in seed], np.int64)
    width = max((len(r["v"]) for r in seed), default=0)
    seed_m = np.array([list(r["v"]) + [0] * (width - len(r["v"])) for r in seed], np.int64).reshape(len(seed), width)
    cuts = [i / BUCKETS for i in range(1, BUCKETS)]
    cuts, rows = candidates.agg(F.percentile_approx("n2", cuts, 1000), F.count(F.lit(1))).first()
    edges = np.unique(np.array(cuts or [], float))
    groups = max(GROUPS, -(-rows // (BLOCK * PER_GROUP)))
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    n = asked.count()
    blocks = candidates.mapInArrow(_pack_candidates(edges, groups), "grp int, ids binary, raw binary, width int")
    asked = asked.repartition(max(1, -(-n // QUERIES))).mapInArrow(_pack_queries(seed_ids, seed_m, k), "q_ids binary, q_raw binary, q_width int, theta binary")
    asked = asked.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = asked.join(blocks, "grp").select("q_ids", "q_raw", "q_width", "theta", "ids", "raw", "width").mapInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scaled(table(spark, sf_dir, "embeddings"))
    return top_k(rows.filter(F.col("vec_id") % 100 == 0), rows)


SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
