"""Taxonomic assignment with a multinomial model of k-mers, smoothed along the taxonomy.

A taxon's k-mer probabilities are its references' counts with ``smooth`` counts
more, dealt as its parent's probabilities are; the root's parent deals evenly. So a
leaf with one reference leans on its genus, and a genus of one on its family. A
query's likelihood at a leaf is the product over its k-mers; leaves' shares of the
references, one more each, are the prior, and posteriors of leaves add up to those
of the taxa above them.

Counts are grouped sums over taxa and k-mers. Queries and leaves are dealt to tiles
that meet in pairs, each a product of two matrices; of each tile only leaves near
the best go on, those within ``NATS``, beside which the others are nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import checkpointed
from ..functions.taxa import DEFAULT
from .taxonomy import path_probabilities

#: Likelihoods that are smaller than the best by more than so much, as logarithms, count for nothing.
NATS = 40.0
#: Leaves and queries of a tile.
LEAVES, QUERIES = 2048, 2048


#: K-mers of a text that are looked at together, so that a long text takes no more memory.
WINDOW = 1 << 16
_VALUE = np.full(256, -1, np.int64)
_VALUE[[ord(c) for c in "ACGT"]] = range(4)


def _counts(seq: str, k: int) -> np.ndarray:
    """How often the upper-case sequence has each k-mer of A, C, G and T."""
    v = _VALUE[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)]
    out = np.zeros(4**k, np.int64)
    for at in range(0, len(v) - k + 1, WINDOW):
        part = v[at : at + WINDOW + k - 1]
        n = len(part) - k + 1
        code, whole = np.zeros(n, np.int64), np.ones(n, bool)
        for j in range(k):
            code = 4 * code + part[j : j + n]
            whole &= part[j : j + n] >= 0
        out += np.bincount(code[whole], minlength=4**k)
    return out


def fit(refs: DataFrame, k: int = 5, smooth: float = 64.0) -> DataFrame:
    """``path, n, logs array<double>``: for each leaf its references and the logarithms of its k-mers' probabilities.

    ``refs`` are ``seq, path``, taxa from the root to the leaf with commas between them. K-mers with other letters than
    A, C, G and T, in either case, are left out; references without a path or sequence too.
    """
    if not 0 < k <= 7 or smooth <= 0:
        raise ValueError("k is from 1 to 7, and smooth is positive")
    wide = 4**k
    refs = refs.select(F.upper("seq").alias("seq"), "path").filter("seq is not null and path is not null")

    def counted(batches):
        import pandas as pd

        for pdf in batches:
            # one row of counts for each leaf of a batch of texts
            for path, seqs in pdf.groupby("path", sort=False).seq:
                c = sum(_counts(s, k) for s in seqs)
                yield pd.DataFrame({"path": path, "kmer": np.flatnonzero(c), "c": c[c > 0]})

    counts = checkpointed(refs.select("path", "seq").mapInPandas(counted, "path string, kmer int, c long").groupBy("path", "kmer").agg(F.sum("c").alias("c")))
    leaves = checkpointed(refs.groupBy("path").agg(F.count(F.lit(1)).alias("n")).withColumn("taxa", F.split("path", ",")))
    depth = leaves.agg(F.max(F.size("taxa"))).first()[0] or 0
    head = lambda j: F.array_join(F.slice(F.split("path", ","), 1, j), ",") if j else F.lit("")
    above = None
    for j in range(depth + 1):
        # taxa of one depth, with their parents' probabilities
        there = leaves.filter(F.size("taxa") >= j)
        taxa = there.select(head(j).alias("at"), head(max(0, j - 1)).alias("up")).distinct()
        own = counts.filter(F.size(F.split("path", ",")) >= j).groupBy(head(j).alias("at"), "kmer").agg(F.sum("c").alias("c")).groupBy("at").agg(F.collect_list(F.struct("kmer", "c")).alias("own"))
        rows = taxa.join(own, "at", "left")
        rows = rows.join(above.select(F.col("at").alias("up"), F.col("p").alias("of_up")), "up") if above is not None else rows.withColumn("of_up", F.lit(None).cast("array<double>"))

        def smoothed(batches):
            import pandas as pd

            for pdf in batches:
                out = []
                for own, up in zip(pdf.own, pdf.of_up, strict=True):
                    c = np.zeros(wide)
                    for x in own if own is not None else ():
                        c[x["kmer"]] = x["c"]
                    out.append((c + smooth * (np.full(wide, 1 / wide) if up is None else np.asarray(up))) / (c.sum() + smooth))
                yield pd.DataFrame({"at": pdf["at"].astype(object), "p": out})

        own = checkpointed(rows.select("at", "own", "of_up").mapInPandas(smoothed, "at string, p array<double>"))
        above = own
        done = own.join(leaves.filter(F.size("taxa") == j).select(F.col("path").alias("at"), "n"), "at").select(F.col("at").alias("path"), "n", F.transform("p", lambda x: F.ln(x)).alias("logs"))
        every = done if j == 0 else every.unionByName(done)
    return every


def posteriors(query: DataFrame, model: DataFrame, k: int = 5) -> DataFrame:
    """``seq_id, path, prob``: leaves' posterior probabilities, but for those that are nothing beside the best.

    A query without k-mers, null or too short, has no rows.
    """
    total = model.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("leaves"), F.max(F.size("logs")).alias("wide")).first()
    if not total["leaves"]:
        return query.sparkSession.createDataFrame([], f"seq_id {dict(query.dtypes)['seq_id']}, path string, prob double")
    if total["wide"] != 4**k:
        raise ValueError("the model has other k-mers")
    parts = -(-total["leaves"] // LEAVES)
    tiles = max(1, -(-query.count() // QUERIES))
    leaf = model.select(F.pmod(F.xxhash64("path"), F.lit(parts)).cast("int").alias("j"), "path", "logs", F.ln((F.col("n") + 1) / F.lit(float(total["n"] + total["leaves"]))).alias("prior"))
    kind = dict(query.dtypes)["seq_id"]
    left = query.filter("seq is not null").select(F.pmod(F.xxhash64("seq_id"), F.lit(tiles)).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("j"), "seq_id", F.upper("seq").alias("seq"))
    right = leaf.select(F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("i"), "j", "path", "logs", "prior")

    def kernel(key, q, m):
        import pandas as pd

        counts = np.zeros((len(q), 4**k))
        for i, s in enumerate(q.seq):
            counts[i] = _counts(s, k)
        some = np.flatnonzero(counts.any(1))
        if not len(some) or not len(m):
            return pd.DataFrame({"seq_id": q.seq_id.iloc[:0], "path": pd.Series([], dtype=object), "log": pd.Series([], dtype=float)})
        log = counts[some] @ np.stack(m.logs.to_numpy()).T + m.prior.to_numpy()
        i, j = np.nonzero(log >= log.max(1, keepdims=True) - NATS)
        paths = m.path.tolist()
        return pd.DataFrame({"seq_id": q.seq_id.to_numpy()[some[i]], "path": pd.Series([paths[x] for x in j.tolist()], dtype=object), "log": log[i, j]})

    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(kernel, f"seq_id {kind}, path string, log double")
    found = checkpointed(found)
    best = found.groupBy("seq_id").agg(F.max("log").alias("best"))
    near = found.join(best, "seq_id").withColumn("w", F.exp(F.col("log") - F.col("best"))).filter(F.col("log") >= F.col("best") - NATS)
    return near.join(near.groupBy("seq_id").agg(F.sum("w").alias("all")), "seq_id").select("seq_id", "path", (F.col("w") / F.col("all")).alias("prob"))


def predict(query: DataFrame, model: DataFrame, k: int = 5, most: int | None = 20, least: float = 0.01, ranks: tuple[str, ...] = DEFAULT.ranks) -> DataFrame:
    """``seq_id, rank, parent_taxonomy, taxon, prob``: of each query the ``most`` likeliest leaves, added up, from ``least`` on."""
    return path_probabilities(posteriors(query, model, k), ranks, least=least, most=most)
