"""Sequence-abundance tables in long form: (sample, sequence or its index, nread)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dna import revcomp
from ..functions.session import numbered, running_count


def long_table(rows: DataFrame, sample: str = "sample", seq: str = "seq", nread: str = "nread", accept: str | None = None, rc: bool = False) -> DataFrame:
    """Reads by sample and sequence; rows whose ``accept`` isn't true and sums of zero go."""
    rows = rows.filter(F.col(accept)) if accept else rows
    own = revcomp(F.col(seq)) if rc else F.col(seq)
    out = rows.groupBy(F.col(sample).alias("sample"), own.alias("seq")).agg(F.sum(nread).cast("bigint").alias("nread"))
    return out.filter("nread <> 0")


def union_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables of several samples as one, with the samples' names, added up."""
    parts = [t.select(F.lit(k).alias("sample"), "seq", "nread") for k, t in tables.items()]
    return long_table(reduce(DataFrame.unionByName, parts))


def melt(wide: DataFrame, ids: list[str], name: str = "seq_idx", sample: str = "sample") -> DataFrame:
    """A wide table to long form; zeros and nulls go."""
    return wide.unpivot([sample], ids, name, "nread").filter("nread <> 0")


def widen(table: DataFrame, ids: list, id_col: str = "seq_idx", sample: str = "sample") -> DataFrame:
    """A column of reads for each of ``ids``, zero where there are none. For sinks only."""
    out = table.groupBy(sample).pivot(id_col, ids).agg(F.sum("nread"))
    return out.select(sample, *[F.coalesce(F.col(f"`{i}`"), F.lit(0)).cast("bigint").alias(f"s{i}") for i in ids])


def mapped_table(table: DataFrame, seqs: DataFrame) -> DataFrame:
    """Sequences as their index in ``seqs(seq_idx, seq)``: the first of equal ones, null where there is none."""
    index = seqs.groupBy("seq").agg(F.min("seq_idx").alias("seq_idx"))
    return table.join(index, "seq", "left").groupBy("sample", "seq_idx").agg(F.sum("nread").cast("bigint").alias("nread"))


def exact_hits(seqs: DataFrame, id_col: str = "seq_idx", seq: str = "seq") -> DataFrame:
    """(query, hit): every sequence that repeats an earlier one, and the first of its kind."""
    first = seqs.groupBy(seq).agg(F.min(id_col).alias("hit"))
    return seqs.join(first, seq).filter(F.col(id_col) != F.col("hit")).select(F.col(id_col).alias("query"), "hit")


def contained_hits(seqs: DataFrame, k: int = 16, id_col: str = "seq_idx", seq: str = "seq") -> DataFrame:
    """(query, hit): sequences that lie without mismatch in a longer or earlier one; the smallest id of those.

    A sequence is looked for under its own first k-mer among all k-mers of the
    others; sequences shorter than ``k`` have only exact hits.
    """
    rows = seqs.select(F.col(id_col).alias("id"), F.col(seq).alias("s"))
    begins = rows.filter(F.length("s") >= k).select("id", "s", F.substring("s", 1, k).alias("kmer"))
    kmers = rows.filter(F.length("s") >= k).select(
        F.col("id").alias("id2"), F.col("s").alias("s2"), F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("s") - k + 1), lambda i: F.col("s").substr(i, F.lit(k))))).alias("kmer")
    )
    longer = (F.length("s2") > F.length("s")) | ((F.length("s2") == F.length("s")) & (F.col("id2") < F.col("id")))
    found = begins.join(kmers, "kmer").filter(longer & F.contains("s2", "s"))
    return found.groupBy(F.col("id").alias("query")).agg(F.min("id2").alias("hit"))


def _renumbered(rows: DataFrame, hits: DataFrame, id_col: str) -> DataFrame:
    out = running_count(rows, id_col, hits, "query", "_gone")
    return out.withColumn(id_col, F.col(id_col) - F.coalesce("_gone", F.lit(0))).drop("_gone")


def deduplicate(table: DataFrame, hits: DataFrame, nread: str = "nread", samples: tuple[str, ...] = ("sample",), merge: bool = True, id_col: str = "seq_idx") -> DataFrame:
    """Send hits' queries to their hit, add up where ``merge``, and close the gaps in the index.

    One hop: a hit that is a query itself is not followed. Null ids stay null.
    """
    to = hits.groupBy("query").agg(F.min("hit").alias("hit"))
    out = table.join(to, table[id_col] == to["query"], "left").withColumn(id_col, F.coalesce("hit", id_col)).drop("query", "hit")
    if merge:
        keys = [id_col, *samples]
        out = out.groupBy(*keys).agg(F.sum(nread).cast("bigint").alias(nread)) if nread in table.columns else out.select(*keys).distinct()
    return _renumbered(out, hits, id_col)


def deduplicate_ids(ids: DataFrame, hits: DataFrame, id_col: str = "seq_idx", merge: bool = True) -> DataFrame:
    return deduplicate(ids.select(id_col), hits, "", (), merge, id_col)


def deduplicate_seqs(seqs: DataFrame, hits: DataFrame, id_col: str = "seq_idx") -> DataFrame:
    """Sequences that are no query, numbered from 1 in order."""
    kept = seqs.join(hits.select(F.col("query").alias(id_col)).distinct(), id_col, "left_anti")
    return numbered(kept, id_col, name="new_idx")


def collapse(table: DataFrame, hits: DataFrame, id_col: str = "seq_idx") -> tuple[DataFrame, DataFrame]:
    """The deduplicated table, and the map from old to new index."""
    ids = table.select(id_col).distinct()
    to = hits.groupBy(F.col("query").alias(id_col)).agg(F.min("hit").alias("hit"))
    moved = ids.join(to, id_col, "left").select(F.col(id_col).alias("seq_idx_in"), F.coalesce("hit", id_col).alias("seq_idx_out"))
    return deduplicate(table, hits, id_col=id_col), _renumbered(moved, hits, "seq_idx_out")


def sort_order(table: DataFrame, seqs: DataFrame | None = None, id_col: str = "seq_idx", nread: str = "nread") -> DataFrame:
    """Sequences in canonical order, ``position`` from 1: samples, reads and variance falling, hash rising, id last."""
    out = table.groupBy(id_col).agg(F.count(F.lit(1)).alias("prevalence"), F.sum(nread).cast("bigint").alias("abundance"), F.coalesce(F.var_samp(nread), F.lit(0.0)).alias("variance"))
    if seqs is not None:
        out = out.join(seqs.select(id_col, F.md5("seq").alias("hash")), id_col, "left")
    else:
        out = out.withColumn("hash", F.md5(F.col(id_col).cast("string")))
    return numbered(out, F.desc("prevalence"), F.desc("abundance"), F.desc(F.round("variance", 6)), "hash", id_col, name="position")


def select_rows(rows: DataFrame, which: DataFrame, id_col: str = "seq_idx", negate: bool = False) -> DataFrame:
    """Rows whose id is, or with ``negate`` isn't, among ``which``."""
    return rows.join(which.select(id_col).distinct(), id_col, "left_anti" if negate else "left_semi")


def summary(table: DataFrame) -> DataFrame:
    """Reads, sequences and samples of a table."""
    return table.agg(F.sum("nread").cast("bigint").alias("nread"), F.countDistinct("seq_idx").alias("n_seq"), F.countDistinct("sample").alias("n_sample"))


def ensure_row(table: DataFrame) -> DataFrame:
    """The table, or one row of nulls where it is empty."""
    if table.limit(1).count():
        return table
    return table.sparkSession.createDataFrame([tuple(None for _ in table.columns)], table.schema)
