"""Reads, occurrences and clusters by taxon of every rank, and their hierarchy as XML."""

from __future__ import annotations

from collections.abc import Iterator
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.taxa import DEFAULT, strip_number

_WEIGHTS = {"fread": "nread", "focc": "nsample", "fotu": "1"}


def rollup(otus: DataFrame, ranks: tuple[str, ...] = DEFAULT.ranks, unknown: str = "pseudo") -> DataFrame:
    """A row for each rank, taxon and parent path of ``otus(<ranks>, nread, nsample)``.

    ``nread, nocc, notu`` are sums, ``f*`` their shares of the rank,
    ``<rank>_unknown_f*`` the shares of clusters whose taxon of that rank is a
    placeholder, and ``child_unknown_f*`` those of the next rank down. Ranks are
    unpivoted by one explode; sums are made before rows move.
    """
    named = otus
    for r in ranks[-2:]:
        named = named.withColumn(r, strip_number(F.col(r)))
    levels = []
    for i, r in enumerate(ranks):
        parent = F.concat_ws(",", *[F.coalesce(F.col(p), F.lit("NA")) for p in ranks[:i]]) if i else F.lit(None).cast("string")
        levels.append(F.struct(F.lit(r).alias("rank"), F.translate(F.col(r), "_", " ").alias("taxon"), parent.alias("parent_taxonomy")))
    below = ranks[1:]
    is_unknown = {r: F.coalesce(F.col(r).startswith(unknown), F.lit(False)).cast("double") for r in below}
    long = named.select("nread", "nsample", *[x.alias(f"_u_{r}") for r, x in is_unknown.items()], F.explode(F.array(*levels)).alias("l")).select("l.*", "nread", "nsample", *[f"_u_{r}" for r in below])
    weight = {"fread": F.col("nread"), "focc": F.col("nsample"), "fotu": F.lit(1)}
    aggs = [(F.sum(w * F.col(f"_u_{r}")) / F.nullif(F.sum(w).cast("double"), F.lit(0.0))).alias(f"{r}_unknown_{k}") for r in below for k, w in weight.items()]
    out = long.groupBy("rank", "taxon", "parent_taxonomy").agg(*aggs, F.sum("nread").cast("bigint").alias("nread"), F.sum("nsample").cast("bigint").alias("nocc"), F.count(F.lit(1)).alias("notu"))
    for k in weight:
        child = F.when(F.lit(False), F.lit(0.0))
        for r, below_r in zip(ranks, ranks[1:], strict=False):
            child = child.when(F.col("rank") == r, F.col(f"{below_r}_unknown_{k}"))
        out = out.withColumn(f"child_unknown_{k}", child.otherwise(F.col(f"{ranks[-1]}_unknown_{k}")))
    # one row for each rank
    total = out.groupBy("rank").agg(F.sum("nread").alias("_r"), F.sum("nocc").alias("_o"), F.sum("notu").alias("_u"))
    out = out.join(F.broadcast(total), "rank")
    share = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    return out.withColumns({"fread": share("nread", "_r"), "focc": share("nocc", "_o"), "fotu": share("notu", "_u")}).drop("_r", "_o", "_u")


def xml_template(fields: dict[str, str]) -> str:
    """``<k><val>{column}</val></k>`` for each field."""
    return "".join(f"<{k}><val>{{{v}}}</val></{k}>" for k, v in fields.items())


def xml_nodes(data: DataFrame, fields: dict[str, str], ranks: tuple[str, ...] = DEFAULT.ranks, last: str | None = None, root: str | None = None) -> Iterator[str]:
    """Nested nodes, depth first, in order of path, down to the rank ``last``.

    Rows come from a sort by path, a partition at a time, so the hierarchy is
    never held whole. ``root`` restricts to a path and what is under it.
    """
    wanted = ranks[: ranks.index(last) + 1] if last else ranks
    path = F.concat_ws(",", "parent_taxonomy", "taxon")
    rows = data.filter(F.col("rank").isin(list(wanted)) & F.col("taxon").isNotNull()).withColumn("_path", path)
    if root:
        rows = rows.filter((F.col("_path") == root) | F.col("_path").startswith(f"{root},"))
    template, open_ = xml_template(fields), []
    for row in rows.orderBy(F.split("_path", ",")).toLocalIterator():
        depth = row["_path"].count(",")
        while open_ and open_[-1] >= depth:
            yield "</node>\n"
            open_.pop()
        values = {k: escape("" if v is None else str(v)) for k, v in row.asDict().items()}
        yield f"<node name={quoteattr(row['taxon'])}>{template.format(**values)}\n"
        open_.append(depth)
    for _ in open_:
        yield "</node>\n"


def write_xml(data: DataFrame, path: str, fields: dict[str, str], before: str = "", after: str = "", **options) -> str:
    """Write the nodes between two texts; the path."""
    with open(path, "w", encoding="utf-8") as f:
        f.write(before)
        f.writelines(xml_nodes(data, fields, **options))
        f.write(after)
    return path
