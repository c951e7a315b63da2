"""Classifications: header formats, wide and long tables, trees, classifier outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import taxa
from ..functions.session import checkpointed, numbered
from ..functions.taxa import BOLD_RANKS, DEFAULT, SINTAX_RANKS, UNITE_RANKS

#: What every header of a format looks like.
PATTERNS = {
    "sintax": r"^([^;]+;)+tax=([dkpcofgst]:[^,;]*,)*[dkpcofgst]:[^,;]*(;.*)?$",
    "bold": r"^([^|,;]+\|){2,3}([^,;|]*,)*[^,;|]*$",
    "unite": r"^[^|]+\|[kpcofgs]__[^;,]+(;[kpcofgs]__[^;,]+)*\|[^|]+$",
    "bayesant": r"^[^\s;]+\s+Root(?:;[^;]*)+$",
}


def detect_formats(headers: DataFrame, header: str = "header") -> DataFrame:
    """One row with a flag for each format: whether all headers have it. All flags in one pass; null headers don't count."""
    return headers.agg(*[F.coalesce(F.bool_and(F.col(header).rlike(p)), F.lit(True)).alias(f"is_{k}") for k, p in PATTERNS.items()])


def _blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def parse_sintax(headers: DataFrame, header: str = "header") -> DataFrame:
    """``id;...;tax=k:X,p:Y`` to an id and a column for each of nine ranks; of a letter given twice the first counts, and a header of another form has nulls."""
    fields = F.split(header, ";")
    tax = F.try_element_at(F.filter(F.slice(fields, 2, 1 << 20), lambda x: x.startswith("tax=")), F.lit(-1))
    parts = F.split(F.substring(tax, 5, 1 << 20), ",")
    good = F.forall(parts, lambda x: F.substring(x, 2, 1).eqNullSafe(":") & F.substring(x, 1, 1).isin(*SINTAX_RANKS))
    return headers.select(F.get(fields, F.lit(0)).alias("seq_id"), *[F.when(good, _labelled(parts, f"{k}:")).alias(r) for k, r in SINTAX_RANKS.items()])


def _labelled(parts: Column, label: str) -> Column:
    """What follows ``label`` in the first part that begins with it; null where none does."""
    return F.substring(F.get(F.filter(parts, lambda x: x.startswith(label)), F.lit(0)), len(label) + 1, 1 << 20)


def parse_unite(headers: DataFrame, header: str = "header") -> DataFrame:
    """``id|k__X;p__Y|code`` to an id and a column for each of seven ranks; of a letter given twice the first counts, and a header without a bar is an id."""
    fields = F.split(header, r"\|")
    parts = F.split(F.get(fields, F.lit(1)), ";")
    return headers.select(F.get(fields, F.lit(0)).alias("seq_id"), *[F.nullif(_labelled(parts, f"{k}__"), F.lit("")).alias(r) for k, r in UNITE_RANKS.items()])


def parse_bold(headers: DataFrame, header: str = "header") -> DataFrame:
    """``id|...|X,Y,...``: the last field's parts are ten ranks in order; more are dropped."""
    fields = F.split(header, r"\|")
    parts = F.split(F.element_at(fields, -1), ",")
    return headers.select(fields[0].alias("seq_id"), *[_blank(F.get(parts, F.lit(i))).alias(r) for i, r in enumerate(BOLD_RANKS)])


def parse_bayesant(headers: DataFrame, ranks: tuple[str, ...] = DEFAULT.ranks, header: str = "header") -> DataFrame:
    """``id Root;X;Y``: parts after the root are ranks in order."""
    fields = F.split(header, r"\s+", 2)
    parts = F.split(F.get(fields, F.lit(1)), ";")
    rooted = F.get(parts, F.lit(0)) == "Root"
    return headers.select(F.substring_index(F.get(fields, F.lit(0)), ";", 1).alias("seq_id"), *[F.when(rooted, _blank(F.get(parts, F.lit(i + 1)))).alias(r) for i, r in enumerate(ranks)])


def parse_headers(headers: DataFrame, ranks: tuple[str, ...] = DEFAULT.ranks, rank_map: dict[str, str] | None = None, header: str = "header") -> DataFrame | None:
    """Headers of whichever format all of them have, renamed by ``rank_map``, with the wanted ranks that are there; None for no format."""
    found = detect_formats(headers, header).first()
    for name, parse in (("sintax", parse_sintax), ("bold", parse_bold), ("unite", parse_unite), ("bayesant", lambda h, header: parse_bayesant(h, ranks, header))):
        if found[f"is_{name}"]:
            out = parse(headers, header=header)
            for wanted, own in (rank_map or {}).items():
                if own in out.columns:
                    out = out.withColumnRenamed(own, wanted)
            return out.select("seq_id", *[r for r in ranks if r in out.columns])
    return None


def parse_tabular(rows: DataFrame, ranks: tuple[str, ...] = DEFAULT.ranks) -> DataFrame:
    """``seq_id, taxonomy`` with paths split at comma, semicolon or bar; parts beyond the ranks are dropped."""
    parts = F.split("taxonomy", "[,;|]")
    return rows.select("seq_id", *[_blank(F.get(parts, F.lit(i))).alias(r) for i, r in enumerate(ranks)])


def wide_to_long(taxonomy: DataFrame, probability: DataFrame, ranks: tuple[str, ...] = DEFAULT.ranks, id_col: str = "seq_id") -> DataFrame:
    """``seq_id, rank, parent_taxonomy, taxon, prob``; the parent is not known here and null."""
    t = taxonomy.unpivot([id_col], list(ranks), "rank", "taxon")
    p = probability.unpivot([id_col], list(ranks), "rank", "prob")
    return t.join(p, [id_col, "rank"], "full").select(id_col, "rank", F.lit(None).cast("string").alias("parent_taxonomy"), "taxon", "prob")


def _levels(paths: DataFrame) -> list[int]:
    return [r[0] for r in paths.select("rank").distinct().orderBy("rank").collect()]  # one for each rank


def tree(paths: DataFrame, col: str = "classification", top: tuple[float, ...] = (0.99, 0.01), leaves: float = 0.99) -> DataFrame:
    """``taxon_id, parent_id, rank, classification, prior`` of comma paths.

    Ids are consecutive by rank and path, the root is 0. Leaves of the deepest
    rank share ``leaves`` equally, inner taxa have their children's sum, and
    the first rank has ``top`` in order of path, nothing beyond that.
    """
    names = paths.select(F.col(col).alias("classification")).distinct().filter("classification is not null and classification <> 'root'")
    rank = F.regexp_count("classification", F.lit(",")) + 1
    rows = checkpointed(names.select("classification", rank.alias("rank"), F.coalesce(taxa.parent_of(F.col("classification")), F.lit("root")).alias("parent")))
    depth = rows.agg(F.max("rank")).first()[0] or 0
    n = rows.filter(F.col("rank") == depth).count()
    prior: DataFrame | None = None
    parts = []
    for r in range(depth, 0, -1):
        level = rows.filter(F.col("rank") == r)
        if r == 1:
            place = numbered(level, "classification", name="_k")
            level = place.withColumn("prior", F.get(F.array(*[F.lit(x) for x in top]), (F.col("_k") - 1).cast("int"))).drop("_k")
        elif prior is None:
            level = level.withColumn("prior", F.lit(leaves / n))
        else:
            level = level.join(prior, level.classification == prior["_p"], "left").drop("_p")
        prior = level.groupBy(F.col("parent").alias("_p")).agg(F.sum("prior").alias("prior"))
        parts.append(level.select("classification", "rank", "parent", "prior"))
    if not parts:
        return paths.sparkSession.createDataFrame([(0, 0, 0, "root", 1.0)], "taxon_id bigint, parent_id bigint, rank int, classification string, prior double")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return _with_ids(every)


def _with_ids(every: DataFrame, last: str | None = None) -> DataFrame:
    late = (F.col("rank") == 1) & (F.col("classification") == last) if last else F.lit(False)
    placed = numbered(every.withColumn("_late", late), "rank", "_late", "classification", name="taxon_id").drop("_late")
    ids = placed.select(F.col("classification").alias("_p"), F.col("taxon_id").alias("_id"))
    out = placed.join(ids, placed.parent == ids["_p"], "left").select("taxon_id", F.coalesce("_id", F.lit(0)).cast("bigint").alias("parent_id"), F.col("rank").cast("int").alias("rank"), "classification", "prior")
    root = every.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("taxon_id"), F.lit(0).cast("bigint").alias("parent_id"), F.lit(0).alias("rank"), F.lit("root").alias("classification"), F.lit(1.0).alias("prior"))
    return root.unionByName(out)


def tree_by_leaves(paths: DataFrame, col: str = "classification", outgroup: str = "nonFungi") -> DataFrame:
    """As ``tree``, but each taxon's prior is shared among its children by their numbers of leaves.

    A path that another path goes on from is no leaf. ``outgroup`` is last of the first rank.
    """
    names = paths.select(F.col(col).alias("c")).distinct().filter("c is not null and c <> 'root'")
    inner = names.select(taxa.parent_of(F.col("c")).alias("c")).filter("c is not null").distinct()
    leaves = names.join(inner, "c", "left_anti")
    parts = F.split("c", ",")
    steps = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(k.alias("rank"), F.array_join(F.slice(parts, F.lit(1), k), ",").alias("classification")))
    every = leaves.select(F.explode(steps).alias("s")).groupBy("s.rank", "s.classification").agg(F.count(F.lit(1)).alias("n"))
    every = checkpointed(every.withColumn("parent", F.coalesce(taxa.parent_of(F.col("classification")), F.lit("root"))))
    # the shares along a path multiply to leaves here over leaves in all
    total = every.filter("rank = 1").agg(F.sum("n")).first()[0] or 1
    return _with_ids(every.select("classification", "rank", "parent", (F.col("n") / F.lit(float(total))).alias("prior")), outgroup)


def path_probabilities(rows: DataFrame, ranks: tuple[str, ...] = DEFAULT.ranks, id_col: str = "seq_id", path: str = "path", prob: str = "prob", least: float = 0.0, most: int | None = None) -> DataFrame:
    """Leaf paths with a probability to ``seq_id, rank, parent_taxonomy, taxon, prob``: sums over leaves, from ``least`` on.

    Of each id only its ``most`` likeliest leaves count, ties to the path that sorts first.
    """
    if most is not None:
        place = F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc(prob), path))
        rows = rows.select(id_col, path, prob).withColumn("_place", place).filter(F.col("_place") <= most)
    parts = F.split(path, ",")
    each = rows.select(id_col, F.col(prob).alias("p"), parts.alias("_t"), F.posexplode(parts).alias("i", "taxon"))
    parent = F.when(F.col("i") > 0, F.array_join(F.slice("_t", F.lit(1), F.col("i")), ","))
    out = each.withColumn("parent_taxonomy", parent).withColumn("rank", DEFAULT.name(F.col("i") + 1) if ranks == DEFAULT.ranks else F.get(F.array(*[F.lit(r) for r in ranks]), F.col("i")))
    out = out.groupBy(id_col, "rank", "parent_taxonomy", "taxon").agg(F.sum("p").alias("prob"))
    return out.filter(F.col("prob") >= least)


def kmer_classifier_rows(rows: DataFrame, ranks: tuple[str, ...] = DEFAULT.ranks) -> DataFrame:
    """``seq_id, taxonomy`` like ``k:X(1.00),p:Y(0.93)`` to a row for each rank."""
    each = rows.select("seq_id", F.posexplode(F.split("taxonomy", ",")).alias("i", "part"), F.transform(F.split("taxonomy", ","), lambda x: F.regexp_extract(x, r"^[dkpcofgst]:(.+)\([0-9.]+\)$", 1)).alias("names"))
    return each.select(
        "seq_id",
        F.get(F.array(*[F.lit(r) for r in ranks]), F.col("i")).alias("rank"),
        F.when(F.col("i") > 0, F.array_join(F.slice("names", F.lit(1), F.col("i")), ",")).alias("parent_taxonomy"),
        F.get("names", F.col("i")).alias("taxon"),
        F.nullif(F.regexp_extract("part", r"\(([0-9.]+)\)$", 1), F.lit("")).cast("double").alias("prob"),
    )


def assignment_rows(rows: DataFrame, known: tuple[str, ...] = DEFAULT.taxa, ranks: tuple[str, ...] = DEFAULT.ranks, line: str = "line") -> DataFrame:
    """Lines ``id path prob path prob ...`` to a row for each path, under the known taxa; the taxon ``unk`` is null."""
    cut = F.split(line, " +")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(cut) - 2), F.lit(2)), lambda k: F.struct(F.get(cut, k).alias("path"), F.get(cut, k + 1).cast("double").alias("prob")))
    each = rows.select(F.get(cut, F.lit(0)).alias("seq_id"), F.explode(pairs).alias("x")).select("seq_id", "x.path", "x.prob").filter("path is not null")
    depth = F.regexp_count("path", F.lit(",")) + len(known)
    parent = F.concat_ws(",", F.lit(",".join(known)), taxa.parent_of(F.col("path")))
    return each.select("seq_id", F.get(F.array(*[F.lit(r) for r in ranks]), depth).alias("rank"), parent.alias("parent_taxonomy"), F.nullif(F.element_at(F.split("path", ","), -1), F.lit("unk")).alias("taxon"), "prob")


def placement_rows(rows: DataFrame, ranks: tuple[str, ...] = DEFAULT.ranks, id_col: str = "name") -> DataFrame:
    """Placements ``name, fract, afract, taxopath``: the accumulated share is the taxon's, the own share an unknown child's."""
    p = rows.select(F.col(id_col).alias("seq_id"), F.translate("taxopath", ";", ",").alias("path"), "fract", "afract")
    p = p.withColumn("depth", F.regexp_count("path", F.lit(",")) + 1)
    names = F.array(*[F.lit(r) for r in ranks])
    unknown = p.filter((F.col("fract") > 0) & (F.col("depth") < len(ranks))).select("seq_id", F.get(names, F.col("depth")).alias("rank"), F.col("path").alias("parent_taxonomy"), F.lit(None).cast("string").alias("taxon"), F.col("fract").alias("prob"))
    known = p.select("seq_id", F.get(names, F.col("depth") - 1).alias("rank"), taxa.parent_of(F.col("path")).alias("parent_taxonomy"), F.element_at(F.split("path", ","), -1).alias("taxon"), F.col("afract").alias("prob"))
    return unknown.unionByName(known)


def name_probability_rows(lines: DataFrame, ranks: tuple[str, ...] = DEFAULT.ranks) -> DataFrame:
    """``file, line`` of ``query<k>.nameprob`` files, tab-separated id and pairs of path and probability, to long rows."""
    cut = F.split("line", "\t")
    depth = F.regexp_extract("file", r"query(\d+)\.nameprob", 1).cast("int")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(cut) - 2), F.lit(2)), lambda k: F.struct(F.get(cut, k).alias("path"), F.get(cut, k + 1).cast("double").alias("prob")))
    each = lines.select(F.get(cut, F.lit(0)).alias("seq_id"), depth.alias("depth"), F.explode(pairs).alias("x")).filter("x.path is not null and x.path <> ''")
    path = F.col("x.path")
    return each.select("seq_id", F.get(F.array(*[F.lit(r) for r in ranks]), F.col("depth") - 1).alias("rank"), taxa.parent_of(path).alias("parent_taxonomy"), F.nullif(F.element_at(F.split(path, ","), -1), F.lit("unk")).alias("taxon"), F.col("x.prob").alias("prob"))


def target_taxa(targets: list[str], probabilities: DataFrame, asv: DataFrame, otu: DataFrame, ranks: tuple[str, ...] = DEFAULT.ranks) -> DataFrame:
    """All candidate taxa of every OTU that has a target among them, with the OTU's own taxon of the rank."""
    tip = ranks[-1]
    key = asv.select(F.col("seq_id").alias("asv_seq_id"), tip).join(otu.select("seq_id", tip), tip).drop(tip)
    own = otu.unpivot(["seq_id"], list(ranks), "rank", "otu_taxon")
    found = probabilities.select(F.col("seq_id").alias("asv_seq_id"), "rank", F.col("taxon").alias("candidate_taxon"), F.col("prob").alias("candidate_prob")).join(key, "asv_seq_id")
    hit = found.filter(F.col("candidate_taxon").isin(targets)).select("seq_id").distinct()
    return found.join(hit, "seq_id", "left_semi").join(own, ["seq_id", "rank"], "left").select("seq_id", "asv_seq_id", "otu_taxon", "rank", "candidate_taxon", "candidate_prob")
