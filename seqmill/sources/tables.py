"""Text tables of other tools, and files that are returned by their path."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.taxa import DEFAULT
from ..operators import taxonomy

#: Columns of the profile-search tables of proteins and of nucleotides, and of covariance-model scores.
DOMTBLOUT = "target_name string, target_accession string, tlen int, query_name string, query_accession string, qlen int, full_evalue double, full_score double, full_bias double, domain int, n_domain int, c_evalue double, i_evalue double, domain_score double, domain_bias double, hmm_from int, hmm_to int, ali_from int, ali_to int, env_from int, env_to int, acc double, description string"
DNA_TBLOUT = "target_name string, target_accession string, query_name string, query_accession string, hmm_from int, hmm_to int, ali_from int, ali_to int, env_from int, env_to int, sq_len int, strand string, evalue double, score double, bias double, description string"
SFILE = "idx int, seq_name string, length int, cm_from int, cm_to int, trunc string, bit_sc double, avg_pp double, band_calc double, alignment double, total double, mem_mb double"


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    """No rows, all columns."""
    return spark.createDataFrame([], _schema(ddl))


def fixed_width(text: str, schema: T.StructType) -> list[tuple]:
    """Rows of a text whose columns are under the dashes of a ``#---`` ruler; each ruler begins a new segment.

    The last column goes on to the line's end. Values that don't fit their type are null.
    """
    make = {"int": int, "double": float, "string": str}
    kinds = [make[f.dataType.simpleString()] for f in schema.fields]
    cuts: list[tuple[int, int | None]] = []
    out = []
    for line in text.splitlines():
        if re.match(r"^#[-\s]*-[-\s]*$", line) and "-" in line:
            spans = [m.span() for m in re.finditer(r"[#-]-*", line)]
            if len(spans) >= len(kinds) - 1:
                # a column reaches from behind the one before it to its own dashes' end
                ends = [b for _, b in spans[: len(kinds)]]
                starts = [0, *ends[: len(kinds) - 1]]
                cuts = [*zip(starts[: len(kinds) - 1], ends[: len(kinds) - 1], strict=True), (starts[len(kinds) - 1] if len(starts) >= len(kinds) else ends[-1], None)]
            continue
        if line.startswith("#") or not line.strip() or not cuts:
            continue
        row = []
        for (a, b), kind in zip(cuts, kinds, strict=True):
            value = line[a:b].strip()
            try:
                row.append(kind(value) if value and value != "-" or kind is str and value else None)
            except ValueError:
                row.append(None)
        out.append(tuple(row))
    return out


def read_fixed_width(spark: SparkSession, paths: str | list[str], ddl: str) -> DataFrame:
    """Fixed-width tables of files, a file a task; no rows but all columns for empty ones."""
    schema = _schema(ddl)
    files = spark.read.text(paths, wholetext=True)

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for text in pdf.value:
                rows = fixed_width(text, schema)
                if rows:
                    yield pd.DataFrame({f.name: pd.Series([r[i] for r in rows], dtype={"int": "Int32", "double": "Float64"}.get(f.dataType.simpleString(), "object")) for i, f in enumerate(schema.fields)})

    return files.mapInPandas(run, schema)


def read_long_table(spark: SparkSession, path: str, seqrun: str = "supplemental", id_col: str = "seq_id") -> DataFrame:
    """A TSV of sample, id and reads as a typed table; the run is ``seqrun`` where there is no such column."""
    kinds = f"sample string, {id_col} string, nread int, seqrun string"
    raw = spark.read.csv(path, sep="\t", header=True)
    if not raw.columns:
        return empty(spark, kinds)
    missing = {"sample", id_col, "nread"} - set(raw.columns)
    if missing:
        raise ValueError(f"columns are missing: {', '.join(sorted(missing))}")
    run = F.coalesce(F.col("seqrun"), F.lit(seqrun)) if "seqrun" in raw.columns else F.lit(seqrun)
    return raw.select("sample", id_col, F.col("nread").cast("int").alias("nread"), run.alias("seqrun"))


def read_taxonomy_table(spark: SparkSession, path: str, ranks: tuple[str, ...] = DEFAULT.ranks) -> DataFrame:
    """A TSV taxonomy: with a header of all ranks or of ``taxonomy``; without one, of id and path, id, something and path, or id and ranks."""
    first = spark.read.text(path).limit(1).collect()
    columns = ", ".join(f"{r} string" for r in ranks)
    if not first or not first[0][0].strip():
        return empty(spark, f"seq_id string, {columns}")
    names = first[0][0].split("\t")
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    if set(ranks) <= set(names) or "taxonomy" in names:
        raw = spark.read.csv(path, sep="\t", header=True)
        own = "seq_id" if "seq_id" in names else names[0]
        if "taxonomy" not in names:
            return raw.select(F.col(own).alias("seq_id"), *[blank(F.col(r)).alias(r) for r in ranks])
        tax = raw.select(F.col(own).alias("seq_id"), "taxonomy")
        as_header = tax.select(F.concat("seq_id", F.lit(";tax="), F.regexp_replace("taxonomy", "^tax=|;$", "")).alias("header"))
        if taxonomy.detect_formats(as_header).first()["is_sintax"]:
            parsed = taxonomy.parse_sintax(as_header)
            return parsed.select("seq_id", *[r for r in ranks if r in parsed.columns])
        return taxonomy.parse_tabular(tax, ranks)
    raw = spark.read.csv(path, sep="\t", header=False)
    if len(names) == 1 + len(ranks):
        return raw.select(F.col("_c0").alias("seq_id"), *[blank(F.col(f"_c{i}")).alias(r) for i, r in enumerate(ranks, 1)])
    if len(names) in (2, 3):
        return taxonomy.parse_tabular(raw.select(F.col("_c0").alias("seq_id"), F.col(f"_c{len(names) - 1}").alias("taxonomy")), ranks)
    raise ValueError(f"no taxonomy in {path}: neither a known header nor a known number of columns")


def read_reference(spark: SparkSession, path: str, ranks: tuple[str, ...] = DEFAULT.ranks, rank_map: dict[str, str] | None = None) -> DataFrame | None:
    """A reference taxonomy: of FASTA or FASTQ headers, or a table."""
    from .fastx import read_fastx

    if re.search(r"\.(fa|fasta|fas|fna|fq|fastq)(\.gz)?$", path):
        h = read_fastx(spark, path).select(F.concat_ws(" ", "name", F.nullif("description", F.lit(""))).alias("header"))
        return taxonomy.parse_headers(h, ranks, rank_map)
    return read_taxonomy_table(spark, path, ranks)


def parse_model(text: str) -> str:
    """The substitution model in a maximum-likelihood report, with its rates, frequencies, invariant share and gamma shape, as one string."""
    name = re.search(r"(?:Model of substitution|Best-fit model[^:]*):\s*(\S+)", text)
    if not name:
        raise ValueError("no model in the report")
    parts = name[1].split("+")
    rates = re.findall(r"^\s*([ACGT])-([ACGT]):\s*([0-9.]+)", text, re.M)
    freqs = re.findall(r"pi\(([ACGT])\)\s*=\s*([0-9.]+)", text)
    out = parts[0]
    if rates:
        out += "{" + "/".join(r[2] for r in rates[:6]) + "}"
    if freqs:
        out += "+FU{" + "/".join(f[1] for f in freqs) + "}"
    if m := re.search(r"Proportion of invariable sites:\s*([0-9.]+)", text):
        out += f"+I{{{m[1]}}}"
    if m := re.search(r"Gamma shape alpha:\s*([0-9.]+)", text):
        n = re.search(r"with (\d+) categories", text)
        out += f"+G{n[1] if n else 4}{{{m[1]}}}"
    return out


#: Keys of a placement file.
PLACEMENT_KEYS = ("fields", "metadata", "placements", "tree", "version")
PLACEMENT_SCHEMA = "tree string, placements array<struct<p:array<array<double>>,n:array<string>>>, metadata map<string,string>, version int, fields array<string>"


def is_placement(json):
    """Whether a JSON text has just the keys of a placement file."""
    return F.array_sort(F.json_object_keys(json)) == F.array(*[F.lit(k) for k in PLACEMENT_KEYS])


def placements(texts: DataFrame, col: str = "value") -> DataFrame:
    """``name, <fields>`` of every placement of placement files."""
    j = texts.filter(is_placement(F.col(col))).select(F.from_json(col, PLACEMENT_SCHEMA).alias("j")).select("j.fields", F.explode("j.placements").alias("x"))
    each = j.select("fields", F.explode("x.n").alias("name"), F.col("x.p").alias("p")).select("fields", "name", F.explode("p").alias("v"))
    return each.select("name", F.map_from_arrays("fields", "v").alias("values"))


def write_table(table: DataFrame, path: str, kind: str = "parquet") -> str:
    """Write as Parquet or TSV; the path."""
    if kind == "tsv":
        table.write.mode("overwrite").csv(path, sep="\t", header=True)
    elif kind == "parquet":
        table.write.mode("overwrite").parquet(path)
    else:
        raise ValueError("a table is written as parquet or tsv")
    return path


def write_lines(lines: list[str], path: str) -> str:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(f"{x}\n" for x in lines)
    return path


def without_labels(refs: DataFrame, labels: DataFrame, name: str = "name", label: str = "label") -> DataFrame:
    """References whose name holds none of the labels; names are cut to the words that labels are made of first."""
    words = refs.select(name, F.explode(F.split(name, r"[\s;|,]+")).alias(label)).join(labels.select(label).distinct(), label)
    return refs.join(words.select(name).distinct(), name, "left_anti")
