"""External tools, where they are installed: each partition's sequences go through one process."""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame

from ..functions.taxa import DEFAULT
from ..operators import taxonomy
from .tables import DNA_TBLOUT, DOMTBLOUT, _schema, fixed_width


def find_executable(name: str) -> str:
    """The tool from the variable of its name, in either case, or the path; an error where it is missing."""
    key = name.replace("-", "_")
    for place in (os.environ.get(key), os.environ.get(key.upper()), shutil.which(name), os.path.join("bin", name)):
        if place and os.path.isfile(place) and os.access(place, os.X_OK):
            return place
    raise FileNotFoundError(f"no executable {name}")


def through(seqs: DataFrame, command: Callable[[str, str], list], parse: Callable[[str], list[tuple]], schema: str, fastq: bool = False, stdout: bool = False) -> DataFrame:
    """Write each partition as a file in the task's own folder, run the command on it, and parse what it wrote.

    ``command(infile, outfile)`` gives the arguments, or a list of such for several
    commands that run in turn; ``parse(text)`` gives the rows of the output file, or
    of what the last command printed with ``stdout``. Files that commands name besides
    must be where every executor sees them. Empty partitions run nothing; a tool that
    fails fails the task.
    """
    names = [f.name for f in _schema(schema).fields]

    def run(batches):
        import pandas as pd

        with tempfile.TemporaryDirectory() as d:
            source, target = os.path.join(d, "in"), os.path.join(d, "out")
            n = 0
            with open(source, "w", encoding="utf-8") as f:
                for pdf in batches:
                    for r in pdf.itertuples():
                        f.write(f"@{r.seq_id}\n{r.seq}\n+\n{r.qual}\n" if fastq else f">{r.seq_id}\n{r.seq}\n")
                        n += 1
            if n:
                steps = command(source, target)
                for args in steps if isinstance(steps[0], list) else [steps]:
                    said = subprocess.run(args, check=True, capture_output=True).stdout
                if stdout:
                    text = said.decode()
                else:
                    with open(target, encoding="utf-8") as f:
                        text = f.read()
                if rows := parse(text):
                    yield pd.DataFrame(rows, columns=names)

    return seqs.mapInPandas(run, schema)


def _table(ddl: str) -> Callable[[str], list[tuple]]:
    """Rows of a fixed-width table."""
    schema = _schema(ddl)  # made here, as tasks have no session
    return lambda text: fixed_width(text, schema)


def fasta_rows(text: str) -> list[tuple]:
    """(name, sequence) of the records, lines of a sequence joined."""
    cut = [record.split("\n", 1) for record in ("\n" + text).split("\n>")[1:]]
    return [(head.split()[0] if head.split() else "", "".join(body).replace("\n", "")) for head, *body in cut]


def profile_alignment(seqs: DataFrame, profile: str, layout: str = "A2M") -> DataFrame:
    """``seq_id, seq``: sequences aligned to a profile, without what lies beyond it."""
    tool = find_executable("hmmalign")
    return through(seqs, lambda a, b: [tool, "--outformat", layout, "--trim", "-o", b, profile, a], fasta_rows, "seq_id string, seq string")


def profile_hits(seqs: DataFrame, profile: str) -> DataFrame:
    """Domains of sequences that a protein profile finds, a row each."""
    tool = find_executable("hmmsearch")
    return through(seqs, lambda a, b: [tool, "--noali", "--notextw", "--cpu", "1", "--domtblout", b, profile, a], _table(DOMTBLOUT), DOMTBLOUT)


def nucleotide_hits(seqs: DataFrame, profile: str) -> DataFrame:
    """Places in sequences, on their own strand, that a nucleotide profile finds."""
    tool = find_executable("nhmmer")
    return through(seqs, lambda a, b: [tool, "--noali", "--notextw", "--watson", "--cpu", "1", "--tblout", b, profile, a], _table(DNA_TBLOUT), DNA_TBLOUT)


def query_rows(text: str) -> list[tuple]:
    """(name, fract, afract, taxopath) of a tab-separated table with these columns."""
    head, *lines = [line.split("\t") for line in text.splitlines() if line.strip()] or [[]]
    rows = [dict(zip(head, line, strict=False)) for line in lines]
    return [(r["name"], float(r["fract"]), float(r["afract"]), r["taxopath"]) for r in rows]


def placed(seqs: DataFrame, alignment: str, tree: str, model: str, taxa: str, outgroup: str, ranks: tuple[str, ...] = DEFAULT.ranks) -> DataFrame:
    """``seq_id, rank, parent_taxonomy, taxon, prob`` of aligned sequences that are placed on a tree whose leaves have taxa."""
    place, assign = find_executable("epa-ng"), find_executable("gappa")

    def command(a, b):
        d = os.path.dirname(b)
        return [
            [place, "--ref-msa", alignment, "--query", a, "--tree", tree, "--outdir", d, "--model", model, "--redo", "--threads", "1"],
            [assign, "examine", "assign", "--per-query-results", "--jplace-path", os.path.join(d, "epa_result.jplace"), "--taxon-file", taxa, "--root-outgroup", outgroup, "--ranks-string", "|".join(ranks), "--allow-file-overwriting", "--threads", "1", "--out-dir", d],
            ["mv", os.path.join(d, "per_query.tsv"), b],
        ]

    return taxonomy.placement_rows(through(seqs, command, query_rows, "name string, fract double, afract double, taxopath string"), ranks)


def assigned(seqs: DataFrame, tool: str, model: list[str], least: float = 0.1, report: float = 0.01, known: tuple[str, ...] = DEFAULT.taxa, ranks: tuple[str, ...] = DEFAULT.ranks) -> DataFrame:
    """Taxa of aligned sequences by a probabilistic classifier that prints a line a sequence; ``model`` are its files, in its order."""
    exe = find_executable(tool)
    lines = through(seqs, lambda a, b: [exe, "-t", str(report), *model, str(least), a], lambda text: [(x,) for x in text.splitlines() if x.strip()], "line string", stdout=True)
    return taxonomy.assignment_rows(lines, known, ranks)


def uc_rows(text: str) -> list[tuple]:
    """(query, hit, identity) of the hits in a cluster file."""
    cut = [line.split("\t") for line in text.splitlines()]
    return [(c[8].split(";")[0], c[9].split(";")[0], float(c[3])) for c in cut if len(c) > 9 and c[0] == "H"]


def global_hits(seqs: DataFrame, reference: str, identity: float) -> DataFrame:
    """Best global hits by the search tool: (seq_id, hit, identity in percent)."""
    tool = find_executable("vsearch")
    return through(seqs, lambda a, b: [tool, "--usearch_global", a, "--db", reference, "--id", str(identity), "--uc", b, "--threads", "1"], uc_rows, "seq_id string, hit string, identity double")
