"""Column functions on sequences, names and quality strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements, in both cases.
CODES = "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn"
COMPLEMENTS = "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"
#: What each IUPAC code stands for.
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "M": "AC", "R": "AG", "W": "AT", "S": "CG", "Y": "CT", "K": "GT", "V": "ACG", "H": "ACT", "D": "AGT", "B": "CGT", "N": "ACGT"}


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, CODES, COMPLEMENTS))


def has_alphabet(seq: Column, alphabet: str) -> Column:
    """Whether all characters are of the alphabet; null stays null."""
    import re

    return seq.rlike(rf"^[{re.escape(alphabet)}]*\z")


def seq_hash(seq: Column) -> Column:
    return F.md5(seq)


def ascii_clean(s: Column) -> Column:
    """Anything but ASCII letters, digits and punctuation becomes ``x``, once for each UTF-8 byte."""
    one = lambda c: F.when(c.rlike("^[!-~]$"), c).otherwise(F.repeat(F.lit("x"), F.octet_length(c)))
    return F.array_join(F.transform(F.filter(F.split(s, ""), lambda c: c != ""), one), "")


def seq_name(prefix: str, number: Column, total: Column | int) -> Column:
    """Prefix and number, padded with zeros to the digits of the total."""
    width = F.length((F.lit(total) if isinstance(total, int) else total).cast("string"))
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, F.lit("0")))


def qualities(qual: Column, offset: int = 33) -> Column:
    """Scores of a quality string."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - offset)


def expected_errors(qual: Column, offset: int = 33) -> Column:
    """Sum of the error probabilities that the scores stand for; an empty string has none."""
    return F.aggregate(qualities(qual, offset), F.lit(0.0), lambda s, q: s + F.pow(F.lit(10.0), -q / 10.0))


def sample_key(path: Column) -> Column:
    """File name without direction, read and stage."""
    # fixed value: how file names end
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"_(fwd|rev)_R[12](_(filt|trim))?\.fastq\.gz$", "")


def primer_pattern(primer: str) -> str:
    """A regular expression for a primer with IUPAC codes."""
    return "".join(f"[{IUPAC[c]}]" if len(IUPAC[c]) > 1 else IUPAC[c] for c in primer.upper())


def levenshtein_within(a: Column, b: Column, limit: int) -> Column:
    """Edit distance up to a limit, null beyond; the computation stops at the limit."""
    d = F.levenshtein(a, b, limit)
    return F.when(d >= 0, d)
