"""Ranks, and column functions on classifications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ranks:
    """The lattice of ranks, most inclusive first; known ranks are the first ones, with one known taxon each."""

    ranks: tuple[str, ...] = ("kingdom", "phylum", "class", "order", "family", "genus", "species")
    known: tuple[str, ...] = ("kingdom",)
    taxa: tuple[str, ...] = ("Fungi",)
    offset: int = 0

    def __post_init__(self):
        if self.ranks[: len(self.known)] != self.known or len(self.known) != len(self.taxa):
            raise ValueError("known ranks must be the first ranks, with a taxon each")

    @property
    def unknown(self) -> tuple[str, ...]:
        return self.ranks[len(self.known) :]

    @property
    def root(self) -> str:
        return self.ranks[0]

    @property
    def second(self) -> str:
        return self.ranks[1]

    @property
    def ingroup(self) -> str:
        return self.known[-1]

    @property
    def ingroup_taxon(self) -> str:
        return self.taxa[-1]

    @property
    def tip(self) -> str:
        return self.ranks[-1]

    def above(self, rank: str) -> tuple[str, ...]:
        return self.ranks[: self.ranks.index(rank)]

    def below(self, rank: str) -> tuple[str, ...]:
        return self.ranks[self.ranks.index(rank) + 1 :]

    def columns(self) -> list[Column]:
        return [F.col(r) for r in self.ranks]

    def ordinal(self, rank: Column) -> Column:
        """1 for the tip, more for ranks that are more inclusive; null for other names."""
        return F.create_map(*[F.lit(x) for i, r in enumerate(reversed(self.ranks), 1) for x in (r, i)])[rank]

    def name(self, number: Column) -> Column:
        """Rank of a 1-based depth from the root."""
        return F.get(F.array(*[F.lit(r) for r in self.ranks]), number - 1)


DEFAULT = Ranks()

#: One-letter prefixes of header formats.
SINTAX_RANKS = {"d": "domain", "k": "kingdom", "p": "phylum", "c": "class", "o": "order", "f": "family", "g": "genus", "s": "species", "t": "strain"}
UNITE_RANKS = {"k": "kingdom", "p": "phylum", "c": "class", "o": "order", "f": "family", "g": "genus", "s": "species"}
BOLD_RANKS = ("kingdom", "phylum", "class", "order", "family", "subfamily", "tribe", "genus", "species", "subspecies")


def truncate(path: Column, rank: int) -> Column:
    """The first ``rank`` parts of a comma path; null where there are fewer."""
    parts = F.split(path, ",")
    return F.when(F.size(parts) >= rank, F.array_join(F.slice(parts, 1, rank), ","))


def strip_number(taxon: Column) -> Column:
    """Without a final underscore and digits, unless the name is a placeholder."""
    return F.when(taxon.startswith("pseudo"), taxon).otherwise(F.regexp_replace(taxon, "_[0-9]+$", ""))


def sintax_format(path: Column) -> Column:
    """A comma path with the prefixes d, p, c, o, f, g, s by depth; deeper parts have none."""
    letters = F.array(*[F.lit(f"{x}:") for x in "dpcofgs"])
    parts = F.transform(F.split(path, ","), lambda x, i: F.concat(F.coalesce(F.get(letters, i), F.lit("")), x))
    return F.concat(F.lit("tax="), F.array_join(parts, ","), F.lit(";"))


def parent_of(path: Column) -> Column:
    """A comma path without its last part, null at the root."""
    return F.when(path.contains(","), F.regexp_replace(path, ",[^,]+$", ""))
