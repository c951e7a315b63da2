"""Pipeline options: sections with defaults, validated, from a nested mapping or a YAML file."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields, replace
from typing import Any

from .functions.taxa import Ranks


def flatten(x: Any) -> Any:
    """A list of one-key maps as one map, and so inside."""
    if isinstance(x, list) and x and all(isinstance(i, dict) and len(i) == 1 for i in x):
        x = {k: v for i in x for k, v in i.items()}
    return {k: flatten(v) for k, v in x.items()} if isinstance(x, dict) else x


def _check(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclass(frozen=True)
class Trim:
    max_err: float = 0.2
    min_overlap: int = 10
    action: str = "retain"
    discard_untrimmed: bool = True
    max_n: int | None = 0
    max_ee: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    truncQ_R1: tuple[float, ...] | None = (2,)
    truncQ_R2: tuple[float, ...] | None = (2,)
    cut_R1: tuple[int, ...] | None = None
    cut_R2: tuple[int, ...] | None = None

    def __post_init__(self):
        _check(0 <= self.max_err, "max_err must not be negative")
        _check(self.min_overlap >= 1, "min_overlap must be positive")
        _check(self.action in ("retain", "trim", "mask", "lowercase", "none"), "action is retain, trim, mask, lowercase or none")

    def update(self, **new) -> Trim:
        """These options with others in their place; unknown names are left alone."""
        return replace(self, **{k: v for k, v in new.items() if k in {f.name for f in fields(self)} and v is not None})


@dataclass(frozen=True)
class Filter:
    maxEE_R1: float = 2.0
    maxEE_R2: float = 2.0

    def update(self, **new) -> Filter:
        return replace(self, **{k: v for k, v in new.items() if k in ("maxEE_R1", "maxEE_R2") and v is not None})


@dataclass(frozen=True)
class TagJump:
    f: float = 0.05
    p: float = 0.05

    def __post_init__(self):
        _check(0 <= self.f <= 1, "f is a share")
        _check(self.p > 0, "p must be positive")


@dataclass(frozen=True)
class Curation:
    max_dist: float = 0.1
    dist_type: str = "fraction"
    min_abundance_ratio: float = 1.0
    min_cooccurrence_ratio: float = 1.0
    use_mean_abundance_ratio: bool = False
    max_gap_length: int | None = None
    max_gap_total: int | None = None

    def __post_init__(self):
        _check(self.dist_type in ("fraction", "score", "base"), "dist_type is fraction, score or base")
        _check(0 <= self.min_cooccurrence_ratio <= 1, "min_cooccurrence_ratio is a share")


@dataclass(frozen=True)
class Clusters:
    min_conf: float = 0.5
    dist_max: float = 0.4
    dist_step: float = 0.001
    min_taxa: int = 5
    min_refseq: int = 10
    thresholds: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        _check(self.min_taxa >= 2 and self.min_refseq >= 2, "min_taxa and min_refseq must be at least 2")
        _check(all(0 <= v <= 100 for v in self.thresholds.values()), "thresholds are percentages")

    def threshold(self, taxon: str | None) -> float | None:
        """A taxon's threshold, or the one for all others."""
        return self.thresholds.get(taxon or "_NA_", self.thresholds.get("_NA_"))


@dataclass(frozen=True)
class Model:
    model_type: str = "none"
    model_file: str | None = None
    max_model_start: int | None = None
    min_model_end: int | None = None
    min_model_score: float | None = None

    def __post_init__(self):
        _check(self.model_type in ("none", "CM", "HMM"), "model_type is none, CM or HMM")
        _check(self.model_type == "none" or self.model_file is not None, "a model needs its file")


@dataclass(frozen=True)
class Parallel:
    max_batchsize: int | None = None
    workers_per_seqrun: int = 1
    min_workers: int = 1
    max_workers: int | None = None

    def workers(self, runs: int) -> int:
        """Workers for so many oriented runs, within the limits."""
        n = max(self.min_workers, runs * self.workers_per_seqrun)
        return min(n, self.max_workers) if self.max_workers else n


@dataclass(frozen=True)
class Controls:
    """Files of spikes and of positive controls; none where they are null or false."""

    spike: str | None = None
    positive: str | None = None

    def __post_init__(self):
        for name in ("spike", "positive"):
            given = getattr(self, name)
            _check(given is not True, f"{name} is a file, false or empty")
            object.__setattr__(self, name, given or None)


@dataclass(frozen=True)
class AddedReference:
    """Sequences and their taxonomy, both or neither."""

    fasta: str | None = None
    table: str | None = None

    def __post_init__(self):
        _check((self.fasta is None) == (self.table is None), "added references need both fasta and table")


@dataclass(frozen=True)
class Sintax:
    reftax: str | None = None

    def __post_init__(self):
        _check(self.reftax is not None, "sintax needs its reference")


@dataclass(frozen=True)
class Bayesant:
    reftax: str | None = None
    model: str | None = None
    aligned: bool = False

    def __post_init__(self):
        _check(self.reftax is not None or self.model is not None, "bayesant needs a reference or a model")
        _check(isinstance(self.aligned, bool), "aligned is true or false")


_PRIMER = re.compile("^[ACGTMRWSYKVHDBNIacgtmrwsykvhdbni]+$")


@dataclass(frozen=True)
class PipelineConfig:
    project_name: str = "project"
    file_extension: str = r"fastq(?:\.gz)?"
    orient: str = "fwd"
    duplicate_samples: str = "error"
    custom_sample_table: str | None = None
    forward_primer: str | None = None
    reverse_primer: str | None = None
    trimming: Trim = field(default_factory=Trim)
    filtering: Filter = field(default_factory=Filter)
    tag_jump: TagJump = field(default_factory=TagJump)
    lulu: Curation = field(default_factory=Curation)
    clustering: Clusters = field(default_factory=Clusters)
    amplicon_model: Model = field(default_factory=Model)
    parallelism: Parallel = field(default_factory=Parallel)
    ranks: Ranks = field(default_factory=Ranks)
    rarefy: tuple[dict, ...] = ()
    otu_table: tuple[str, ...] = ("dense",)
    control: Controls = field(default_factory=Controls)
    added_reference: AddedReference = field(default_factory=AddedReference)
    sintax: Sintax | None = None
    bayesant: Bayesant | None = None
    guilds: bool = False
    supplemental: dict = field(default_factory=dict)
    classifiers: dict = field(default_factory=dict)
    path: str = "."

    def __post_init__(self):
        _check(self.orient in ("fwd", "rev", "mixed", "custom"), "orient is fwd, rev, mixed or custom")
        _check(self.orient != "custom" or self.custom_sample_table is not None, "orient custom needs a custom sample table")
        _check(isinstance(self.guilds, bool), "guilds is true or false")
        _check(self.duplicate_samples in ("error", "merge"), "duplicate_samples is error or merge")
        for p in (self.forward_primer, self.reverse_primer):
            _check(p is None or bool(_PRIMER.match(p)), "a primer is made of IUPAC codes")

    _SECTIONS = {"trimming": Trim, "filtering": Filter, "tag_jump": TagJump, "lulu": Curation, "clustering": Clusters, "amplicon_model": Model, "parallelism": Parallel, "control": Controls, "added_reference": AddedReference, "sintax": Sintax, "bayesant": Bayesant}

    @classmethod
    def from_mapping(cls, options: dict) -> PipelineConfig:
        """From nested options; a section may be a list of one-key maps, and unknown keys are errors."""
        options = flatten(options)
        own: dict[str, Any] = {}
        for key, value in options.items():
            if key in cls._SECTIONS:
                own[key] = cls._SECTIONS[key](**{k: tuple(v) if isinstance(v, list) else v for k, v in (value or {}).items()})
            elif key == "taxonomy":
                ranks = value.get("ranks", Ranks().ranks)
                known = {k: v for k, v in ranks.items() if v} if isinstance(ranks, dict) else {}
                names = tuple(ranks)
                own["ranks"] = Ranks(names, tuple(known) or names[:1], tuple(known.values()) or Ranks().taxa)
            elif key in {f.name for f in fields(cls)}:
                own[key] = tuple(value) if isinstance(value, list) else value
            else:
                raise ValueError(f"unknown option {key}")
        return cls(**own)

    @classmethod
    def from_yaml(cls, path: str) -> PipelineConfig:
        import yaml

        with open(path, encoding="utf-8") as f:
            return cls.from_mapping(yaml.safe_load(f) or {})

    def folder(self, kind: str) -> str:
        """The folder of raw, trimmed, filtered, rarefied or later data under the project's path."""
        # fixed values: folder names
        places = {"meta": "meta", "seq": "sequences", "raw": "sequences/01_raw", "trim": "sequences/02_trimmed", "filt": "sequences/03_filtered", "protax": "sequences/07_protax", "rarefy": "sequences/04_rarefied", "asv": "sequences/05_denoised", "aligned": "sequences/06_aligned", "output": "output", "log": "logs"}
        return f"{self.path.rstrip('/')}/{places[kind]}"


def check_header_ids(headers, column: str = "name") -> None:
    """Ids of added sequences have neither white space nor semicolons."""
    bad = headers.filter(headers[column].rlike(r"[\s;]")).limit(1).collect()
    _check(not bad, f"id has white space or a semicolon: {bad[0][column] if bad else ''}")
