"""Which columns hold names and sequences, and how many threads a process may use."""

from __future__ import annotations

import os

#: Columns that hold names, and those that hold sequences, first come first.
NAMES = ("seq_id", "name", "ASV", "OTU")
SEQUENCES = ("seq", "sequence")


def _role(columns: list[str], own: tuple[str, ...], other: tuple[str, ...], place: int, what: str) -> str:
    for c in own:
        if c in columns:
            return c
    if len(columns) == 2:
        # of two columns, the one that isn't the other role; else by place
        taken = next((c for c in other if c in columns), None)
        return next(c for c in columns if c != taken) if taken else columns[place]
    raise ValueError(f"no {what} column among {', '.join(columns)}")


def name_column(columns: list[str]) -> str:
    return _role(columns, NAMES, SEQUENCES, 0, "name")


def seq_column(columns: list[str]) -> str:
    return _role(columns, SEQUENCES, NAMES, 1, "sequence")


def local_cpus() -> int:
    """Threads of this process: a batch job's share, one where that is unknown, else all but one."""
    if os.environ.get("SLURM_JOB_ID"):
        n = os.environ.get("SLURM_JOB_CPUS_PER_NODE", "")
        return int(n) if n.isdigit() and int(n) > 0 else 1
    return max((os.cpu_count() or 1) - 1, 1)
