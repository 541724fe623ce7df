"""Assay layout and thresholds, loadable from JSON."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields


@dataclass(frozen=True)
class AssayConfig:
    # Fixed values of the assay: they must equal the published protocol defaults.
    trim_tso: bool = False
    tso: str = "AAGCAGTGGTATCAACGCAGAGT"
    tso_rev: str = "ACTCTGCGTTGATACCACTGCTT"
    a1: str = "CTGTCTCTTATACACATCTCCGAGCCCACGAGAC"
    a2: str = "CTGTCTCTTATACACATCT"
    q5: int = 15
    q3: int = 10
    mlen1: int = 61
    mlen2: int = 25
    method: str = "FreeDivergence"
    rna_adapter1: str = "TACTGCAGCTGAACCTC"
    rna_adapter2: str = "AAAAAAAAAAAAAAA"
    tag_seq: str = "AGATGTGTATAAGAGACAG"
    tag_edit_dist: tuple = (2, 9)
    tag_length: int = 19
    bc_edit_dist: tuple = (1, 1, 1)
    umi_bc_len: tuple = (10, (8, 9, 10, 11), 6)
    umi_bc_starts: tuple = (0, 10, (35, 36, 37, 38))
    tag_start: tuple = (41, 42, 43, 44)
    i5_len: int = 16
    atac_pe: bool = True
    rna_pe: bool = False
    min_mapq: int = 30
    max_flen: int = 1000
    atac_mlen2: int = 20
    cuttss: float = 4
    cutumi: int = 100
    countby: str = "bin"

    @property
    def shifted(self) -> bool:
        """True when round-1 barcodes have mixed lengths that shift the later fields."""
        return not isinstance(self.umi_bc_len[1], int)

    @classmethod
    def from_json(cls, text: str) -> "AssayConfig":
        raw = json.loads(text)
        known = {f.name for f in fields(cls)}
        unknown = set(raw) - known
        if unknown:
            raise ValueError(f"unknown config keys: {sorted(unknown)}")
        return cls(**{k: _freeze(v) for k, v in raw.items()})

    def to_json(self) -> str:
        return json.dumps(asdict(self))


def _freeze(value):
    return tuple(_freeze(v) for v in value) if isinstance(value, list) else value
