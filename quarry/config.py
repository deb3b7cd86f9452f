"""Parameters of the native operators, checked when they are made."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields


class ConfigError(ValueError):
    """A parameter outside its range, or parameters that exclude each other."""


SAMPLE_ID = re.compile(r"[A-Za-z0-9_-]+")


@dataclass(frozen=True)
class EngineConfig:
    min_length: int = 1000
    min_score: float = 0.7
    cluster_ani: float = 95.0
    cluster_qcov: float = 0.0
    cluster_tcov: float = 85.0
    cluster_layers: int = 1
    tax_threshold: float = 0.6
    parts: int = 1
    fasta: str | None = None
    fasta_dir: str | None = None
    sample_sheet: str | None = None

    def __post_init__(self) -> None:
        for name, low, high in (("min_length", 0, None), ("min_score", 0, 1), ("cluster_ani", 0, 100), ("cluster_qcov", 0, 100), ("cluster_tcov", 0, 100), ("cluster_layers", 1, 8), ("tax_threshold", 0, 1), ("parts", 1, None)):
            value = getattr(self, name)
            if value < low or high is not None and value > high:
                raise ConfigError(f"{name} = {value}: from {low} to {'any' if high is None else high}")
        if sum(x is not None for x in (self.fasta, self.fasta_dir, self.sample_sheet)) > 1:
            raise ConfigError("give one of fasta, fasta_dir and sample_sheet")

    def input(self) -> tuple[str, str]:
        """(name, path) of the input; it is an error if none is given."""
        given = [(n, getattr(self, n)) for n in ("fasta", "fasta_dir", "sample_sheet") if getattr(self, n) is not None]
        if not given:
            raise ConfigError("give one of fasta, fasta_dir and sample_sheet")
        return given[0]

    @classmethod
    def from_map(cls, *layers: dict) -> EngineConfig:
        """Later maps win; None leaves what is set; unknown names are errors."""
        known = {f.name for f in fields(cls)}
        merged: dict = {}
        for layer in layers:
            if unknown := set(layer) - known:
                raise ConfigError(f"unknown: {', '.join(sorted(unknown))}")
            merged |= {k: v for k, v in layer.items() if v is not None}
        return cls(**merged)


def sample_id(value: str) -> str:
    if not SAMPLE_ID.fullmatch(value):
        raise ConfigError(f"sample id {value!r}: letters, digits, _ and - only")
    return value


def defaults() -> str:
    """All parameters with their defaults, a line each, as a configuration file."""
    return "".join(f"{f.name}: {'' if f.default is None else f.default}\n" for f in fields(EngineConfig))


def parse(text: str) -> dict:
    """name: value lines as a map for ``from_map``; # starts a comment, an empty value is None, numbers are read as such."""
    out: dict = {}
    for line in text.splitlines():
        line = line.split("#", 1)[0].strip()
        if not line:
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise ConfigError(f"no value: {line}")
        value = value.strip()
        for kind in (int, float, str):
            try:
                out[name.strip()] = kind(value) if value else None
                break
            except ValueError:
                continue
    return out
