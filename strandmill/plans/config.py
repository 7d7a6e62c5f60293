"""Settings of an assembly: defaults, types, checks; small helpers for option texts."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, fields

# What a setting may say for yes and no.
YES, NO = "T t Y y true True TRUE yes Yes YES 1", "F f N n false False FALSE no No NO 0"
SECTIONS = ("General", "job.defaults", "job.step")


@dataclass(frozen=True)
class AssemblyConfig:
    """Parameters of filtering, graph and layout."""

    length_cutoff: int = -1
    genome_size: int = 0
    seed_coverage: int = 20
    max_diff: int = 120
    max_cov: int = 120
    min_cov: int = 2
    min_len: int = 4000
    bestn: int = 10
    min_identity: float = 96.0
    remove_chimeras: bool = True
    local_flow: bool = False
    improper_contigs: bool = False
    proper_alternatives: bool = False

    def __post_init__(self):
        if self.length_cutoff < 0 and self.genome_size < 1 and self.length_cutoff != -1:
            raise ValueError("length_cutoff must be -1 or at least 0")
        if self.bestn < 0 or self.min_len < 0:
            raise ValueError("bestn and min_len can't be negative")


def as_bool(text: object) -> bool:
    """A setting's yes or no; whole numbers are truth values; anything else raises."""
    if isinstance(text, bool | int):
        return bool(text)
    word = str(text).strip()
    if word in YES.split():
        return True
    if word in NO.split() or word == "":
        return False
    try:
        return bool(int(word))
    except ValueError:
        raise ValueError(f"neither yes nor no: {text!r}") from None


def from_mapping(given: Mapping[str, object]) -> AssemblyConfig:
    """A config from texts; an unknown key raises."""
    known = {f.name: f for f in fields(AssemblyConfig)}
    unknown = sorted(set(given) - set(known))
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    kinds = {"int": int, "float": float, "bool": as_bool}
    return AssemblyConfig(**{k: kinds[str(known[k].type)](v) for k, v in given.items()})


def check_sections(config: Mapping[str, object]) -> None:
    """Sections must be General, job.defaults or job.step.<name>."""
    for name in config:
        if name not in SECTIONS[:2] and not name.startswith(SECTIONS[2] + "."):
            raise ValueError(f"unknown section {name!r}")


def lower_keys(value: object) -> object:
    """Nested mappings with lower-case keys; keys that fall together raise."""
    if not isinstance(value, Mapping):
        return value
    out: dict = {}
    for k, v in value.items():
        key = k.lower() if isinstance(k, str) else k
        if key in out:
            raise ValueError(f"two keys are the same in lower case: {k!r}")
        out[key] = lower_keys(v)
    return out


def dashed_flags(options: str) -> str:
    """Underscores inside long flags become dashes; values stay."""
    return re.sub(r"(?<!\S)--[A-Za-z][\w-]*", lambda m: m[0].replace("_", "-"), options)


def current_flags(options: str) -> str:
    """Old flags of the pair aligner by their present names."""
    return re.sub(r"(?<!\S)-deg", "-D", re.sub(r"(?<!\S)-dal", "-B", options))
