"""Parameters of a run, as frozen values that are passed on explicitly."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path

# Assay types, and the default parameters.
ASSAY_TYPES = ("ADME", "NON-CATALOG-PANEL", "CATALOG-PANEL", "OTHER", "AUX_HTS", "AUX_PL")
AUXILIARY_TYPES = ("AUX_HTS", "AUX_PL")
RANGED_TYPES = ("ADME", "NON-CATALOG-PANEL", "OTHER", "AUX_HTS")
ROUNDED_TYPES = ("OTHER", "NON-CATALOG-PANEL")
RANGES = {"NON-CATALOG-PANEL": (3.0, 10.0), "CATALOG-PANEL": (3.0, 10.0), "OTHER": (3.0, 10.0), "AUX_HTS": (-10.0, 10.0), "ADME": (-1e12, 1e12)}
FIXED_TRIALS = (8.0, 7.0, 6.0, 5.0, 4.7, 4.4)
LSH_BITS = (26490, 8094, 25216, 21099, 2487, 2991, 9639, 17984, 24189, 8272, 1787, 31834, 11815, 8648, 27066, 17552)


def _each(*types: str, **quorum: int) -> dict[str, dict[str, int]]:
    return {t: quorum for t in types}


_MAIN = ("ADME", "NON-CATALOG-PANEL", "OTHER")


@dataclass(frozen=True)
class Config:
    """All parameters; quorums are by assay type, and a type without an entry never passes."""

    ranges: Mapping[str, tuple[float, float]] = field(default_factory=lambda: dict(RANGES))
    min_std: float = 1e-12
    training_regression: Mapping = field(default_factory=lambda: _each(*_MAIN, "AUX_HTS", num_total=50, num_uncensored_total=25))
    training_classification: Mapping = field(
        default_factory=lambda: _each(*_MAIN, num_active_total=25, num_inactive_total=25) | _each("AUX_HTS", "AUX_PL", num_active_total=10, num_inactive_total=10000)
    )
    catalog: Mapping = field(default_factory=lambda: {"num_total": 400, "num_active_fold_min": 10, "num_inactive_fold_min": 10})
    evaluation_regression: Mapping = field(default_factory=lambda: _each(*_MAIN, "AUX_HTS", "AUX_PL", num_fold_min=50, num_uncensored_fold_min=25))
    evaluation_classification: Mapping = field(default_factory=lambda: _each(*_MAIN, "AUX_HTS", num_active_fold_min=10, num_inactive_fold_min=10))
    initial_weights: Mapping = field(default_factory=lambda: {"AUX_HTS": 0.1, "AUX_PL": 0.1})
    hts_threshold: float = 3.0
    knock_in_barrier: float = 0.05
    min_evaluation_std: float = 0.5
    fold_size: int = 32000
    nfolds: int = 5
    lsh_bits: tuple[int, ...] = LSH_BITS
    max_atoms: int = 100
    key: str = "loomwork"

    def __post_init__(self):
        if not 0.0 <= self.knock_in_barrier <= 1.0:
            raise ValueError(f"knock_in_barrier must lie between 0 and 1, not {self.knock_in_barrier}")


def load_parameters(path: str | Path, key_path: str | Path | None = None) -> Config:
    """A Config from a JSON file of parameters in the published layout, and one with the key."""
    p = json.loads(Path(path).read_text())
    given: dict = {}
    if "credibility_range" in p:
        ranges = dict(p["credibility_range"])
        given["min_std"] = ranges.pop("std", {"min": 1e-12})["min"]
        given["ranges"] = {k: (v["min"], v["max"]) for k, v in ranges.items()}
    for part in ("training", "evaluation"):
        quorum = p.get(f"{part}_quorum", {})
        for kind in ("regression", "classification"):
            if kind in quorum:
                given[f"{part}_{kind}"] = quorum[kind]
        if "CATALOG-PANEL" in quorum and part == "training":
            given["catalog"] = quorum["CATALOG-PANEL"]
    for name, *where in (
        ("initial_weights", "initial_task_weights"),
        ("hts_threshold", "global_thresholds", "AUX_HTS"),
        ("knock_in_barrier", "censored_downweighting", "knock_in_barrier"),
        ("min_evaluation_std", "regression_evaluation_task_filter", "min_standard_deviation"),
        ("fold_size", "fingerprint", "fold_size"),
        ("nfolds", "scaffold_folding", "nfolds"),
        ("lsh_bits", "lsh", "bits"),
        ("max_atoms", "standardization", "max_num_atoms"),
    ):
        at = p
        for w in where:
            at = at.get(w) if isinstance(at, dict) else None
        if at is not None:
            given[name] = tuple(at) if isinstance(at, list) else at
    if key_path is not None:
        given["key"] = json.loads(Path(key_path).read_text())["key"]
    return Config(**given)


def load_run_parameters(path: str | Path, known: set[str]) -> dict:
    """Run parameters of a JSON file; names that no option has are an error."""
    given = json.loads(Path(path).read_text())
    if unknown := set(given) - known:
        raise ValueError(f"unknown run parameters: {', '.join(sorted(unknown))}")
    return given


def names() -> list[str]:
    return [f.name for f in fields(Config)]
