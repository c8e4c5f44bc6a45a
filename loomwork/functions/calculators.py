"""Row calculators: per-row functions on structures, run over Arrow batches, with failures as rows.

A calculator names its input columns, its output columns with their types, and calculates one row. Whatever it raises
becomes a row with ``success`` false and the message, so a bad structure never ends a job. Calculators are pickled to the
executors; those that need a chemistry toolkit import it there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import ClassVar

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.config import Config


class Calculator:
    """Base of all calculators; subclasses set the columns and implement ``calculate``."""

    inputs: ClassVar[tuple[str, ...]] = ()
    outputs: ClassVar[dict[str, str]] = {}

    def calculate(self, *values) -> tuple:
        raise NotImplementedError

    def single(self, *values) -> tuple:
        """The outputs of one row, then success and error_message."""
        try:
            return (*self.calculate(*values), True, None)
        except Exception as e:  # noqa: BLE001
            return (*[None] * len(self.outputs), False, str(e) or type(e).__name__)


def apply(df: DataFrame, calculator: Calculator) -> DataFrame:
    """``df`` with the calculator's outputs, ``success`` and ``error_message``; columns of these names are replaced."""
    added = calculator.outputs | {"success": "boolean", "error_message": "string"}
    kept = [c for c in df.columns if c not in added or c in calculator.inputs]
    passed = [c for c in kept if c not in added]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [calculator.single(*v) for v in zip(*(batch[c] for c in calculator.inputs))]
            out = batch[passed].copy()
            for i, name in enumerate(added):
                out[name] = pd.Series([r[i] for r in rows], index=batch.index, dtype=object)
            yield out

    types = {f.name: f.dataType.simpleString() for f in df.schema} | added
    return df.select(*kept).mapInPandas(run, ", ".join(f"`{n}` {types[n]}" for n in [*passed, *added]))


def split_success(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(processed, failed); a null success has failed."""
    ok = F.coalesce("success", F.lit(False))
    return df.filter(ok), df.filter(~ok)


def toolkit():
    """The chemistry toolkit, an optional plug-in."""
    try:
        from rdkit import Chem
    except ImportError as e:
        raise RuntimeError("structure calculators need RDKit on the executors") from e
    return Chem


@dataclass
class Standardizer(Calculator):
    """canonical_smiles of the neutral parent structure; fails for structures of ``max_atoms`` atoms or more."""

    max_atoms: int = 100
    stereo: bool = False
    max_tautomers: int = 256

    inputs: ClassVar = ("smiles",)
    outputs: ClassVar = {"canonical_smiles": "string"}

    def calculate(self, smiles) -> tuple:
        if smiles is None:
            raise ValueError("no structure")
        chem = toolkit()
        from rdkit.Chem.MolStandardize import rdMolStandardize as std

        mol = chem.MolFromSmiles(smiles)
        if mol is None:
            raise ValueError(f"could not parse {smiles}")
        if mol.GetNumAtoms() >= self.max_atoms:
            raise ValueError(f"{mol.GetNumAtoms()} atoms")
        mol = std.IsotopeParent(std.ChargeParent(mol))
        if not self.stereo:
            chem.RemoveStereochemistry(mol)
        tautomers = std.TautomerEnumerator()
        tautomers.SetMaxTautomers(self.max_tautomers)
        mol = std.Cleanup(tautomers.Canonicalize(mol))
        return (chem.MolToSmiles(chem.MolFromSmiles(chem.MolToSmiles(mol))),)


@dataclass
class Fingerprint(Calculator):
    """fp_feat and fp_val: the counted features of circular neighbourhoods, hashed to ``size`` numbers."""

    radius: int = 3
    size: int = 32000
    binarized: bool = True

    inputs: ClassVar = ("canonical_smiles",)
    outputs: ClassVar = {"fp_feat": "array<int>", "fp_val": "array<int>"}

    def calculate(self, smiles) -> tuple:
        chem = toolkit()
        from rdkit.Chem import rdFingerprintGenerator as gen

        found = gen.GetMorganGenerator(radius=self.radius, fpSize=self.size).GetCountFingerprint(chem.MolFromSmiles(smiles)).GetNonzeroElements()
        feats = sorted(found)
        return feats, [1 if self.binarized else found[f] for f in feats]


@dataclass
class Scaffold(Calculator):
    """murcko_smiles and sn_smiles; the fold is drawn from the latter by ``keyed.keyed_folds``. Both are the plain scaffold."""

    inputs: ClassVar = ("canonical_smiles",)
    outputs: ClassVar = {"murcko_smiles": "string", "sn_smiles": "string"}

    def calculate(self, smiles) -> tuple:
        chem = toolkit()
        from rdkit.Chem.Scaffolds import MurckoScaffold

        return (chem.MolToSmiles(MurckoScaffold.GetScaffoldForMol(chem.MolFromSmiles(smiles))) or None,) * 2


def structures(t2: DataFrame, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """(structures with features and scaffold, failed ones) of (input_compound_id, smiles)."""
    failed, now = [], t2
    for step in (Standardizer(config.max_atoms), Fingerprint(size=config.fold_size), Scaffold()):
        now, bad = split_success(apply(now, step))
        failed.append(bad.select("input_compound_id", "smiles", "error_message"))
        now = now.drop("success", "error_message")
    return now, failed[0].unionByName(failed[1]).unionByName(failed[2])
