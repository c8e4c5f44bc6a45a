"""The stages of a run in order, each table written once, with the counts that its report holds."""

from __future__ import annotations

import datetime
import hashlib
import json
import shutil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork import __version__
from loomwork.config import AUXILIARY_TYPES, Config
from loomwork.functions import calculators, keyed
from loomwork.operators import aggregate, checks, features, ids, matrix, packed, quorum, threshold
from loomwork.sources import tables

# The files of each data set of a delivery, and the sets with and without auxiliary data.
DELIVERY = {
    "cls": {"x": "cls_T11_x.npz", "folds": "cls_T11_fold_vector.npy", "y_cls": "cls_T10_y.npz", "cls_weights": "cls_weights.csv"},
    "reg": {"x": "reg_T11_x.npz", "folds": "reg_T11_fold_vector.npy", "y_reg": "reg_T10_y.npz", "censor": "reg_T10_censor_y.npz", "reg_weights": "reg_weights.csv"},
    "hyb": {
        "x": "hyb_T11_x.npz", "folds": "hyb_T11_fold_vector.npy", "y_cls": "hyb_cls_T10_y.npz", "cls_weights": "hyb_cls_weights.csv",
        "y_reg": "hyb_reg_T10_y.npz", "censor": "hyb_reg_T10_censor_y.npz", "reg_weights": "hyb_reg_weights.csv",
    },
    "clsaux": {"x": "clsaux_T11_x.npz", "folds": "clsaux_T11_fold_vector.npy", "y_cls": "clsaux_T10_y.npz", "cls_weights": "clsaux_weights.csv"},
}
DATA_SETS = {"no": ("wo_aux", ("cls", "reg", "hyb")), "yes": ("w_aux", ("clsaux",))}
PHASES = ("phase1", "phase2", "phase3")


# The column that each way of folding draws from.
FOLDINGS = {"scaffold": "sn_smiles", "lsh": "lsh"}


class Run:
    """A run writes its tables below ``output/name``; tables that exist there are an error, or replaced with ``overwrite``."""

    def __init__(self, spark: SparkSession, output: str, name: str, config: Config = Config(), overwrite: bool = False):
        self.spark, self.path, self.config = spark, f"{output}/{name}", config
        self.mode = "overwrite" if overwrite else "errorifexists"
        self.report: dict = {"version": __version__, "started": datetime.datetime.now().isoformat(timespec="seconds"), "rows": {}}

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Writes a table, counts its rows and reads it back: later stages start from the file."""
        path = f"{self.path}/results/{name}"
        df.write.mode(self.mode).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.report["rows"][name] = out.count()
        return out

    def check(self, found: DataFrame) -> None:
        """Ends the run when a check of level ERROR fails; checks have a few rows."""
        failed = found.filter("level = 'ERROR' AND n > 0").collect()
        if failed:
            raise ValueError("; ".join(f"{r.check}: {r.n}" for r in failed))

    def check_inputs(self, t0: DataFrame, t1: DataFrame) -> None:
        """Ends the run at wrong rows of T0 or T1, or when more assays are measured than T0 has; reports types and numbers.

        Whether auxiliary data is expected is told from whether there is any.
        """
        self.check(checks.check_assays(t0).unionByName(checks.check_values(t1)))
        auxiliary = not t0.filter(F.trim("assay_type").isin(*AUXILIARY_TYPES)).isEmpty()
        types = checks.check_types(t0.withColumn("assay_type", F.trim("assay_type")), auxiliary).filter("level = 'WARNING'").collect()
        sizes = checks.check_sizes(t0, t1, "input_assay_id").collect()[0]
        self.report["checks"] = [f"assay_type {r.assay_type}: {r.n}" for r in types] + [f"input_assay_id: {sizes.n_left} in T0, {sizes.n_right} in T1, {sizes.level}"]
        if sizes.level == "ERROR":
            raise ValueError(f"input_assay_id: {sizes.n_left} in T0, {sizes.n_right} in T1")

    def structures(self, t2: DataFrame, folding: str = "scaffold") -> tuple[DataFrame, DataFrame]:
        """T5 and T6 from structures, with folds by scaffold or ``lsh``; needs the chemistry plug-in."""
        if folding not in FOLDINGS:
            raise ValueError(f"folding must be one of {', '.join(FOLDINGS)}, not {folding}")
        self.check(checks.check_structures(t2))
        done, failed = calculators.structures(t2, self.config)
        self.keep("T2_failed", failed)
        return self.vectors(self.folds(self.descriptors(done), folding))

    def descriptors(self, done: DataFrame) -> DataFrame:
        """T2_descriptors from structures with features: the LSH bits, and then the features scrambled."""
        bits = keyed.bit_string(F.col("fp_feat").cast("array<bigint>"), self.config.lsh_bits)
        return self.keep("T2_descriptors", keyed.scramble(done.withColumn("lsh", bits), "fp_feat", self.config.key, self.config.fold_size))

    def folds(self, descriptors: DataFrame, folding: str) -> DataFrame:
        """T2_folds: structures with the fold that is drawn from their scaffold or LSH bits."""
        folds = keyed.keyed_folds(descriptors, FOLDINGS[folding], self.config.key, self.config.nfolds).drop("lsh")
        lists = {c: features.to_json_list(F.col(c)) for c in ("fp_feat", "fp_val") if c in folds.columns}
        return self.keep("T2_folds", folds.withColumns(lists))

    def vectors(self, folds: DataFrame) -> tuple[DataFrame, DataFrame]:
        """T5 and T6."""
        t5, t6, duplicates = ids.descriptor_ids(folds)
        self.keep("T2_duplicates", duplicates)
        return self.keep("T5", t5), self.keep("T6", t6)

    def count(self, name: str, df: DataFrame, *columns: str) -> None:
        """Reports how many different values the columns of a table have."""
        found = df.agg(*[F.countDistinct(c).alias(c) for c in columns]).collect()[0]
        self.report.setdefault("distinct", {})[name] = found.asDict()

    def aggregation(self, t0: DataFrame, t1: DataFrame, t5: DataFrame) -> tuple[DataFrame, DataFrame]:
        """T0_upd and T4r of cleaned assays, measurements and vectors, and the rows that fail."""
        r = aggregate.Replicates(t0, t1, t5, self.config).settle(self.keep)
        for name, df in {
            "failed_range_T1": r.rejected("range"),
            "failed_binary_T1": r.rejected("binary"),
            "failed_aggr_T1": r.failed_aggregation(),
            "failed_std_T1": r.failed_std(),
            "duplicates_T1": r.duplicates(),
        }.items():
            self.keep(name, df)
        t4r, t0u = self.keep("T4r", r.t4r()), self.keep("T0_upd", r.t0_updated())
        self.count("T4r", t4r, "input_assay_id", "descriptor_vector_id")
        return t0u, t4r

    def thresholds(self, t0u: DataFrame, t4r: DataFrame, t_cat: DataFrame) -> tuple[DataFrame, DataFrame]:
        """T3c and T4c, and the values without a label."""
        t3c = self.keep("T3c", threshold.tasks(t0u, t4r, t_cat, self.config))
        every = threshold.labels(t3c, t4r)
        self.keep("T4c_failed", every.filter("class_label IS NULL"))
        return t3c, self.keep("T4c", every.filter("class_label IS NOT NULL"))

    def _training(self, kind: str, key: str, found: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
        rows, left, repeated = found
        rows = self.keep(f"T10{kind}", rows)
        self.keep(f"filtered_out_T4{kind}", left)
        self.keep(f"duplicates_T4{kind}", repeated)
        self.count(f"T10{kind}", rows, key, "descriptor_vector_id")
        return rows

    def classification(self, t3c: DataFrame, t4c: DataFrame, t0: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """T8c, with the other columns of T0 where it is given, and T10c."""
        t8c = quorum.classification_tasks(t3c, t4c, self.config)
        t8c = self.keep("T8c", t8c if t0 is None else tables.with_assay_columns(t8c, t0))
        return t8c, self._training("c", quorum.CONT_TASK, quorum.training_rows(t4c, t8c))

    def regression(self, t0u: DataFrame, t4r: DataFrame) -> tuple[DataFrame, DataFrame]:
        """T8r and T10r."""
        t8r = self.keep("T8r", quorum.regression_tasks(t0u, t4r, self.config))
        return t8r, self._training("r", quorum.CONT_REGRESSION, quorum.regression_rows(t4r, t8r))

    def matrices(self, t6: DataFrame, t10c: DataFrame, t10r: DataFrame, t8c: DataFrame, t8r: DataFrame) -> dict[str, DataFrame]:
        """Matrices, fold vector and weights."""
        # Of a vector with several texts the first by fold and texts stays.
        texts = ["descriptor_vector_id", "fold_id", "fp_feat", "fp_val"]
        first = ids.first_of(t6.select(*texts).filter("descriptor_vector_id IS NOT NULL"), texts[:1], texts[1:])
        arrays = packed.unpack(first, ["descriptor_vector_id", "fold_id"], ["fp_feat", "fp_val"])
        t6c, t10c, t10r = (self.keep(n, d) for n, d in zip(("T6_cont", "T10c_cont", "T10r_cont"), matrix.continuous(arrays, t10c, t10r)))
        out = {
            "x": self.keep("X", matrix.feature_matrix(t6c)),
            "folds": self.keep("folds", matrix.fold_vector(t6c)),
            "y_cls": self.keep("Y_cls", matrix.label_matrix(t10c)),
            "y_reg": self.keep("Y_reg", matrix.value_matrix(t10r)),
            "censor": self.keep("censor", matrix.censor_mask(t10r)),
            "cls_weights": self.keep("cls_weights", matrix.classification_weights(t8c)),
            "reg_weights": self.keep("reg_weights", matrix.regression_weights(t8r)),
        }
        censored, values = out["censor"].filter("value <> 0").count(), self.report["rows"]["Y_reg"]
        self.report["fraction_censored_reg"] = round(100 * censored / values, 2) if values else None
        return out

    def activity(self, t0: DataFrame, t1: DataFrame, t5: DataFrame, t6: DataFrame, t_cat: DataFrame) -> dict[str, DataFrame]:
        """All tables from assays, measurements and vectors to matrices and weights."""
        self.check_inputs(t0, t1)
        t0, t1, t5 = tables.ingest_assays(t0), tables.ingest_values(t1), tables.ingest_vectors(t5)
        t0u, t4r = self.aggregation(t0, t1, t5)
        t3c, t4c = self.thresholds(t0u, t4r, t_cat)
        t8c, t10c = self.classification(t3c, t4c, t0)
        t8r, t10r = self.regression(t0u, t4r)
        return {"T8c": t8c, "T8r": t8r, "T10c": t10c, "T10r": t10r} | self.matrices(t6, t10c, t10r, t8c, t8r)

    def deliver(self, tables_: dict[str, DataFrame], folder: str | Path, auxiliary: str = "no") -> None:
        """The matrices and weights as the files that training reads, one folder for each data set of ``DATA_SETS``.

        Where one of them is too large for a single file, all matrices and vectors are folders of shards of the same
        rows, which tasks write; ``folder`` then has to be one that all executors share.
        """
        below, sets = DATA_SETS[auxiliary]
        at = {kind: Path(folder) / below / kind for kind in sets}
        for path in at.values():
            path.mkdir(parents=True)
        paths = lambda what: [at[kind] / DELIVERY[kind][what] for kind in sets if what in DELIVERY[kind]]
        n = matrix.extent(tables_["folds"], "row")
        bits = matrix.row_bits([tables_[t] for t in ("x", "y_cls", "y_reg", "censor")], n)
        width = {kind: matrix.extent(tables_[f"{kind}_weights"], "task_id") for kind in ("cls", "reg")}
        sizes = {"x": (self.config.fold_size, "int8"), "y_cls": (width["cls"], "float32"), "y_reg": (width["reg"], "float32"), "censor": (width["reg"], "int8")}
        for what, (columns, kind) in sizes.items():
            if paths(what):
                matrix.save_npz(tables_[what], paths(what), (n, columns), kind, bits)
        matrix.save_npy(tables_["folds"], paths("folds"), "fold_id", n, bits)
        for what in ("cls_weights", "reg_weights"):
            for path in paths(what):
                matrix.save_csv(tables_[what], path, "task_id")

    def finish(self, arguments: dict) -> None:
        """The arguments and the report as JSON beside the tables, where these are on this machine."""
        self.report["finished"] = datetime.datetime.now().isoformat(timespec="seconds")
        at = Path(self.path.removeprefix("file:"))
        at.mkdir(parents=True, exist_ok=True)
        (at / "run_parameters.json").write_text(json.dumps(arguments, indent=1, sort_keys=True, default=str))
        (at / "run_report.json").write_text(json.dumps(self.report, indent=1))


def copy_delivery(source: str | Path, target: str | Path, auxiliary: str = "no", phase: str | None = None) -> None:
    """Copies each data set of a delivery, to a folder of its name and phase; missing or additional files are an error."""
    below, sets = DATA_SETS[auxiliary]
    for kind in sets:
        at, wanted = Path(source) / below / kind, set(DELIVERY[kind].values())
        there = {p.name.removesuffix(matrix.SHARDED) if p.is_dir() else p.name: p for p in at.iterdir()}
        if set(there) != wanted or len(there) != len(list(at.iterdir())):
            raise ValueError(f"{kind}: missing {sorted(wanted - set(there))}, additional {sorted(set(there) - wanted)}")
        for folder in (p for p in there.values() if p.is_dir()):
            files = {"manifest.json", *(s["file"] for s in json.loads((folder / "manifest.json").read_text())["shards"])}
            if files != (found := {p.name for p in folder.iterdir()}):
                raise ValueError(f"{folder.name}: missing {sorted(files - found)}, additional {sorted(found - files)}")
        shutil.copytree(at, Path(target) / (f"{kind}_{phase}" if phase else kind))


def reference_hash(table: str | Path, parameters: dict, key: dict) -> str:
    """The hash that two sites compare before a run: of the blocks of a reference table, the parameters, the key and the version."""
    whole = hashlib.sha256()
    add = lambda content: whole.update(hashlib.sha256(content).hexdigest().encode())
    with open(table, "rb") as f:
        while block := f.read(4096):
            add(block)
    for d in (parameters, key):
        add(json.dumps(d, sort_keys=True, default=str).encode())
    add(__version__.encode())
    return whole.hexdigest()


def compare_reference_hash(own: str, wanted: str | Path | None) -> None:
    """Ends the run unless the file ``wanted`` names the same hash; without a file nothing is compared."""
    if wanted is not None and json.loads(Path(wanted).read_text())["unit_test_hash"] != own:
        raise ValueError("the reference hash differs: other parameters, key, version or reference structures")


def prediction(t2: DataFrame, config: Config = Config()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(X, failed structures, compound to row) of new structures, without folds."""
    ok, failed = calculators.split_success(calculators.apply(t2, calculators.Standardizer(config.max_atoms)))
    prints, bad = calculators.split_success(calculators.apply(ok.drop("success", "error_message"), calculators.Fingerprint(size=config.fold_size)))
    columns = ["input_compound_id", "smiles", "error_message"]
    rows = ids.with_dense_id(keyed.scramble(prints, "fp_feat", config.key, config.fold_size), ["input_compound_id"], matrix.ROW)
    return matrix.feature_matrix(rows), failed.select(*columns).unionByName(bad.select(*columns)), rows.select("input_compound_id", matrix.ROW)
