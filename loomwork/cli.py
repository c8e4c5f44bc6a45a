"""python -m loomwork.cli COMMAND: the stages of a run on files."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from loomwork.config import Config, load_parameters, load_run_parameters
from loomwork.functions import calculators
from loomwork.operators import aggregate
from loomwork.plans import pipeline
from loomwork.sources import tables

CATALOG = "catalog_assay_id double, catalog_task_id double, threshold double, threshold_method string, " + ", ".join(f"{c} double" for c in tables.EXPERTS)


def load(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Tables of CSV or Parquet files as one; of assays other columns than the schema's stay."""
    of = lambda p: tables.with_other_columns(spark, p, schema) if schema == tables.SCHEMAS["t0"] else schema
    return tables.union_tables([spark.read.parquet(p) if p.endswith(".parquet") else tables.read_input(spark, p, of(p)) for p in paths])


def table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A table that another stage wrote, as Parquet or CSV; the types of CSV are those of its values."""
    parquet = lambda p: p.endswith(".parquet") or not p.endswith(".csv")
    return tables.union_tables([spark.read.parquet(p) if parquet(p) else spark.read.csv(p, header=True, inferSchema=True) for p in paths])


def catalog_of(run: pipeline.Run, a: argparse.Namespace) -> DataFrame:
    return load(run.spark, a.catalog, CATALOG) if a.catalog else run.spark.createDataFrame([], CATALOG)


def standardize(run: pipeline.Run, a: argparse.Namespace) -> None:
    ok, failed = calculators.split_success(calculators.apply(load(run.spark, a.structures, tables.SCHEMAS["t2"]), calculators.Standardizer(run.config.max_atoms)))
    run.keep("T2_standardized", ok)
    run.keep("T2_standardized_failed", failed)


def structures(run: pipeline.Run, a: argparse.Namespace) -> None:
    run.structures(load(run.spark, a.structures, tables.SCHEMAS["t2"]), a.folding or "scaffold")


def _calculated(run: pipeline.Run, a: argparse.Namespace, *steps: calculators.Calculator) -> DataFrame:
    """Standardised structures with what ``steps`` add; those that fail are kept apart."""
    now = table(run.spark, a.structures)
    for step in steps:
        now, bad = calculators.split_success(calculators.apply(now.drop("success", "error_message"), step))
        run.keep(f"T2_{type(step).__name__.lower()}_failed", bad)
    return now


def descriptors(run: pipeline.Run, a: argparse.Namespace) -> None:
    run.descriptors(_calculated(run, a, calculators.Fingerprint(size=run.config.fold_size)))


def scaffold_folds(run: pipeline.Run, a: argparse.Namespace) -> None:
    run.folds(run.keep("T2_scaffolds", _calculated(run, a, calculators.Scaffold())), "scaffold")


def lsh_folds(run: pipeline.Run, a: argparse.Namespace) -> None:
    run.vectors(run.folds(run.descriptors(_calculated(run, a, calculators.Fingerprint(size=run.config.fold_size))), "lsh"))


def aggregation(run: pipeline.Run, a: argparse.Namespace) -> None:
    t0, t1 = load(run.spark, a.assays, tables.SCHEMAS["t0"]), load(run.spark, a.values, tables.SCHEMAS["t1"])
    t5 = load(run.spark, a.vectors, tables.SCHEMAS["t5"])
    run.check_inputs(t0, t1)
    run.aggregation(tables.ingest_assays(t0), tables.ingest_values(t1), tables.ingest_vectors(t5))


def thresholds(run: pipeline.Run, a: argparse.Namespace) -> None:
    run.thresholds(table(run.spark, a.assays), table(run.spark, a.activities), catalog_of(run, a))


def classification(run: pipeline.Run, a: argparse.Namespace) -> None:
    run.classification(table(run.spark, a.tasks), table(run.spark, a.labels), table(run.spark, a.assays) if a.assays else None)


def regression(run: pipeline.Run, a: argparse.Namespace) -> None:
    run.regression(table(run.spark, a.assays), table(run.spark, a.activities))


def matrices(run: pipeline.Run, a: argparse.Namespace) -> None:
    rows = [table(run.spark, x) for x in (a.classification_rows, a.regression_rows, a.classification_tasks, a.regression_tasks)]
    found = run.matrices(load(run.spark, a.features, tables.SCHEMAS["t6"]), *rows)
    if a.delivery:
        run.deliver(found, a.delivery, a.auxiliary or "no")


def activity(run: pipeline.Run, a: argparse.Namespace) -> None:
    spark = run.spark
    t0, t1 = load(spark, a.assays, tables.SCHEMAS["t0"]), load(spark, a.values, tables.SCHEMAS["t1"])
    t5, t6 = load(spark, a.vectors, tables.SCHEMAS["t5"]), load(spark, a.features, tables.SCHEMAS["t6"])
    found = run.activity(t0, t1, t5, t6, catalog_of(run, a))
    if a.delivery:
        run.deliver(found, a.delivery, a.auxiliary or "no")


def training(run: pipeline.Run, a: argparse.Namespace) -> None:
    structures(run, a)
    a.vectors, a.features = [f"{run.path}/results/T5"], [f"{run.path}/results/T6"]
    a.vectors, a.features = ([f"{p}/*.parquet" for p in x] for x in (a.vectors, a.features))
    activity(run, a)


def prediction(run: pipeline.Run, a: argparse.Namespace) -> None:
    x, failed, rows = pipeline.prediction(load(run.spark, a.structures, tables.SCHEMAS["t2"]), run.config)
    for name, df in (("X", x), ("failed", failed), ("rows", rows)):
        run.keep(name, df)


COMMANDS = {
    "standardize_smiles": (standardize, ("structures",)),
    "calculate_descriptors": (descriptors, ("structures",)),
    "assign_fold": (scaffold_folds, ("structures",)),
    "assign_lsh_fold": (lsh_folds, ("structures",)),
    "prepare_structure_data": (structures, ("structures",)),
    "agg_activity_data": (aggregation, ("assays", "values", "vectors")),
    "apply_thresholding": (thresholds, ("assays", "activities")),
    "filter_classification_data": (classification, ("tasks", "labels")),
    "filter_regression_data": (regression, ("assays", "activities")),
    "make_matrices": (matrices, ("features", "classification_rows", "regression_rows", "classification_tasks", "regression_tasks")),
    "prepare_activity_data": (activity, ("assays", "values", "vectors", "features")),
    "prepare_4_training": (training, ("structures", "assays", "values")),
    "prepare_4_prediction": (prediction, ("structures",)),
}
FILES = ("structures", "assays", "values", "vectors", "features", "catalog", "activities", "tasks", "labels", "classification_rows", "regression_rows", "classification_tasks", "regression_tasks")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomwork", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    for name, (_, needed) in COMMANDS.items():
        c = commands.add_parser(name)
        for n in FILES:
            c.add_argument(f"--{n}", nargs="+", required=False, help="needed" if n in needed else None)
        c.add_argument("--folding", choices=pipeline.FOLDINGS)
        c.add_argument("--auxiliary", choices=pipeline.DATA_SETS)
        c.add_argument("--overwrite", action="store_true", default=None)
        for n in ("output", "name", "parameters", "key", "delivery", "run_parameters", "reference", "reference_hash"):
            c.add_argument(f"--{n}")
    copy = commands.add_parser("make_delivery")
    copy.add_argument("--source", required=True)
    copy.add_argument("--target", required=True)
    copy.add_argument("--auxiliary", choices=pipeline.DATA_SETS, default="no")
    copy.add_argument("--phase", choices=pipeline.PHASES)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    if a.command == "make_delivery":
        return pipeline.copy_delivery(a.source, a.target, a.auxiliary, a.phase)
    if a.run_parameters:
        given = load_run_parameters(a.run_parameters, {k for k in vars(a) if k not in ("command", "run_parameters")})
        for k, v in given.items():
            if getattr(a, k) is None:
                setattr(a, k, v)
    command, needed = COMMANDS[a.command]
    if missing := [n for n in (*needed, "output", "name") if not getattr(a, n)]:
        parser().error(f"{a.command} needs " + ", ".join(f"--{n}" for n in missing))
    config = load_parameters(a.parameters, a.key) if a.parameters else Config()
    if spark is None:
        spark = SparkSession.builder.getOrCreate()
    run = pipeline.Run(spark, str(Path(a.output)) if "://" not in a.output else a.output, a.name, config, bool(a.overwrite))
    if a.reference:
        if not (a.parameters and a.key):
            parser().error("--reference needs --parameters and --key")
        own = pipeline.reference_hash(a.reference, *(json.loads(Path(p).read_text()) for p in (a.parameters, a.key)))
        pipeline.compare_reference_hash(own, a.reference_hash)
        run.report["reference_hash"] = own
    command(run, a)
    run.finish({k: v for k, v in vars(a).items() if v is not None})


if __name__ == "__main__":
    main()
