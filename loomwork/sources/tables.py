"""Schemas of the tables, reading and writing them, and what is cleaned at ingest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The schemas of the input tables.
SCHEMAS = {
    "t0": """input_assay_id bigint, assay_type string, use_in_regression boolean, is_binary boolean, expert_threshold_1 double,
        expert_threshold_2 double, expert_threshold_3 double, expert_threshold_4 double, expert_threshold_5 double,
        direction string, catalog_assay_id double, parent_assay_id double""",
    "t1": "input_compound_id bigint, input_assay_id bigint, standard_qualifier string, standard_value double",
    "t2": "input_compound_id string, smiles string",
    "t5": "input_compound_id bigint, fold_id double, descriptor_vector_id double",
    "t6": "descriptor_vector_id bigint, fp_feat string, fp_val string, fold_id int",
}
EXPERTS = [f"expert_threshold_{i}" for i in range(1, 6)]
ASSAY = [c.split()[0] for c in SCHEMAS["t0"].split(",")]


def read_csv(spark: SparkSession, path: str, schema: str, delimiter: str = ",", rows: int | None = None) -> DataFrame:
    """A CSV file with a header under an explicit schema; ``inf`` and ``-inf`` are numbers; at most ``rows`` rows if given."""
    options = {"header": True, "sep": delimiter, "positiveInf": "inf", "negativeInf": "-inf", "enforceSchema": False}
    df = spark.read.schema(schema).options(**options).csv(path)
    return df if rows is None else df.limit(rows)


def read_input(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same; an empty file is an error."""
    df = read_csv(spark, path, schema)
    if df.isEmpty():
        raise ValueError(f"{path} has no rows")
    return df


def with_other_columns(spark: SparkSession, path: str, schema: str, delimiter: str = ",") -> str:
    """The schema of a CSV file in the order of its header; columns that ``schema`` lacks are strings."""
    known = {c.split()[0]: c.split()[1] for c in schema.split(",")}
    names = spark.read.options(header=True, sep=delimiter).csv(path).columns
    return ", ".join(f"`{n}` {known.get(n, 'string')}" for n in [*names, *(k for k in known if k not in names)])


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables; columns that some lack are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, single: bool = False) -> None:
    """A folder of CSV files with a header; ``single`` makes one file, for tables that fit one task."""
    out = df if columns is None else df.select(*columns)
    (out.coalesce(1) if single else out).write.mode("errorifexists").option("header", True).csv(path)


def number_or_null(c: Column) -> Column:
    """NaN as null; infinite values stay."""
    return F.when(~F.isnan(c), c)


def ingest_assays(t0: DataFrame) -> DataFrame:
    """T0 in its types, one row per assay: NaN is null, directions in lower case; the first of repeated rows by all columns.

    Columns that are not the schema's, such as ``META*``, stay as they are, after the others.
    """
    doubles = [*EXPERTS, "catalog_assay_id", "parent_assay_id"]
    rows = t0.select(
        F.col("input_assay_id").cast("bigint").alias("input_assay_id"),
        F.trim("assay_type").alias("assay_type"),
        "use_in_regression",
        "is_binary",
        *[number_or_null(F.col(c).cast("double")).alias(c) for c in doubles],
        F.lower(F.trim("direction")).alias("direction"),
        *[quoted(c) for c in t0.columns if c not in ASSAY],
    )
    first = F.min(F.struct(*[quoted(c) for c in rows.columns if c != "input_assay_id"])).alias("r")
    return rows.filter(F.col("input_assay_id").isNotNull()).groupBy("input_assay_id").agg(first).select("input_assay_id", "r.*")


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def known_columns(t0: DataFrame) -> DataFrame:
    """T0, also the updated one, without the columns that only go along."""
    return t0.select(*[c for c in t0.columns if c in ASSAY or c == "variance_quorum_OK"])


def with_assay_columns(df: DataFrame, t0: DataFrame) -> DataFrame:
    """``df`` left joined on input_assay_id with the columns of T0 that it lacks, but for expert thresholds."""
    more = [c for c in t0.columns if c not in df.columns and not c.startswith("expert_threshold")]
    return df.join(t0.select("input_assay_id", *[quoted(c) for c in more]), "input_assay_id", "left") if more else df


def ingest_values(t1: DataFrame) -> DataFrame:
    """T1 in its types: NaN is null, qualifiers without white space, blank and ``n/a`` as null.

    ``seen`` orders the rows of one replicate where values tie: the times of loading and measuring if there are any.
    """
    q = F.trim("standard_qualifier")
    times = [F.col(c) for c in ("loaded_at", "measured_at") if c in t1.columns]
    return t1.select(
        F.col("input_compound_id").cast("bigint").alias("input_compound_id"),
        F.col("input_assay_id").cast("bigint").alias("input_assay_id"),
        F.when(~F.lower(q).isin("", "n/a"), q).alias("standard_qualifier"),
        number_or_null(F.col("standard_value").cast("double")).alias("standard_value"),
        (F.struct(*times) if times else F.lit(0)).alias("seen"),
    )


def ingest_vectors(t5: DataFrame) -> DataFrame:
    """T5 in its types, without repeats and without rows that lack a compound, vector or fold (null or negative)."""
    rows = t5.select(
        F.col("input_compound_id").cast("bigint").alias("input_compound_id"),
        F.col("descriptor_vector_id").cast("bigint").alias("descriptor_vector_id"),
        F.col("fold_id").cast("int").alias("fold_id"),
    )
    return rows.dropna().filter(F.col("fold_id") >= 0).distinct()
