"""Checks of input tables; each gives rows (check, level, n) that tell how many cases fail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.config import ASSAY_TYPES, AUXILIARY_TYPES
from loomwork.operators.ids import duplicated


def failures(df: DataFrame, rules: dict[str, tuple[str, object]]) -> DataFrame:
    """(check, level, n) of rules name -> (level, condition of failing rows), in one pass; null conditions do not fail."""
    counts = df.agg(*[F.count_if(F.coalesce(rule, F.lit(False))).alias(f"n{i}") for i, (_, rule) in enumerate(rules.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.lit(level).alias("level"), F.col(f"n{i}").alias("n")) for i, (n, (level, _)) in enumerate(rules.items())])
    return counts.select(F.inline(rows))


def repeated_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows that are more than their distinct keys; rows with a null key count too."""
    return df.agg((F.count(F.lit(1)) - F.countDistinct(key)).alias("n")).select(F.lit(name).alias("check"), F.lit("ERROR").alias("level"), "n")


def check_assays(t0: DataFrame) -> DataFrame:
    """T0: known types, flags present, catalog ids only and once on catalog assays, unique ids, binary where required."""
    kind, catalog = F.col("assay_type"), F.col("catalog_assay_id")
    rules = {
        "assay_type unknown": ("ERROR", ~kind.isin(*ASSAY_TYPES)),
        "assay_type null": ("ERROR", kind.isNull()),
        "use_in_regression null": ("ERROR", F.col("use_in_regression").isNull()),
        "is_binary null": ("ERROR", F.col("is_binary").isNull()),
        "catalog id on other type": ("ERROR", catalog.isNotNull() & (kind != "CATALOG-PANEL")),
        "AUX_PL not binary": ("ERROR", (kind == "AUX_PL") & ~F.col("is_binary")),
        "binary in regression": ("WARNING", F.col("is_binary") & F.col("use_in_regression")),
    }
    repeated = repeated_keys(t0.filter((kind == "CATALOG-PANEL") & catalog.isNotNull()), "catalog_assay_id", "catalog_assay_id repeated")
    return failures(t0, rules).unionByName(repeated_keys(t0, "input_assay_id", "input_assay_id repeated")).unionByName(repeated)


def check_values(t1: DataFrame) -> DataFrame:
    """T1: ids and finite values present."""
    v = F.col("standard_value")
    rules = {
        "input_assay_id null": ("ERROR", F.col("input_assay_id").isNull()),
        "input_compound_id null": ("ERROR", F.col("input_compound_id").isNull()),
        "standard_value null": ("ERROR", v.isNull() | F.isnan(v)),
        "standard_value infinite": ("WARNING", F.abs(v) == float("inf")),
    }
    return failures(t1, rules)


def check_structures(t2: DataFrame) -> DataFrame:
    """T2: structures present, ids unique."""
    rules = {"smiles null": ("ERROR", F.col("smiles").isNull())}
    return failures(t2, rules).unionByName(repeated_keys(t2, "input_compound_id", "input_compound_id repeated"))


def check_types(t0: DataFrame, with_auxiliary: bool) -> DataFrame:
    """Which types occur, against whether auxiliary data is expected: one row per known or occurring type."""
    known = t0.sparkSession.createDataFrame([(t,) for t in ASSAY_TYPES], "assay_type string")
    seen = t0.groupBy("assay_type").agg(F.count(F.lit(1)).alias("n"))
    out = seen.join(known.withColumn("known", F.lit(True)), "assay_type", "full")
    n, auxiliary = F.coalesce("n", F.lit(0)), F.col("assay_type").isin(*AUXILIARY_TYPES)
    status = (
        F.when(F.col("assay_type").isNull(), "ERROR")
        .when(F.col("known").isNull(), "WARNING")
        .when((n > 0) & auxiliary & F.lit(not with_auxiliary), "ERROR")
        .when(n == 0, F.when(auxiliary & F.lit(with_auxiliary), "ERROR").otherwise("INFO"))
        .otherwise("OK")
    )
    return out.select("assay_type", n.alias("n"), status.alias("level"))


def check_sizes(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of two tables: a warning if the right has fewer, an error if the left has fewer."""
    count = lambda d, n: d.agg(F.countDistinct(key).alias(n)).select(F.lit(key).alias("key"), n)
    both = count(left, "n_left").join(count(right, "n_right"), "key")
    level = F.when(F.col("n_right") < F.col("n_left"), "WARNING").when(F.col("n_left") < F.col("n_right"), "ERROR").otherwise("OK")
    return both.withColumn("level", level)


def assays_without_values(t0: DataFrame, t1: DataFrame) -> DataFrame:
    return t0.join(t1, "input_assay_id", "left_anti").select("input_assay_id")


def common_ids(tables: list[DataFrame], key: str) -> DataFrame:
    """Ids that occur in all of several tables, which should share none."""
    out = tables[0].select(key).distinct()
    for t in tables[1:]:
        out = out.intersect(t.select(key))
    return out


def aligned(t1: DataFrame, t2: DataFrame, key: str = "input_compound_id") -> tuple[DataFrame, DataFrame]:
    """T2 with compounds that T1 measures, and the rest."""
    ids = t1.select(key).distinct()
    return t2.join(ids, key, "left_semi"), t2.join(ids, key, "left_anti")


def repeated_rows(df: DataFrame, key: str) -> DataFrame:
    return duplicated(df, [key])
