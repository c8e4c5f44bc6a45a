"""Dense ids by rank, without moving all rows to one task, and rows that repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwork.session import cut


def dense_ids(df: DataFrame, keys: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """(keys, ``name``): the dense rank of each distinct combination of keys, from ``start``; rows with a null key drop out.

    The distinct keys are parted by ranges and written in order; a part's rows are numbered by themselves, and the counts
    of the parts before it, one row per part, are added. No task sees more than its range.
    """
    distinct = df.select(*keys).dropna().distinct()
    part = F.spark_partition_id()
    parts = cut(distinct.repartitionByRange(*keys).withColumn("__part", part), "ranges")
    sizes = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*keys))
    return parts.withColumn("__place", place).join(F.broadcast(before), "__part").select(*keys, (F.col("__before") + F.col("__place") - 1 + start).alias(name))


def with_dense_id(df: DataFrame, keys: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """``df`` with the dense id of its keys; rows with a null key drop out."""
    return df.join(dense_ids(df, keys, name, start), list(keys))


def descriptor_ids(folds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(T5, T6, DUPLICATES) of compounds with features and folds.

    A vector is a combination of the texts fp_feat and fp_val and a fold, numbered from 0 in the order of the texts. T6
    has one row per vector, DUPLICATES all compounds of vectors that several rows have. Rows without features, values
    or fold have no vector.
    """
    keys = ["fp_feat", "fp_val", "fold_id"]
    rows = folds.filter(F.col("fold_id") >= 0)
    ids = cut(dense_ids(rows, keys, "descriptor_vector_id"), "vectors")
    both = rows.join(ids, keys)
    t5 = both.select("input_compound_id", "fold_id", "descriptor_vector_id")
    t6 = ids.select("descriptor_vector_id", *keys)
    several = both.groupBy("descriptor_vector_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("descriptor_vector_id")
    columns = ["input_compound_id", "canonical_smiles", *keys, "descriptor_vector_id"]
    return t5, t6, both.join(several, "descriptor_vector_id", "left_semi").select(*columns)


def duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the combinations of keys that several rows have."""
    several = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    return df.join(several, list(keys), "left_semi")


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row for each combination of keys: the first in ``order``, which should tell all rows apart."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min(F.struct(*order, *[F.col(c).alias(f"__{c}") for c in rest])).alias("__first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"__first.__{c}").alias(c) for c in rest]).select(*df.columns)
