"""Operators on feature arrays: text form, binary values, informative bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def from_json_list(c: Column) -> Column:
    """The integers of a bracketed list; null for a null text."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"-?[0-9]+"), F.lit(0)), lambda x: x.try_cast("bigint"))


def to_json_list(c: Column) -> Column:
    """``[1, 2]`` for an array."""
    return F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]"))


def binarized(vals: Column) -> Column:
    return F.transform(vals, lambda _: F.lit(1))


def informative_bits(df: DataFrame, feats: str, lo: float = 0.1, hi: float = 0.9) -> DataFrame:
    """(feat, share): features that between ``lo`` and ``hi`` of the records hold, nearest to a half first when sorted by ``off``."""
    total = df.agg(F.count(F.lit(1))).scalar()
    held = df.select(F.explode(F.array_distinct(feats)).alias("feat")).filter("feat IS NOT NULL")
    share = held.groupBy("feat").agg(F.count(F.lit(1)).alias("n")).select("feat", (F.col("n") / total).alias("share"))
    return share.filter((F.col("share") > lo) & (F.col("share") < hi)).withColumn("off", F.abs(F.col("share") - 0.5))
