"""Keyed hashes as Spark expressions, the scrambling permutation, and folds drawn from a key."""

from __future__ import annotations

import hashlib
import hmac
import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.operators.skew import skew_join

_BLOCK = 64


def hmac_sha256(secret: str, message: Column) -> Column:
    """The HMAC-SHA256 of a text under a key, as lower-case hex; null for a null text."""
    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > _BLOCK else key).ljust(_BLOCK, b"\0")
    inner, outer = (F.unhex(F.lit(bytes(b ^ pad for b in key).hex())) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256))), 256)


def permutation(spark: SparkSession, secret: str, size: int) -> DataFrame:
    """(feature, scrambled): a permutation of 0..size-1 by the rank of each number's keyed hash, modulo 2^63.

    ``size`` is a parameter of the configuration, so the ranking's single task has a fixed size.
    """
    from pyspark.sql.window import Window

    ids = spark.range(size).select(F.col("id").cast("int").alias("feature"))
    digest = hmac_sha256(secret, F.col("feature").cast("string"))
    tail = F.conv(F.substring(digest, 49, 16), 16, 10).cast("decimal(20,0)") % F.lit(str(2**63)).cast("decimal(20,0)")
    rank = F.row_number().over(Window.orderBy(tail, "feature")) - 1
    return ids.select("feature", rank.alias("scrambled"))


def scramble(df: DataFrame, feats: str, secret: str, size: int) -> DataFrame:
    """``df`` with the features of an array column renamed by the permutation; features beyond it become null.

    The permutation is looked up in one array of ``size`` numbers, which is broadcast; no row is exploded.
    """
    table = permutation(df.sparkSession, secret, size)
    ordered = table.agg(F.transform(F.array_sort(F.collect_list(F.struct("feature", "scrambled"))), lambda x: x["scrambled"])).scalar()
    bound = df.withColumn("__perm", ordered)
    return bound.withColumn(feats, F.transform(feats, lambda f: F.when((f >= 0) & (f < size), F.get(F.col("__perm"), f.cast("int"))))).drop("__perm")


def bit_string(feats: Column, bits: tuple[int, ...]) -> Column:
    """One character per configured bit: 1 if the features hold it."""
    return F.array_join(F.transform(F.array(*[F.lit(b) for b in bits]), lambda b: F.when(F.array_contains(feats, b.cast("bigint")), "1").otherwise("0")), "")


def fold_of(text: str, secret: str, nfolds: int) -> int:
    """The fold of a text: a number drawn by a generator that is seeded with the text's keyed hash."""
    digest = hmac.new(secret.encode(), text.encode(), hashlib.sha256).digest()
    return random.Random(digest).randint(0, nfolds - 1)


def keyed_folds(df: DataFrame, column: str, secret: str, nfolds: int, name: str = "fold_id") -> DataFrame:
    """``df`` with the fold of each text of ``column``; a null text stands as ``None``, so all of those share a fold.

    Folds are drawn once for each distinct text. Texts that many rows share, such as ``None``, meet their fold by a broadcast of a
    bounded number of rows. ``df`` is read several times, so it should be a table.
    """
    texts = df.select(F.coalesce(column, F.lit("None")).alias("__text")).distinct()

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{name: [fold_of(t, secret, nfolds) for t in batch["__text"]]})

    folds = texts.mapInPandas(draw, f"__text string, {name} int")
    return skew_join(df.withColumn("__text", F.coalesce(column, F.lit("None"))), folds, "__text").drop("__text")
