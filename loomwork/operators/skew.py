"""Joins and aggregations that stay even when one key holds a large share of all rows.

A key is heavy when it holds more than ``share`` of all rows. There can be at most ``1 / share`` heavy keys, whatever
the size of the data; that is the proven bound on everything broadcast here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.session import cut

#: A key with more than this share of the rows counts as heavy: at most 256 keys.
HEAVY_SHARE = 1 / 256


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = HEAVY_SHARE) -> DataFrame:
    """The keys that hold more than ``share`` of the rows, with their count ``n_rows``; at most ``1 / share`` rows.

    Rows with a null key count into the total; a null key itself may be heavy. An empty table has no heavy key.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()  # from the same exchange
    return counts.filter(F.col("n_rows") > F.lit(share) * total)


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float = HEAVY_SHARE) -> DataFrame:
    """``left`` joined with ``right``, which has each key once, on the column ``key``; ``how`` is inner or left.

    Rows of heavy keys meet their one row of ``right`` by a broadcast of at most ``1 / share`` rows and never leave
    their partition; the others are shuffled. Null keys match nothing, and of a left join their rows stay where they are.
    Besides ``key`` the two sides must not share column names.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    heavy = heavy_keys(left.select(key), [key], share).filter(F.col(key).isNotNull()).select(F.col(key).alias("__heavy"))
    flagged = left.join(F.broadcast(heavy), F.col(key) == F.col("__heavy"), "left")
    hot = flagged.filter(F.col("__heavy").isNotNull()).drop("__heavy")
    cold = flagged.filter(F.col("__heavy").isNull() & F.col(key).isNotNull()).drop("__heavy")
    few = right.join(F.broadcast(heavy), F.col(key) == F.col("__heavy"), "left_semi")
    out = cold.join(right, key, how).unionByName(hot.join(F.broadcast(few), key, how))
    if how == "left":
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name != key]
        out = out.unionByName(left.filter(F.col(key).isNull()).select("*", *rest))
    return out


def salted_aggregate(
    df: DataFrame,
    key: str,
    partial: Mapping[str, Column],
    merge: Mapping[str, Column],
    salts: int = 64,
    share: float = HEAVY_SHARE,
) -> DataFrame:
    """Results per key in two stages: per (key, salt), then per key.

    ``partial`` names the aggregates over the rows of ``df``; ``merge`` the aggregates over the columns of ``partial``
    that give the result. Rows of heavy keys get one of ``salts`` salts, spread evenly over the rows of a partition;
    all other rows get salt 0. The salt is drawn from the row's place in its file split, not from its values, so that
    many equal rows are spread too, and a task that runs again draws the same salts.

    A null key is a key like any other. Each result covers all rows. An empty table gives no rows.
    """
    heavy = heavy_keys(df.select(key), [key], share).select(F.col(key).alias("__heavy"), F.lit(True).alias("__is"))
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    salted = (
        df.withColumn("__spread", spread)
        .join(F.broadcast(heavy), F.col(key).eqNullSafe(F.col("__heavy")), "left")
        .withColumn("__salt", F.when(F.col("__is"), F.col("__spread")).otherwise(F.lit(0)))
    )
    parts = salted.groupBy(key, "__salt").agg(*[c.alias(n) for n, c in partial.items()])
    return parts.groupBy(key).agg(*[c.alias(n) for n, c in merge.items()])


def value_statistics(df: DataFrame, key: str, value: str, salts: int = 64, share: float = HEAVY_SHARE) -> DataFrame:
    """Per key: rows, finite values, their mean, smallest, largest and sample standard deviation.

    Null, NaN and infinite values count in ``n_rows`` only. A key without finite values has null statistics, one with
    a single value has a null deviation. Means and squared deviations of the salts are merged around the common mean. Where all
    values are equal, the mean is that value and the deviation 0.
    """
    v = F.col(value).cast("double")
    finite = F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v)
    partial = {
        "__n": F.count(F.lit(1)),
        "__k": F.count(finite),
        "__m": F.avg(finite),
        "__q": F.var_pop(finite) * F.count(finite),
        "__lo": F.min(finite),
        "__hi": F.max(finite),
    }
    merge = {
        "n_rows": F.sum("__n"),
        "n_values": F.sum("__k"),
        "min_value": F.min("__lo"),
        "max_value": F.max("__hi"),
        "__parts": F.collect_list(F.when(F.col("__k") > 0, F.struct("__k", "__m", "__q"))),  # one for each salt at most
    }
    out = salted_aggregate(df.select(key, value), key, partial, merge, salts, share)
    n, lo, hi = F.col("n_values"), F.col("min_value"), F.col("max_value")
    total = lambda term: F.aggregate("__parts", F.lit(0.0), lambda s, x: s + term(x))
    out = out.withColumn("mean_value", F.when(lo == hi, lo).when(n > 0, total(lambda x: x["__k"] / n * x["__m"])))
    spread = total(lambda x: x["__q"] + x["__k"] * F.pow(x["__m"] - F.col("mean_value"), 2))
    std = F.when(n > 1, F.when(lo == hi, 0.0).otherwise(F.sqrt(spread / (n - 1)))).alias("std_value")
    return out.select(key, "n_rows", "n_values", "mean_value", "min_value", "max_value", std)


def keys_above(df: DataFrame, key: str, share: float, salts: int = 64) -> DataFrame:
    """The keys, null left out, that hold more than ``share`` of all rows, counted in two salted stages."""
    counts = cut(salted_aggregate(df.select(key), key, {"__n": F.count(F.lit(1))}, {"n_rows": F.sum("__n")}, salts), "counts")
    return counts.filter(F.col(key).isNotNull() & (F.col("n_rows") > F.lit(share) * counts.agg(F.sum("n_rows")).scalar()))
