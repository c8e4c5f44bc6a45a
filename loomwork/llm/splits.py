"""Splits that keep related records together: random-mate contraction, then a cut by cumulative weight."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwork.operators.skew import skew_join
from loomwork.session import cut, cut_counted

#: Weights of the largest group that one turn through the splits should have room for.
TURN_GROUPS = 64
# Spellings that stand for no key, compared in lower case.
NO_KEY = ("", "none", "nan", "n/a")


def key_or_null(c: Column) -> Column:
    """A key without white space at its ends; null, blank and the spellings of no key are null. Case matters."""
    t = F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")
    return F.when(~F.lower(t).isin(*NO_KEY), t)


# Edges without loops, repeats and nulls, the smaller end first; the vertices that collapse in a round, each with its mate; and
# the edges that a round leaves.
EDGES = "SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM {source} WHERE a <> b"
MATES = """SELECT u, min(v) AS to FROM (SELECT inline(array(struct(a AS u, b AS v), struct(b AS u, a AS v))) FROM {source})
    WHERE xxhash64(u, {seed}, {round}) & 1 = 0 AND xxhash64(v, {seed}, {round}) & 1 = 1 GROUP BY u"""
MOVED = """(SELECT coalesce(x.to, e.a) AS a, coalesce(y.to, e.b) AS b
    FROM {source} e LEFT JOIN ({mates}) x ON e.a = x.u LEFT JOIN ({mates}) y ON e.b = y.u)"""


def contract(edges: DataFrame, seed: int = 17) -> DataFrame:
    """(vertex, root) for each vertex of ``edges`` (a, b): vertices have the same root if and only if a path joins them.

    In each round every vertex tosses a coin, a hash of its id and the round. A vertex with tails that has a neighbour
    with heads collapses into the smallest such neighbour; the edges follow by two joins, loops and repeats vanish.
    A quarter of the vertices that still have edges is expected to go in each round. A round is one job, which writes its
    edges and counts them. When no edge is left, the rounds' maps, which follow from these tables, are unwound: a vertex points to one
    that collapsed in a later round, or to a root, so pointers are doubled log2(rounds) times. Loops, repeats and either order of an
    edge do no harm; rows with a null are dropped. Hubs: the choice of a neighbour is aggregated before its shuffle, and the joins
    keep the hub's rows on the side that adaptive execution splits.
    """
    spark, kind = edges.sparkSession, edges.schema["a"].dataType.simpleString()
    mates = lambda source, n: MATES.format(source=source, seed=seed, round=n)
    after = lambda source, n: EDGES.format(source=MOVED.format(source=source, mates=mates(source, n)))
    rounds: list[DataFrame] = []
    left, n = cut_counted(spark.sql(EDGES.format(source="{e}"), e=edges), "edges")
    while n:
        rounds.append(left)
        left, n = cut_counted(spark.sql(after("{e}", len(rounds) - 1), e=left), "edges")
    if not rounds:
        return spark.createDataFrame([], f"vertex {kind}, root {kind}")
    maps = [spark.sql(mates("{e}", i), e=e) for i, e in enumerate(rounds)]
    roots = cut(reduce(DataFrame.unionByName, maps), "maps")
    for _ in range(math.ceil(math.log2(len(rounds)))):
        roots = cut(spark.sql("SELECT m.u, coalesce(n.to, m.to) AS to FROM {m} m LEFT JOIN {m} n ON m.to = n.u", m=roots), "maps")
    return spark.sql("SELECT u AS vertex, to AS root FROM {m} UNION ALL SELECT DISTINCT to, to FROM {m}", m=roots)


def related_groups(records: DataFrame, id_col: str, keys: Sequence[str]) -> DataFrame:
    """(id, group_id) for each distinct id: ids are together when they share a value of a key, through any chain.

    Keys are taken through ``key_or_null``; equal texts in different key columns do not relate. ``group_id`` is the
    smallest id of the group. Rows of the same id belong together. Rows without an id take no part; an id without keys
    is a group of its own. A value stands in the graph as the smallest id that has it, so the graph has an edge for
    each distinct pair of values and not for each record.
    """
    names = [f"k{i}" for i in range(len(keys))]
    rows = records.select(F.col(id_col).alias("id"), *[key_or_null(F.col(k)).alias(n) for k, n in zip(keys, names)])
    rows = cut(rows.filter(F.col("id").isNotNull()).distinct(), "keyed")
    for i, n in enumerate(names):
        least = rows.filter(F.col(n).isNotNull()).groupBy(n).agg(F.min("id").alias(f"r{i}"))
        rows = cut(skew_join(rows, cut(least, "least"), n, "left").drop(n), "keyed")
    reps = [f"r{i}" for i in range(len(keys))]
    rows = rows.select("id", *reps, F.coalesce(*reps, F.col("id")).alias("anchor"))

    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("id")
    edges = rows.join(repeated, "id", "left_semi").select(F.col("id").alias("a"), F.col("anchor").alias("b"))
    for r in reps:
        edges = edges.unionByName(rows.filter(F.col(r).isNotNull()).select(F.col("anchor").alias("a"), F.col(r).alias("b")).distinct())
    labels = cut(contract(edges), "labels")
    smallest = cut(labels.groupBy("root").agg(F.min("vertex").alias("group_id")), "smallest")
    names_of = cut(skew_join(labels, smallest, "root").select(F.col("vertex").alias("anchor"), "group_id"), "labels")
    found = skew_join(cut(rows.select("id", "anchor").dropDuplicates(["id"]), "ids"), names_of, "anchor", "left")
    return found.select(F.col("id").alias(id_col), F.coalesce("group_id", "anchor").alias("group_id"))


def torn_groups(records: DataFrame, id_col: str, groups: DataFrame, fold: str, no_folds: Sequence[int] = (-1,)) -> DataFrame:
    """(id, group_id) of all records of the groups that hold more than one fold; null and ``no_folds`` are no folds."""
    folds = records.select(id_col, F.col(fold).alias("fold")).filter(F.col("fold").isNotNull() & ~F.col("fold").isin(*no_folds)).distinct()
    held = folds.join(groups, id_col).groupBy("group_id").agg(F.min("fold").alias("lo"), F.max("fold").alias("hi"))
    torn = cut(held.filter(F.col("lo") != F.col("hi")).select("group_id"), "torn")
    return skew_join(groups, torn, "group_id").select(id_col, "group_id")


def assign_splits(groups: DataFrame, id_col: str, targets: DataFrame) -> DataFrame:
    """(id, group_id, split_name): each group in one split, the shares of records as close to ``targets`` as that allows.

    ``targets`` (split_name, target_share) has a few rows; shares of the same split add up, and are taken relative to
    their sum. Groups are put in one order, by weight and then by a hash, and cut by cumulative weight: where the middle of a group
    falls in a turn through the splits, the largest split first, tells its split. A turn has room for about ``TURN_GROUPS`` of the
    largest group; there are several where that is little, so that groups of all sizes come to all splits, and one where it is more
    than all. A split then misses its share by what its cuts take from groups, half a group at most. Ranges of the order are summed
    in parallel. With no groups there are no rows.
    """
    sizes = cut(groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("weight")), "sizes")
    total, most = sizes.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.coalesce(F.max("weight"), F.lit(1))).collect()[0]
    shares = targets.groupBy("split_name").agg(F.sum("target_share").alias("share")).orderBy(F.desc("share"), "split_name").collect()
    turn = F.lit(max(1, total) / max(1, total // (TURN_GROUPS * most)))

    order = [F.desc("weight"), F.col("hash"), F.col("group_id")]
    ranges = sizes.withColumn("hash", F.xxhash64("group_id")).repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranges = cut(ranges, "ranges")
    sums = ranges.groupBy("part").agg(F.sum("weight").alias("of_part"))  # one row for each range
    before = sums.select("part", (F.sum("of_part").over(Window.orderBy("part")) - F.col("of_part")).alias("before"))
    within = F.sum("weight").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    middle = F.col("before") + within - F.col("weight") / 2
    place = middle / turn - F.floor(middle / turn)
    at, all_, chosen = 0.0, sum(r.share for r in shares) or 1.0, F.lit(None).cast("string")
    for r in shares:
        at += r.share / all_
        if r.share > 0:
            chosen = F.coalesce(chosen, F.when(F.col("place") < at, r.split_name))
    last = next((r.split_name for r in reversed(shares) if r.share > 0), None)
    placed = ranges.join(F.broadcast(before), "part").withColumn("place", place).select("group_id", F.coalesce(chosen, F.lit(last)).alias("split_name"))
    return skew_join(groups, cut(placed, "placed"), "group_id").select(id_col, "group_id", "split_name")
