"""Earlier operators on class labels: modes, conflicts, quorums and counts per fold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["classification_task_id", "descriptor_vector_id"]


def label_modes(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key the sorted values that are most frequent, and how often they occur; nulls count nothing."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*keys).agg(F.max("n").alias("mode_count"))
    ties = counts.join(best, keys).filter("n = mode_count")
    return ties.groupBy(*keys, "mode_count").agg(F.sort_array(F.collect_list(value)).alias("modes"))


def resolved_labels(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, class_label) of labels 0 and 1: the more frequent one; on a tie the one that is rarer in the whole table.

    0 comes out as -1. Labels as frequent as each other in the whole table leave ties to 1. Keys without a label drop out.
    """
    n0, n1 = F.count_if(F.col(value) == 0), F.count_if(F.col(value) == 1)
    rarer = df.agg(F.when(n0 < n1, 0).otherwise(1)).scalar()
    each = df.groupBy(*keys).agg(n0.alias("n0"), n1.alias("n1"))
    label = F.when(F.col("n0") > F.col("n1"), 0).when(F.col("n0") < F.col("n1"), 1).when(F.col("n0") > 0, rarer)
    return each.select(*keys, F.when(label == 0, -1).otherwise(label).alias("class_label")).filter("class_label IS NOT NULL")


def tasks_with_both(df: DataFrame, minimum: int) -> DataFrame:
    """Tasks that have at least ``minimum`` of each label."""
    n = df.groupBy("classification_task_id").agg(F.count_if(F.col("class_label") == -1).alias("n_inactive"), F.count_if(F.col("class_label") == 1).alias("n_active"))
    return n.filter((F.col("n_inactive") >= minimum) & (F.col("n_active") >= minimum))


def fold_label_counts(df: DataFrame) -> DataFrame:
    """Per task and fold the numbers of both labels; folds that the task lacks are 0, for all folds of the table."""
    folds = df.select("fold_id").filter("fold_id IS NOT NULL").distinct().agg(F.sort_array(F.collect_list("fold_id"))).scalar()
    n = df.groupBy("classification_task_id", "fold_id").agg(F.count_if(F.col("class_label") == -1).alias("n_inactive"), F.count_if(F.col("class_label") == 1).alias("n_active"))
    every = df.select("classification_task_id").distinct().select("classification_task_id", F.explode(folds).alias("fold_id"))
    return every.join(n, ["classification_task_id", "fold_id"], "left").na.fill(0, ["n_inactive", "n_active"])
