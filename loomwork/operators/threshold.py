"""Class thresholds per assay and the labels that values get from them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.config import AUXILIARY_TYPES, FIXED_TRIALS, Config
from loomwork.operators.ids import dense_ids
from loomwork.sources.tables import EXPERTS, known_columns

TASK = "classification_task_id"


def class_label(v: Column, q: Column, t: Column, direction: Column) -> Column:
    """1 active, -1 inactive, null where a censored value lies on the open side of the threshold, else 0.

    A value at the threshold is active, unless its qualifier says that the true value lies on the inactive side.
    """
    low = direction == "low"
    open_up, open_down = F.when(low, q == "<").otherwise(q == ">"), F.when(low, q == ">").otherwise(q == "<")
    above, below = F.when(low, v < t).otherwise(v > t), F.when(low, v > t).otherwise(v < t)
    label = F.when((above | (v == t)) & ~open_down, 1).when(below & ~open_up, -1).when((v == t) & open_down, -1)
    return label.when((above & open_down) | (below & open_up), F.lit(None)).otherwise(0)


def screening_label(v: Column, t: Column, direction: Column) -> Column:
    """1 or -1 for screening values against their own threshold ``t``: by direction, or by magnitude without one."""
    return F.when(F.when(direction == "high", v >= t).when(direction == "low", v <= t).otherwise(F.abs(v) >= t), 1).otherwise(-1)


def shifted(v: Column, q: Column) -> Column:
    """A censored value moved by log10(2) to where the true value is."""
    return F.when(q == "<", v - math.log10(2)).when(q == ">", v + math.log10(2)).otherwise(v)


def assay_statistics(t4r: DataFrame) -> DataFrame:
    """Per assay: medians, quartiles of uncensored values, and the labels that each trial threshold gives.

    Equal values of an assay are counted first, in parallel; the exact percentiles then come from distinct values and their
    counts, so an assay with a large share of all rows brings only these to its task.
    """
    v, q, n = F.col("standard_value"), F.col("standard_qualifier"), F.col("n")
    free = F.when(q == "=", v)
    trials = {}
    for i, t in enumerate(FIXED_TRIALS):
        label = class_label(v, q, F.lit(t), F.lit("high"))
        trials |= {f"{name}_{i}": F.coalesce(F.sum(F.when(label == x, n)), F.lit(0)) for name, x in (("active", 1), ("inactive", -1))}
    counts = t4r.groupBy("input_assay_id", v.alias("standard_value"), q.alias("standard_qualifier")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("input_assay_id").agg(
        F.percentile(shifted(v, q), 0.5, n).alias("shifted_median"),
        F.coalesce(F.sum(F.when(free.isNotNull(), n)), F.lit(0)).alias("n_free"),
        F.percentile(free, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), n).alias("quartiles"),
        *[c.alias(name) for name, c in trials.items()],
    )
    quartiles = [F.get("quartiles", F.lit(i)).alias(name) for i, name in ((1, "free_median"), (0, "free_q25"), (2, "free_q75"))]
    return found.select("input_assay_id", "shifted_median", "n_free", *quartiles, *trials)


def _entry(threshold: Column, method: str | Column) -> Column:
    return F.struct(threshold.cast("double").alias("threshold"), (F.lit(method) if isinstance(method, str) else method).alias("threshold_method"))


def threshold_list(config: Config = Config()) -> Column:
    """The array of (threshold, threshold_method) of an assay, from its attributes and statistics."""
    kind, direction = F.col("assay_type"), F.col("direction")
    experts = F.filter(F.array(*[F.col(c) for c in EXPERTS]), lambda e: e.isNotNull())
    named = F.transform(experts, lambda e: _entry(e, "expert"))
    lowest, highest = F.array_min(experts), F.array_max(experts)
    sandwich = lambda lo, hi: F.array(_entry(lo - 0.5, "aux_low"), _entry(hi + 0.5, "aux_high"))

    quorum = config.training_classification["OTHER"]
    adaptive = F.lit(None).cast("double")
    for i, t in reversed(list(enumerate(FIXED_TRIALS))):
        a, n = F.col(f"active_{i}"), F.col(f"inactive_{i}")
        enough = (a >= quorum["num_active_total"]) & (n >= quorum["num_inactive_total"]) & (a >= 0.2 * (a + n)) & (a + n > 0)
        adaptive = F.when(enough, F.lit(t)).otherwise(adaptive)
    own = F.coalesce(adaptive, F.col("shifted_median"))
    method = F.when(adaptive.isNotNull(), "fixed_adaptive").otherwise("median")
    dose = (
        F.when(F.size(experts) > 3, named)
        .when(F.size(experts) > 0, F.concat(named, sandwich(lowest, highest)))
        .when(own.isNotNull(), F.concat(F.array(_entry(own, method)), sandwich(own, own)))
    )
    median, quartile = F.col("free_median"), F.when(direction == "high", F.col("free_q75")).when(direction == "low", F.col("free_q25")).otherwise(0.0)
    two = F.concat(F.array(_entry(median, "median")), F.when(quartile != median, F.array(_entry(quartile, "quartile"))).otherwise(F.array().cast("array<struct<threshold:double,threshold_method:string>>")))
    adme = F.when(F.size(experts) > 0, named).when(F.col("n_free") > 1, two)
    catalog = F.transform(experts, lambda e: _entry(e, F.when(e == 4.53, "aux_low").otherwise("expert")))
    screening = F.when(direction == "low", -config.hts_threshold).otherwise(config.hts_threshold)
    return (
        F.when(F.col("is_binary"), F.array(_entry(F.lit(0.0), "expert")))
        .when(kind.isin("OTHER", "NON-CATALOG-PANEL"), dose)
        .when(kind == "ADME", adme)
        .when(kind == "CATALOG-PANEL", catalog)
        .when(kind == "AUX_HTS", F.array(_entry(screening, "fixed")))
    )


def catalog_experts(t0: DataFrame, t_cat: DataFrame) -> DataFrame:
    """T0 in which all catalog assays have the expert thresholds of the first row of the catalog, by its ids."""
    first = t_cat.groupBy().agg(F.min(F.struct("catalog_assay_id", "catalog_task_id", *EXPERTS)).alias("first"))
    catalog = F.col("assay_type") == "CATALOG-PANEL"
    return t0.withColumn("__first", first.scalar()).withColumns({c: F.when(catalog, F.col(f"__first.{c}")).otherwise(F.col(c)) for c in EXPERTS}).drop("__first")


def tasks(t0_updated: DataFrame, t4r: DataFrame, t_cat: DataFrame, config: Config = Config()) -> DataFrame:
    """T3c: one row per assay and threshold, numbered from 1 by assay and threshold; equal thresholds share a number.

    Assays without spread keep a row with a null threshold and number. Catalog tasks are those whose catalog assay,
    threshold and method the catalog has.
    """
    assays = catalog_experts(known_columns(t0_updated), t_cat)
    passed = assays.filter("variance_quorum_OK").join(assay_statistics(t4r), "input_assay_id", "left")
    each = passed.withColumn("entry", F.explode(threshold_list(config)))
    kind, method = F.col("assay_type"), F.col("entry.threshold_method")
    direction = F.when(F.col("is_binary"), F.lit(None)).when(kind == "AUX_HTS", F.col("direction")).when(F.col("direction") == "low", "low").otherwise("high")
    columns = ["input_assay_id", "assay_type", "variance_quorum_OK", "use_in_regression", "is_binary"]
    auxiliary = kind.isin(*AUXILIARY_TYPES) | F.coalesce(method.isin("aux_low", "aux_high"), F.lit(False))
    rows = each.select(*columns, auxiliary.alias("is_auxiliary"), F.col("entry.threshold").alias("threshold"), method.alias("threshold_method"), direction.alias("direction"), "catalog_assay_id")
    numbered = rows.join(dense_ids(rows, ["input_assay_id", "threshold"], TASK, 1), ["input_assay_id", "threshold"])
    failed = assays.filter("NOT variance_quorum_OK").select(*columns, "direction", "catalog_assay_id")
    every = numbered.unionByName(failed, allowMissingColumns=True)
    known = t_cat.select("catalog_assay_id", "threshold", "threshold_method", "catalog_task_id")
    return every.join(known, ["catalog_assay_id", "threshold", "threshold_method"], "left").select(
        TASK, *columns, "is_auxiliary", "threshold", "threshold_method", "direction", "catalog_assay_id", "catalog_task_id"
    )


def labels(t3c: DataFrame, t4r: DataFrame) -> DataFrame:
    """T4c: every aggregated value of an assay under each of its thresholds; binary values are their own label.

    A label is null where the value's censoring leaves it open.
    """
    columns = [TASK, "input_assay_id", "assay_type", "is_binary", "threshold", "direction"]
    both = t4r.join(t3c.filter(F.col(TASK).isNotNull()).select(*columns), "input_assay_id")
    v, t, direction = F.col("standard_value"), F.col("threshold"), F.col("direction")
    label = (
        F.when(F.col("is_binary"), v.cast("int"))
        .when(F.col("assay_type") == "AUX_HTS", screening_label(v, t, direction))
        .otherwise(class_label(v, F.col("standard_qualifier"), t, direction))
    )
    return both.select(TASK, "descriptor_vector_id", "fold_id", "input_assay_id", "standard_qualifier", "standard_value", "threshold", label.cast("int").alias("class_label"))
