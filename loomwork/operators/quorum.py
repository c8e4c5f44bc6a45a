"""Which tasks have enough data for training and evaluation, their weights, and the rows that go to training."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwork.config import Config
from loomwork.operators.aggregate import lookup
from loomwork.operators.ids import dense_ids, duplicated, first_of
from loomwork.operators.threshold import TASK
from loomwork.sources.tables import known_columns, with_assay_columns

CONT_TASK, CONT_REGRESSION = "cont_classification_task_id", "cont_regression_task_id"


def _reached(count: str, quorum: Mapping, name: str, kind: Column) -> Column:
    """Whether a count reaches the quorum of the type; a type without that quorum never does."""
    return F.coalesce(F.col(count) >= lookup({t: q[name] for t, q in quorum.items() if name in q}, kind), F.lit(False))


def class_counts(t4c: DataFrame) -> DataFrame:
    """Per task: actives and inactives in all, and the fewest in a fold, over the folds that occur."""
    one = lambda x: F.sum(F.coalesce((F.col("class_label") == x).cast("bigint"), F.lit(0)))
    folds = t4c.groupBy(TASK, "fold_id").agg(one(1).alias("a"), one(-1).alias("n"))
    return folds.groupBy(TASK).agg(
        F.sum("a").alias("num_total_actives"),
        F.min("a").alias("num_fold_min_actives"),
        F.sum("n").alias("num_total_inactives"),
        F.min("n").alias("num_fold_min_inactives"),
    )


def classification_tasks(t3c: DataFrame, t4c: DataFrame, config: Config = Config()) -> DataFrame:
    """T8c: tasks with counts, quorums, weights and the dense number of those that go to training.

    Catalog tasks have quorums of their own; one that fails, or that the catalog lacks, is treated as non-catalog. Tasks
    of assays without any labelled row are appended with nulls.
    """
    df = t3c.join(class_counts(t4c), TASK)
    in_catalog = F.col("catalog_task_id").isNotNull()
    train = F.col("num_total_actives") + F.col("num_total_inactives") >= config.catalog["num_total"]
    evaluate = (F.col("num_fold_min_actives") >= config.catalog["num_active_fold_min"]) & (F.col("num_fold_min_inactives") >= config.catalog["num_inactive_fold_min"])
    info = F.when(in_catalog & ~train, "failed_quorum").when(~in_catalog & F.col("catalog_assay_id").isNotNull(), "missing_ref_task")
    df = df.withColumn("catalog_check_INFO", info).withColumn("assay_type", F.when(info.isNotNull(), "NON-CATALOG-PANEL").otherwise(F.col("assay_type")))
    kind, is_catalog = F.col("assay_type"), F.col("assay_type") == "CATALOG-PANEL"
    of_type = _reached("num_total_actives", config.training_classification, "num_active_total", kind) & _reached("num_total_inactives", config.training_classification, "num_inactive_total", kind)
    seen = _reached("num_fold_min_actives", config.evaluation_classification, "num_active_fold_min", kind) & _reached("num_fold_min_inactives", config.evaluation_classification, "num_inactive_fold_min", kind)
    df = df.withColumns({"training_quorum_OK": F.when(is_catalog, train).otherwise(of_type), "evaluation_quorum_OK": F.when(is_catalog, evaluate).otherwise(seen)})
    converted = (kind == "NON-CATALOG-PANEL") & F.col("catalog_assay_id").isNotNull() & F.col("training_quorum_OK")
    passed = F.col("training_quorum_OK")
    n_tasks = F.sum(passed.cast("bigint")).over(Window.partitionBy("input_assay_id"))
    df = df.withColumns(
        {
            "catalog_task_id": F.when(~converted, F.col("catalog_task_id")),
            "aggregation_weight": F.when(F.col("is_auxiliary") | ~F.col("evaluation_quorum_OK"), 0).otherwise(1),
            "n_tasks": F.when(n_tasks > 0, n_tasks),
        }
    )
    df = df.withColumn("weight", F.when(passed, F.coalesce(lookup(config.initial_weights, kind), F.lit(1.0)) / F.col("n_tasks")))
    numbers = dense_ids(df.filter(passed), [TASK], CONT_TASK)
    t8c = df.join(numbers, TASK, "left")
    t8c = t8c.withColumn("retained_tasks", F.count(CONT_TASK).over(Window.partitionBy("input_assay_id")))
    missing = t3c.join(t8c.select("input_assay_id").distinct(), "input_assay_id", "left_anti")
    return t8c.unionByName(missing, allowMissingColumns=True)


def training_rows(t4c: DataFrame, t8c: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(T10c, rows of tasks filtered out, repeated rows): T10c has one row for each training task and vector.

    Of repeated rows the one with the smallest fold, value, qualifier and threshold stays.
    """
    numbers = t8c.filter(F.col(CONT_TASK).isNotNull()).select(TASK, CONT_TASK).distinct()
    kept = t4c.join(numbers, TASK)
    out = t4c.join(numbers, TASK, "left_anti")
    keys = [CONT_TASK, "descriptor_vector_id"]
    first = first_of(kept, keys, ["fold_id", "standard_value", "standard_qualifier", "threshold", "class_label"])
    return first.select(CONT_TASK, "descriptor_vector_id", "fold_id", "class_label"), out, duplicated(kept, keys)


def regression_counts(t4r: DataFrame) -> DataFrame:
    """Per assay: values and uncensored values in all, and the fewest in a fold."""
    free = (F.col("standard_qualifier") == "=").cast("bigint")
    folds = t4r.groupBy("input_assay_id", "fold_id").agg(F.count("standard_qualifier").alias("n"), F.sum(free).alias("u"))
    return folds.groupBy("input_assay_id").agg(
        F.sum("n").alias("num_total"),
        F.min("n").alias("num_fold_min"),
        F.sum("u").alias("num_uncensored_total"),
        F.min("u").alias("num_uncensored_fold_min"),
        (F.sum("n") - F.sum("u")).alias("num_censored_total"),
    )


def censored_weight(fraction: Column, barrier: float) -> Column:
    """1 up to the barrier, then falling with the fraction of censored values."""
    return F.when(fraction > barrier, barrier * (1 - fraction) / (fraction * (1 - barrier))).otherwise(1.0)


def fold_std_min(t4r: DataFrame) -> DataFrame:
    """(input_assay_id, std_min): the smallest deviation of a fold's uncensored values; 0 if some fold has fewer than two."""
    folds = t4r.filter("standard_qualifier = '='").groupBy("input_assay_id", "fold_id").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("standard_value").alias("sd"))
    return folds.groupBy("input_assay_id").agg(F.when(F.min("n") >= 2, F.min("sd")).otherwise(0.0).alias("std_min"))


def regression_tasks(t0_updated: DataFrame, t4r: DataFrame, config: Config = Config()) -> DataFrame:
    """T8r: assays with counts, quorums, weights and the dense number of those that go to training.

    Catalog assays count as non-catalog; binary ones are not used. Evaluation asks for uncensored values in every fold,
    and, but for ADME, for some spread there. Whether tasks are auxiliary is told from the first assay of the table, as
    a table is either all screening or none. Assays without values are appended with nulls. Other columns of T0 go along.
    """
    first = t0_updated.agg(F.min_by("assay_type", "input_assay_id")).scalar() == "AUX_HTS"
    use = F.when(F.col("is_binary"), F.lit(False)).otherwise(F.col("use_in_regression"))
    t3r = known_columns(t0_updated).withColumn("is_auxiliary", F.coalesce(first, F.lit(False))).withColumn("use_in_regression", use)
    kind = F.col("assay_type")
    df = t3r.join(regression_counts(t4r), "input_assay_id").withColumn("assay_type", F.when(kind == "CATALOG-PANEL", "NON-CATALOG-PANEL").otherwise(kind))
    enough = _reached("num_uncensored_total", config.training_regression, "num_uncensored_total", kind)
    fraction = F.col("num_censored_total") / F.col("num_total")
    df = df.join(fold_std_min(t4r), "input_assay_id", "left").withColumns(
        {
            "training_quorum_OK": _reached("num_total", config.training_regression, "num_total", kind) & enough,
            "evaluation_quorum_OK": _reached("num_uncensored_fold_min", config.evaluation_regression, "num_uncensored_fold_min", kind) & enough,
            "weight": F.when(F.col("is_auxiliary"), lookup(config.initial_weights, kind)).otherwise(1.0),
            "fraction_censored": fraction,
            "censored_weight": censored_weight(fraction, config.knock_in_barrier),
        }
    )
    trained = F.col("training_quorum_OK") & F.col("use_in_regression")
    # The spread is looked for among training rows, so an assay without them has none.
    spread = F.when(trained, F.coalesce("std_min", F.lit(0.0))).otherwise(0.0)
    df = df.withColumn("evaluation_stdv_quorum_OK", (kind == "ADME") | (spread >= config.min_evaluation_std)).drop("std_min")
    df = df.withColumn("aggregation_weight", (F.col("evaluation_quorum_OK") & F.col("evaluation_stdv_quorum_OK")).cast("double"))
    t8r = df.join(dense_ids(df.filter(trained), ["input_assay_id"], CONT_REGRESSION), "input_assay_id", "left")
    missing = t3r.join(df.select("input_assay_id"), "input_assay_id", "left_anti").withColumn("evaluation_stdv_quorum_OK", kind == "ADME").withColumn("aggregation_weight", F.lit(0.0))
    return with_assay_columns(t8r.unionByName(missing, allowMissingColumns=True), t0_updated)


def regression_rows(t4r: DataFrame, t8r: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(T10r, rows of assays filtered out, repeated rows): T10r has one row for each training assay and vector."""
    numbers = t8r.filter(F.col(CONT_REGRESSION).isNotNull()).select("input_assay_id", CONT_REGRESSION)
    kept = t4r.join(numbers, "input_assay_id")
    keys = [CONT_REGRESSION, "descriptor_vector_id"]
    first = first_of(kept, keys, ["fold_id", "standard_value", "standard_qualifier"])
    columns = ["input_assay_id", "descriptor_vector_id", "fold_id", "standard_qualifier", "standard_value", CONT_REGRESSION]
    return first.select(*columns), t4r.join(numbers, "input_assay_id", "left_anti"), duplicated(kept, keys).select(*columns)


def type_counts(t8: DataFrame, number: str) -> DataFrame:
    """Per assay type: assays and tasks that go to training."""
    return t8.filter(F.col(number).isNotNull()).groupBy("assay_type").agg(F.countDistinct("input_assay_id").alias("n_assays"), F.count(F.lit(1)).alias("n_tasks"))
