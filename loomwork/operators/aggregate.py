"""Measurements joined to assays and vectors, filtered, and replicates aggregated to one value."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.config import RANGED_TYPES, ROUNDED_TYPES, Config
from loomwork.operators.ids import duplicated
from loomwork.sources.tables import known_columns

GROUP = ["input_assay_id", "descriptor_vector_id", "fold_id"]
MEASUREMENT = ["input_compound_id", "input_assay_id", "standard_qualifier", "standard_value"]


def lookup(values: Mapping[str, object], key: Column) -> Column:
    """A value by a small table of the configuration; null for a key that it lacks."""
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[key] if values else F.lit(None)


def join_measurements(t1: DataFrame, t0: DataFrame, t5: DataFrame) -> DataFrame:
    """Measurements of known assays with the assay's attributes and, where the structure succeeded, vector and fold."""
    return t1.join(known_columns(t0), "input_assay_id").join(t5, "input_compound_id", "left")


def out_of_range(value: Column, assay_type: Column, config: Config = Config()) -> Column:
    """Whether a value is null or, for a type with a range, outside it; both bounds are inside. Other types take all values."""
    ranged = {t: r for t, r in config.ranges.items() if t in RANGED_TYPES}
    lo, hi = (lookup({t: r[i] for t, r in ranged.items()}, assay_type) for i in (0, 1))
    return value.isNull() | F.coalesce((value < lo) | (value > hi), F.lit(False))


def mapped_qualifier(q: Column) -> Column:
    """The qualifier as one of <, > and =; null is =, an unknown one stays."""
    return F.when(q.isNull() | q.isin("=", "~"), "=").when(q.isin("<", "<=", "<<"), "<").when(q.isin(">", ">=", ">>"), ">").otherwise(q)


def classify_measurements(joined: DataFrame, config: Config = Config()) -> DataFrame:
    """``joined`` with ``reject``: range, binary, no_vector or null for rows that go on.

    Values of binary assays must be 1 or -1. Rows whose assay is neither binary nor not are left out. Range and binary
    rejects come before missing vectors, so failed structures with bad values are reported for the value.
    """
    v, binary = F.col("standard_value"), F.col("is_binary")
    reject = (
        F.when(~binary & out_of_range(v, F.col("assay_type"), config), "range")
        .when(binary & F.coalesce(~v.isin(1.0, -1.0), F.lit(True)), "binary")
        .when(F.col("descriptor_vector_id").isNull(), "no_vector")
    )
    return joined.filter(binary.isNotNull()).withColumn("reject", reject)


def qualifier_mode(q: Column) -> Column:
    """The most frequent of <, > and =; = if it ties at the top, null if only < and > tie there or none occurs."""
    n = {s: F.count_if(q == s) for s in "<>="}
    top = F.greatest(*n.values())
    return F.when(top == 0, F.lit(None)).when(n["="] == top, "=").when(n["<"] == n[">"], F.lit(None)).when(n["<"] == top, "<").otherwise(">")


def value_mode(v: Column) -> Column:
    """The more frequent of 1 and -1; 1 on a tie."""
    return F.when(F.count_if(v == 1) >= F.count_if(v == -1), 1.0).otherwise(-1.0)


def candidates() -> dict[str, Column]:
    """All ways to aggregate a group of replicates: structs (value, qualifier)."""
    v, q, order = F.col("standard_value"), F.col("qualifier"), F.struct("seen", "qualifier")
    pick = lambda s: F.struct(s["v"].alias("value"), s["q"].alias("qualifier"))
    by = lambda key: F.struct(key.alias("k"), order.alias("o"), v.alias("v"), q.alias("q"))
    return {
        "median": F.struct(F.percentile(v, 0.5).alias("value"), qualifier_mode(q).alias("qualifier")),
        "least": pick(F.min(by(v))),
        "most": pick(F.coalesce(F.min(F.when(q != "<", by(-v))), F.min(by(-v)))),
        "largest": pick(F.min(by(-F.abs(v)))),
        "mode": F.struct(value_mode(v).alias("value"), F.lit("=").alias("qualifier")),
    }


def aggregate_groups(rows: DataFrame) -> DataFrame:
    """One row per (assay, vector, fold): standard_value, standard_qualifier and the number of replicates.

    Binary assays take the mode; dose-response types the maximum, or the larger censored value; ADME the median; others
    by their direction the minimum, maximum or largest magnitude. Ties take the row seen first. A single measurement
    keeps its value and qualifier. A median without a majority qualifier has a null qualifier.
    """
    attributes = ["assay_type", "is_binary", "direction"]
    kind, direction = F.col("assay_type"), F.col("direction")
    v, q = F.col("standard_value"), F.col("qualifier")
    most = kind.isin("NON-CATALOG-PANEL", "OTHER") | (~kind.isin("ADME") & (direction == "high"))
    least = ~kind.isin("NON-CATALOG-PANEL", "OTHER") & (direction == "low")
    # One choice for each group: of the maximum, values below a bound come last.
    key = F.when(most, -v).when(least, v).otherwise(-F.abs(v))
    picked = F.min(F.struct(F.coalesce(most & (q == "<"), F.lit(False)).alias("below"), key.alias("k"), "seen", "qualifier", v.alias("v")))
    median = F.struct(F.percentile(F.when((kind == "ADME") & ~F.col("is_binary"), v), 0.5).alias("value"), qualifier_mode(q).alias("qualifier"))
    mode = F.struct(value_mode(F.when(F.col("is_binary"), v)).alias("value"), F.lit("=").alias("qualifier"))
    grouped = rows.groupBy(*GROUP, *attributes).agg(F.count(F.lit(1)).alias("n_replicates"), picked.alias("picked"), median.alias("median"), mode.alias("mode"))
    pick = F.struct(F.col("picked.v").alias("value"), F.col("picked.qualifier").alias("qualifier"))
    chosen = F.when(F.col("n_replicates") == 1, pick).when(F.col("is_binary"), F.col("mode")).when(kind == "ADME", F.col("median")).otherwise(pick)
    out = grouped.select(*GROUP, "assay_type", "n_replicates", chosen.alias("chosen"))
    return out.select(*GROUP, "assay_type", "n_replicates", F.col("chosen.qualifier").alias("standard_qualifier"), F.col("chosen.value").alias("standard_value"))


def fold_variance(values: DataFrame, min_std: float, keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> DataFrame:
    """(input_assay_id, catalog, constant): whether some fold has no spread; a fold that the assay lacks, or with one value, has none.

    Folds are those that occur in any assay of the same subset, catalog or not.
    """
    catalog = F.col("assay_type") == "CATALOG-PANEL"
    per_fold = keep("T0_fold_spread", values.groupBy("input_assay_id", catalog.alias("catalog"), "fold_id").agg(F.stddev_samp("standard_value").alias("sd")))
    folds = per_fold.groupBy("catalog").agg(F.countDistinct("fold_id").alias("n_folds"))
    per_assay = per_fold.groupBy("input_assay_id", "catalog").agg(F.count("sd").alias("n"), F.min("sd").alias("sd"))
    constant = (F.col("n") < F.col("n_folds")) | F.coalesce(F.col("sd") <= min_std, F.lit(True))
    return per_assay.join(folds, "catalog").select("input_assay_id", "catalog", constant.alias("constant"))


def rounded(value: Column, assay_type: Column) -> Column:
    """Two digits for dose-response types, half to even on the scaled value."""
    return F.when(assay_type.isin(*ROUNDED_TYPES), F.rint(value * 100) / 100).otherwise(value)


class Replicates:
    """The tables that replicate aggregation gives; all are plans over the same classified measurements."""

    def __init__(self, t0: DataFrame, t1: DataFrame, t5: DataFrame, config: Config = Config()):
        self.assays, self.config = t0, config
        self.classified = classify_measurements(join_measurements(t1, t0, t5), config)
        accepted = self.classified.filter(F.col("reject").isNull()).withColumn("qualifier", mapped_qualifier(F.col("standard_qualifier")))
        self.accepted = accepted
        self._set(aggregate_groups(accepted), lambda name, df: df)

    def _set(self, grouped: DataFrame, keep: Callable[[str, DataFrame], DataFrame]) -> None:
        self.grouped, self.keep = grouped, keep
        self.valued = grouped.filter(F.col("standard_qualifier").isNotNull())
        self.variance = keep("T0_variance", fold_variance(self.valued, self.config.min_std, keep))

    def settle(self, keep: Callable[[str, DataFrame], DataFrame]) -> Replicates:
        """The same tables, from groups and variances that ``keep`` has written, for runs that need several of them."""
        self._set(keep("T1_grouped", self.grouped), keep)
        return self

    def rejected(self, reason: str) -> DataFrame:
        """Measurements rejected for ``range`` or ``binary``, with their own qualifiers."""
        return self.classified.filter(F.col("reject") == reason).select(*MEASUREMENT)

    def duplicates(self) -> DataFrame:
        """All accepted members of groups with several replicates."""
        columns = [*GROUP, "input_compound_id", "qualifier", "standard_value"]
        rows = duplicated(self.keep("T1_accepted", self.accepted.select(*columns)), GROUP)
        return rows.select("input_assay_id", "input_compound_id", "descriptor_vector_id", "fold_id", F.col("qualifier").alias("standard_qualifier"), "standard_value")

    def failed_aggregation(self) -> DataFrame:
        """Groups whose qualifiers have no majority."""
        return self.grouped.filter(F.col("standard_qualifier").isNull()).select("descriptor_vector_id", "input_assay_id", "standard_qualifier", "standard_value", "fold_id")

    def _without_spread(self) -> DataFrame:
        return self.variance.filter(~F.col("catalog") & F.col("constant")).select("input_assay_id")

    def failed_std(self) -> DataFrame:
        """Aggregated values of assays, other than catalog ones, that have a fold without spread."""
        rows = self.valued.join(self._without_spread(), "input_assay_id", "left_semi")
        return rows.select("descriptor_vector_id", "input_assay_id", "standard_qualifier", "standard_value", "fold_id")

    def t4r(self) -> DataFrame:
        """The aggregated values that go on, rounded."""
        rows = self.valued.join(self._without_spread(), "input_assay_id", "left_anti")
        return rows.select(*GROUP, "standard_qualifier", rounded(F.col("standard_value"), F.col("assay_type")).alias("standard_value"))

    def t0_updated(self) -> DataFrame:
        """T0 with ``variance_quorum_OK``; catalog assays without spread are not used in regression."""
        flags = self.variance.filter("constant").select("input_assay_id", F.col("catalog").alias("__catalog"))
        out = self.assays.join(flags, "input_assay_id", "left")
        use = F.when(F.col("__catalog"), F.lit(False)).otherwise(F.col("use_in_regression"))
        return out.withColumn("use_in_regression", use).withColumn("variance_quorum_OK", F.coalesce(F.col("__catalog"), F.lit(True))).drop("__catalog")
