"""Registered queries of the assay pipeline, from the input tables to matrices, with their SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.config import ASSAY_TYPES, AUXILIARY_TYPES, FIXED_TRIALS, RANGED_TYPES, Config
from loomwork.functions import keyed
from loomwork.operators import aggregate, checks, features, ids, labels, matrix, packed, quorum, threshold
from loomwork.session import cut, read
from loomwork.sources import tables
from loomwork.sources.tables import EXPERTS

#: The published quorums, with smaller counts where these ask for more data per assay than the small tables hold.
CONFIG = Config(
    training_regression={t: {"num_total": 50, "num_uncensored_total": 25} for t in ("ADME", "NON-CATALOG-PANEL", "OTHER", "AUX_HTS")},
    evaluation_regression={t: {"num_uncensored_fold_min": 5} for t in ASSAY_TYPES},
    training_classification={t: {"num_active_total": 5, "num_inactive_total": 5} for t in ASSAY_TYPES},
    evaluation_classification={t: {"num_active_fold_min": 1, "num_inactive_fold_min": 1} for t in ASSAY_TYPES if t != "AUX_PL"},
    catalog={"num_total": 20, "num_active_fold_min": 1, "num_inactive_fold_min": 1},
)


def _t0(spark: SparkSession, folder: str) -> DataFrame:
    return tables.ingest_assays(read(spark, folder, "t0"))


def _t1(spark: SparkSession, folder: str) -> DataFrame:
    return tables.ingest_values(read(spark, folder, "t1"))


def _catalog(t0: DataFrame) -> DataFrame:
    """A catalog: for each catalog assay with thresholds of its own, tasks at the thresholds of the first of them."""
    known = t0.filter(F.col("catalog_assay_id").isNotNull() & F.col("expert_threshold_1").isNotNull())
    first = known.groupBy().agg(F.min(F.struct("catalog_assay_id", *EXPERTS)).alias("first"))
    each = known.select("catalog_assay_id").distinct().withColumn("first", first.scalar()).select("catalog_assay_id", *[F.col(f"first.{c}").alias(c) for c in EXPERTS])
    rows = each.select("*", F.explode(F.array(*EXPERTS)).alias("threshold")).filter("threshold IS NOT NULL")
    return ids.with_dense_id(rows.withColumn("threshold_method", F.lit("expert")), ["catalog_assay_id", "threshold"], "catalog_task_id", 1)


def _replicates(spark: SparkSession, folder: str) -> aggregate.Replicates:
    t5 = tables.ingest_vectors(read(spark, folder, "test_calculate_desc_t5"))
    return aggregate.Replicates(_t0(spark, folder), _t1(spark, folder), t5, CONFIG)


def _settled(spark: SparkSession, folder: str) -> aggregate.Replicates:
    """The same, with groups and variances written once."""
    return _replicates(spark, folder).settle(lambda name, df: cut(df, name))


class Stages:
    """The tables of a run, each written when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._kept: dict = {}

    def _keep(self, name: str, make) -> DataFrame:
        if name not in self._kept:
            self._kept[name] = cut(make(), name)
        return self._kept[name]

    def _settled(self) -> aggregate.Replicates:
        if "replicates" not in self._kept:
            self._kept["replicates"] = _settled(self.spark, self.folder)
        return self._kept["replicates"]

    def t0(self) -> DataFrame:
        return self._keep("t0", lambda: self._settled().t0_updated())

    def t4r(self) -> DataFrame:
        return self._keep("t4r", lambda: self._settled().t4r())

    def t3c(self) -> DataFrame:
        return self._keep("t3c", lambda: threshold.tasks(self.t0(), self.t4r(), self.catalog(), CONFIG))

    def catalog(self) -> DataFrame:
        return self._keep("catalog", lambda: _catalog(_t0(self.spark, self.folder)))

    def t4c(self) -> DataFrame:
        return self._keep("t4c", lambda: threshold.labels(self.t3c(), self.t4r()))

    def labelled(self) -> DataFrame:
        return self.t4c().filter("class_label IS NOT NULL")

    def t8c(self) -> DataFrame:
        return self._keep("t8c", lambda: quorum.classification_tasks(self.t3c(), self.labelled(), CONFIG))

    def t10c(self, which: int = 0) -> DataFrame:
        return quorum.training_rows(self.labelled(), self.t8c())[which]

    def t8r(self) -> DataFrame:
        return self._keep("t8r", lambda: quorum.regression_tasks(self.t0(), self.t4r(), CONFIG))

    def t10r(self, which: int = 0) -> DataFrame:
        return quorum.regression_rows(self.t4r(), self.t8r())[which]

    def t6(self) -> DataFrame:
        return read(self.spark, self.folder, "test_calculate_desc_t6").filter("descriptor_vector_id IS NOT NULL")

    def continuous(self, which: int) -> DataFrame:
        # Features are parsed for X and folds only.
        t6 = packed.unpack(self.t6().distinct(), ["descriptor_vector_id", "fold_id"], ["fp_feat", "fp_val"]) if which == 0 else self.t6()
        return matrix.continuous(t6, self.t10c(), self.t10r())[which]


QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _on_stages(name: str, make):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return make(Stages(spark, folder))

    run.__name__ = name
    QUERIES[name] = run


@query
def scan_union(spark, folder):
    """Two structure tables as one."""
    a, b = read(spark, folder, "test_standardizer"), read(spark, folder, "sn_fold_output")
    return tables.union_tables([a, b]).groupBy("success", "error_message").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("input_compound_id").alias("n_compounds"))


@query
def structures_failed(spark, folder):
    """The failed side of the success split."""
    return read(spark, folder, "sn_fold_output").filter(~F.coalesce("success", F.lit(False))).select("input_compound_id", "smiles", "error_message")


@query
def joined_measurements(spark, folder):
    r = _replicates(spark, folder)
    return r.classified.groupBy("assay_type", "is_binary", "reject").agg(F.count(F.lit(1)).alias("n_rows"), F.count("descriptor_vector_id").alias("n_vectors"))


@query
def credibility_range_failed(spark, folder):
    return _replicates(spark, folder).rejected("range")


@query
def binary_failed(spark, folder):
    return _replicates(spark, folder).rejected("binary")


@query
def mapped_qualifiers(spark, folder):
    q = F.col("standard_qualifier")
    return _t1(spark, folder).groupBy(q.alias("qualifier"), aggregate.mapped_qualifier(q).alias("mapped")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def duplicates_t1(spark, folder):
    r = _replicates(spark, folder)
    r.keep = lambda name, df: cut(df, name)
    return r.duplicates()


@query
def replicate_candidates(spark, folder):
    """All aggregates of each replicate group side by side."""
    rows = _replicates(spark, folder).accepted.groupBy(*aggregate.GROUP).agg(*[c.alias(n) for n, c in aggregate.candidates().items()])
    return rows.select(*aggregate.GROUP, *[F.col(f"{n}.{f}").alias(f"{n}_{f}") for n in ("median", "least", "most", "largest", "mode") for f in ("value", "qualifier") if (n, f) != ("mode", "qualifier")])


@query
def replicate_aggregation(spark, folder):
    return _settled(spark, folder).t4r()


@query
def failed_aggregation(spark, folder):
    return _replicates(spark, folder).failed_aggregation()


@query
def failed_std(spark, folder):
    return _settled(spark, folder).failed_std()


@query
def t0_updated(spark, folder):
    return _settled(spark, folder).t0_updated()


@query
def assay_thresholds(spark, folder):
    s = Stages(spark, folder)
    return threshold.assay_statistics(s.t4r())


_on_stages("t3c", lambda s: s.t3c())
_on_stages("t4c", lambda s: s.labelled())
_on_stages("t4c_failed", lambda s: s.t4c().filter("class_label IS NULL"))
_on_stages("class_counts", lambda s: quorum.class_counts(s.labelled()))
_on_stages("t8c", lambda s: s.t8c())
_on_stages("t8c_assays", lambda s: tables.with_assay_columns(s.t8c(), _t0(s.spark, s.folder)))
_on_stages("t10c", lambda s: s.t10c(0))
_on_stages("t4c_filtered_out", lambda s: s.t10c(1))
_on_stages("t4c_duplicates", lambda s: s.t10c(2))
_on_stages("regression_counts", lambda s: quorum.regression_counts(s.t4r()))
_on_stages("fold_std_min", lambda s: quorum.fold_std_min(s.t4r()).withColumn("std_min", F.round("std_min", 6)))
_on_stages("t8r", lambda s: s.t8r())
_on_stages("t10r", lambda s: s.t10r(0))
_on_stages("t4r_filtered_out", lambda s: s.t10r(1))
_on_stages("t4r_duplicates", lambda s: s.t10r(2))
_on_stages("type_counts_classification", lambda s: quorum.type_counts(s.t8c(), quorum.CONT_TASK))
_on_stages("type_counts_regression", lambda s: quorum.type_counts(s.t8r(), quorum.CONT_REGRESSION))
_on_stages("classification_weights", lambda s: matrix.classification_weights(s.t8c()))
_on_stages("regression_weights", lambda s: matrix.regression_weights(s.t8r()))
_on_stages("row_numbers", lambda s: matrix.row_numbers(s.t10c(), s.t10r()))
_on_stages("x_coo", lambda s: matrix.feature_matrix(s.continuous(0)))
_on_stages("x_coo_dense", lambda s: matrix.dense_columns(cut(matrix.feature_matrix(s.continuous(0)), "x")))
_on_stages("fold_vector", lambda s: matrix.fold_vector(s.continuous(0)))
_on_stages("y_classification_coo", lambda s: matrix.label_matrix(s.continuous(1)))
_on_stages("y_regression_coo", lambda s: matrix.value_matrix(s.continuous(2)))
_on_stages("censor_mask", lambda s: matrix.censor_mask(s.continuous(2)))


def _compounds(spark, folder):
    return read(spark, folder, "test_desc_duplicates").filter("success").distinct()


@query
def descriptor_t5(spark, folder):
    return ids.descriptor_ids(_compounds(spark, folder))[0]


@query
def descriptor_t6(spark, folder):
    return ids.descriptor_ids(_compounds(spark, folder))[1]


@query
def descriptor_duplicates(spark, folder):
    return ids.descriptor_ids(_compounds(spark, folder))[2]


@query
def prediction_ids(spark, folder):
    """Numbers from 1 for compounds, and dense ones from 0 for those with features."""
    rows = read(spark, folder, "test_desc_duplicates").select("input_compound_id", "fp_feat").distinct()
    numbered = cut(ids.with_dense_id(rows, ["input_compound_id"], "descriptor_vector_id", 1), "numbered")
    dense = ids.dense_ids(numbered.filter("fp_feat IS NOT NULL"), ["descriptor_vector_id"], "cont_descriptor_vector_id")
    return numbered.join(dense, "descriptor_vector_id", "left").select("input_compound_id", "descriptor_vector_id", "cont_descriptor_vector_id").distinct()


@query
def hmac_permutation(spark, folder):
    """The scrambled number of each feature that occurs."""
    feats = packed.unpack(read(spark, folder, "test_calculate_desc_t6"), [], ["fp_feat"]).select(F.explode("fp_feat").alias("feature")).distinct()
    return feats.join(keyed.permutation(spark, CONFIG.key, CONFIG.fold_size), "feature").select("feature", F.col("scrambled").cast("int").alias("scrambled"))


@query
def scrambled_features(spark, folder):
    t6 = read(spark, folder, "test_calculate_desc_duplicates").select("descriptor_vector_id", features.from_json_list(F.col("fp_feat")).alias("feats")).distinct()
    return keyed.scramble(t6, "feats", CONFIG.key, CONFIG.fold_size).select("descriptor_vector_id", F.array_sort("feats").alias("feats")).select("descriptor_vector_id", features.to_json_list(F.col("feats")).alias("fp_feat")).distinct()


def _lsh(spark, folder):
    v = read(spark, folder, "test_calculate_desc_duplicates").select("descriptor_vector_id", features.from_json_list(F.col("fp_feat")).alias("feats")).distinct()
    return v.select("descriptor_vector_id", keyed.bit_string(F.col("feats"), CONFIG.lsh_bits).alias("lsh"))


@query
def lsh_bits(spark, folder):
    return _lsh(spark, folder).distinct()


@query
def lsh_folds(spark, folder):
    return keyed.keyed_folds(_lsh(spark, folder).distinct(), "lsh", CONFIG.key, CONFIG.nfolds)


@query
def scaffold_folds(spark, folder):
    rows = read(spark, folder, "test_desc_duplicates").filter("success").select("input_compound_id", "sn_smiles").distinct()
    return keyed.keyed_folds(rows, "sn_smiles", CONFIG.key, CONFIG.nfolds)


def _fold_check(folds: DataFrame, text: str) -> DataFrame:
    """(text, n_rows, n_folds, in_range): each text has one fold, of those there are."""
    ok = F.min((F.col("fold_id") >= 0) & (F.col("fold_id") < CONFIG.nfolds)).alias("in_range")
    return folds.groupBy(F.coalesce(text, F.lit("None")).alias("text")).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("fold_id").alias("n_folds"), ok)


@query
def scaffold_fold_check(spark, folder):
    return _fold_check(scaffold_folds(spark, folder), "sn_smiles")


@query
def lsh_fold_check(spark, folder):
    """The folds of the texts of ``lsh_bits``."""
    return _fold_check(lsh_folds(spark, folder), "lsh")


@query
def informative_bits(spark, folder):
    t6 = packed.unpack(read(spark, folder, "test_calculate_desc_t6").dropDuplicates(["descriptor_vector_id"]), ["descriptor_vector_id"], ["fp_feat"])
    return features.informative_bits(t6, "fp_feat").select("feat", F.round("share", 9).alias("share"))


@query
def check_t0(spark, folder):
    return checks.check_assays(_t0(spark, folder))


@query
def check_t1(spark, folder):
    return checks.check_values(read(spark, folder, "t1"))


@query
def check_t2(spark, folder):
    return checks.check_structures(read(spark, folder, "test_standardizer"))


@query
def check_assay_types(spark, folder):
    return checks.check_types(_t0(spark, folder), True)


@query
def check_assay_sizes(spark, folder):
    return checks.check_sizes(read(spark, folder, "t0"), read(spark, folder, "t1"), "input_assay_id")


@query
def check_compound_sizes(spark, folder):
    return checks.check_sizes(read(spark, folder, "t1"), read(spark, folder, "test_desc_duplicates"), "input_compound_id")


@query
def assays_without_values(spark, folder):
    return checks.assays_without_values(read(spark, folder, "t0"), read(spark, folder, "t1"))


@query
def common_compounds(spark, folder):
    return checks.common_ids([read(spark, folder, t) for t in ("t1", "test_desc_duplicates", "test_calculate_desc_t5")], "input_compound_id")


@query
def structures_not_measured(spark, folder):
    return checks.aligned(read(spark, folder, "t1"), read(spark, folder, "test_desc_duplicates"))[1].select("input_compound_id").distinct()


def _binary(spark, folder):
    """Labels 0 and 1 of values of binary assays."""
    rows = _replicates(spark, folder).accepted.filter("is_binary")
    return rows.select(F.col("input_assay_id").alias("classification_task_id"), "descriptor_vector_id", "fold_id", (F.col("standard_value") == 1).cast("int").alias("label"))


@query
def label_modes(spark, folder):
    modes = labels.label_modes(_binary(spark, folder), labels.KEYS, "label")
    return modes.select(*labels.KEYS, "mode_count", F.array_join(F.col("modes").cast("array<string>"), ",").alias("modes"))


@query
def resolved_labels(spark, folder):
    return labels.resolved_labels(_binary(spark, folder), labels.KEYS, "label")


_on_stages("tasks_with_both", lambda s: labels.tasks_with_both(s.labelled(), 5))
_on_stages("fold_label_counts", lambda s: labels.fold_label_counts(s.labelled()))


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _case(column: str, values: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


def _reached(count: str, q: dict, name: str) -> str:
    return f"coalesce({count} >= {_case('assay_type', {t: x[name] for t, x in q.items() if name in x})}, FALSE)"


def _label(v: str, q: str, t: str, low: str) -> str:
    return f"""CASE WHEN {low} THEN
      CASE WHEN {v} <= {t} AND {q} <> '>' THEN 1 WHEN {v} > {t} AND {q} <> '<' THEN -1 WHEN {v} = {t} THEN -1 END
    ELSE CASE WHEN {v} >= {t} AND {q} <> '<' THEN 1 WHEN {v} < {t} AND {q} <> '>' THEN -1 WHEN {v} = {t} THEN -1 END END"""


_RANGES = {t: r for t, r in CONFIG.ranges.items() if t in RANGED_TYPES}
_SEEN = "loaded_at NULLS FIRST, measured_at NULLS FIRST, q"
_VALUES = f"""
WITH a AS (
  SELECT input_assay_id, trim(assay_type) AS assay_type, use_in_regression, is_binary, {", ".join(EXPERTS)}, catalog_assay_id, parent_assay_id, lower(trim(direction)) AS direction
  FROM t0
), v AS (
  SELECT input_compound_id, input_assay_id, CASE WHEN lower(trim(standard_qualifier)) NOT IN ('', 'n/a') THEN trim(standard_qualifier) END AS standard_qualifier,
    CASE WHEN NOT isnan(standard_value) THEN standard_value END AS standard_value, loaded_at, measured_at FROM t1
), mapped AS (
  SELECT *, CASE WHEN standard_qualifier IS NULL OR standard_qualifier = '~' THEN '=' WHEN standard_qualifier IN ('<=', '<<') THEN '<'
    WHEN standard_qualifier IN ('>=', '>>') THEN '>' ELSE standard_qualifier END AS q FROM v
), f AS (
  SELECT DISTINCT input_compound_id, CAST(descriptor_vector_id AS BIGINT) AS descriptor_vector_id, CAST(fold_id AS INT) AS fold_id FROM test_calculate_desc_t5
  WHERE fold_id >= 0 AND input_compound_id IS NOT NULL AND descriptor_vector_id IS NOT NULL
), j AS (
  SELECT mapped.*, assay_type, is_binary, direction, descriptor_vector_id, fold_id FROM mapped JOIN a USING (input_assay_id) LEFT JOIN f USING (input_compound_id)
), c AS (
  SELECT *, CASE
    WHEN NOT is_binary AND (standard_value IS NULL OR coalesce(standard_value < {_case("assay_type", {t: r[0] for t, r in _RANGES.items()})}
      OR standard_value > {_case("assay_type", {t: r[1] for t, r in _RANGES.items()})}, FALSE)) THEN 'range'
    WHEN is_binary AND coalesce(standard_value NOT IN (1, -1), TRUE) THEN 'binary'
    WHEN descriptor_vector_id IS NULL THEN 'no_vector' END AS reject
  FROM j WHERE is_binary IS NOT NULL
), acc AS (SELECT *, standard_value AS x FROM c WHERE reject IS NULL),
g AS (
  SELECT input_assay_id, descriptor_vector_id, fold_id, any_value(assay_type) AS assay_type, any_value(is_binary) AS is_binary, any_value(direction) AS direction, count(*) AS n,
    quantile_cont(x, 0.5) AS median_value, count(*) FILTER (q = '<') AS lt, count(*) FILTER (q = '>') AS gt, count(*) FILTER (q = '=') AS eq,
    min(x) AS least_value, first(q ORDER BY x, {_SEEN}) AS least_qualifier,
    coalesce(max(x) FILTER (q <> '<'), max(x)) AS most_value,
    coalesce(first(q ORDER BY x DESC, {_SEEN}) FILTER (q <> '<'), first(q ORDER BY x DESC, {_SEEN})) AS most_qualifier,
    first(x ORDER BY abs(x) DESC, {_SEEN}) AS largest_value, first(q ORDER BY abs(x) DESC, {_SEEN}) AS largest_qualifier,
    CASE WHEN count(*) FILTER (x = 1) >= count(*) FILTER (x = -1) THEN 1.0 ELSE -1.0 END AS mode_value
  FROM acc GROUP BY 1, 2, 3
), candidates AS (
  SELECT *, CASE WHEN greatest(lt, gt, eq) = 0 THEN NULL WHEN eq >= lt AND eq >= gt THEN '=' WHEN lt = gt THEN NULL WHEN lt > gt THEN '<' ELSE '>' END AS median_qualifier FROM g
), grouped AS (
  SELECT input_assay_id, descriptor_vector_id, fold_id, assay_type,
    CASE WHEN n = 1 THEN least_value WHEN is_binary THEN mode_value WHEN assay_type IN ('NON-CATALOG-PANEL', 'OTHER') THEN most_value WHEN assay_type = 'ADME' THEN median_value
      WHEN direction = 'low' THEN least_value WHEN direction = 'high' THEN most_value ELSE largest_value END AS standard_value,
    CASE WHEN n = 1 THEN least_qualifier WHEN is_binary THEN '=' WHEN assay_type IN ('NON-CATALOG-PANEL', 'OTHER') THEN most_qualifier WHEN assay_type = 'ADME' THEN median_qualifier
      WHEN direction = 'low' THEN least_qualifier WHEN direction = 'high' THEN most_qualifier ELSE largest_qualifier END AS standard_qualifier
  FROM candidates
), valued AS (SELECT * FROM grouped WHERE standard_qualifier IS NOT NULL),
per_fold AS (
  SELECT input_assay_id, assay_type = 'CATALOG-PANEL' AS catalog, fold_id, CASE WHEN count(*) > 1 THEN stddev_samp(standard_value) END AS sd FROM valued GROUP BY 1, 2, 3
), variance AS (
  SELECT input_assay_id, catalog, count(sd) < any_value(n_folds) OR coalesce(min(sd) <= {CONFIG.min_std}, TRUE) AS flat
  FROM per_fold JOIN (SELECT catalog, count(DISTINCT fold_id) AS n_folds FROM per_fold GROUP BY 1) USING (catalog) GROUP BY 1, 2
), t4r AS (
  SELECT input_assay_id, descriptor_vector_id, fold_id, standard_qualifier,
    CASE WHEN assay_type IN ('OTHER', 'NON-CATALOG-PANEL') THEN round_even(standard_value * 100, 0) / 100 ELSE standard_value END AS standard_value
  FROM valued WHERE input_assay_id NOT IN (SELECT input_assay_id FROM variance WHERE flat AND NOT catalog)
), u AS (
  SELECT a.* EXCLUDE (use_in_regression), CASE WHEN catalog THEN FALSE ELSE use_in_regression END AS use_in_regression, coalesce(catalog, TRUE) AS "variance_quorum_OK"
  FROM a LEFT JOIN (SELECT * FROM variance WHERE flat) USING (input_assay_id)
)
"""

_TRIALS = ", ".join(
    f"count(*) FILTER ({_label('standard_value', 'standard_qualifier', t, 'FALSE')} = 1) AS active_{i}, count(*) FILTER ({_label('standard_value', 'standard_qualifier', t, 'FALSE')} = -1) AS inactive_{i}"
    for i, t in enumerate(FIXED_TRIALS)
)
_OTHER = CONFIG.training_classification["OTHER"]
_ADAPTIVE = "CASE " + " ".join(
    f"WHEN active_{i} >= {_OTHER['num_active_total']} AND inactive_{i} >= {_OTHER['num_inactive_total']} AND active_{i} >= 0.2 * (active_{i} + inactive_{i}) AND active_{i} + inactive_{i} > 0 THEN {t}"
    for i, t in enumerate(FIXED_TRIALS)
) + " END"

_TASKS = (
    _VALUES
    + f""", known AS (SELECT * FROM a WHERE catalog_assay_id IS NOT NULL AND expert_threshold_1 IS NOT NULL),
first_known AS (SELECT {", ".join(EXPERTS)} FROM known ORDER BY catalog_assay_id LIMIT 1),
cat AS (
  SELECT *, dense_rank() OVER (ORDER BY catalog_assay_id, threshold) AS catalog_task_id FROM (
    SELECT DISTINCT k.catalog_assay_id, unnest([{", ".join("f." + c for c in EXPERTS)}]) AS threshold FROM known k, first_known f) WHERE threshold IS NOT NULL
), w AS (
  SELECT u.* EXCLUDE ({", ".join(EXPERTS)}), list_filter(CASE WHEN assay_type = 'CATALOG-PANEL' THEN (SELECT [{", ".join(EXPERTS)}] FROM first_known)
    ELSE [{", ".join(EXPERTS)}] END, lambda e: e IS NOT NULL) AS experts FROM u
), stats AS (
  SELECT input_assay_id, quantile_cont(CASE standard_qualifier WHEN '<' THEN standard_value - {math.log10(2)!r} WHEN '>' THEN standard_value + {math.log10(2)!r} ELSE standard_value END, 0.5) AS shifted_median,
    count(*) FILTER (standard_qualifier = '=') AS n_free, quantile_cont(standard_value, 0.5) FILTER (standard_qualifier = '=') AS free_median,
    quantile_cont(standard_value, 0.25) FILTER (standard_qualifier = '=') AS free_q25, quantile_cont(standard_value, 0.75) FILTER (standard_qualifier = '=') AS free_q75, {_TRIALS}
  FROM t4r GROUP BY 1
), own AS (
  SELECT *, {_ADAPTIVE} AS adaptive, CASE direction WHEN 'high' THEN free_q75 WHEN 'low' THEN free_q25 ELSE 0 END AS quartile FROM w LEFT JOIN stats USING (input_assay_id) WHERE "variance_quorum_OK"
), entries AS (
  SELECT *, unnest(CASE
    WHEN is_binary THEN [{{t: 0.0::DOUBLE, m: 'expert'}}]
    WHEN assay_type IN ('OTHER', 'NON-CATALOG-PANEL') THEN CASE
      WHEN len(experts) > 3 THEN list_transform(experts, lambda e: {{t: e, m: 'expert'}})
      WHEN len(experts) > 0 THEN list_concat(list_transform(experts, lambda e: {{t: e, m: 'expert'}}), [{{t: list_min(experts) - 0.5, m: 'aux_low'}}, {{t: list_max(experts) + 0.5, m: 'aux_high'}}])
      WHEN coalesce(adaptive, shifted_median) IS NOT NULL THEN [{{t: coalesce(adaptive, shifted_median), m: CASE WHEN adaptive IS NULL THEN 'median' ELSE 'fixed_adaptive' END}},
        {{t: coalesce(adaptive, shifted_median) - 0.5, m: 'aux_low'}}, {{t: coalesce(adaptive, shifted_median) + 0.5, m: 'aux_high'}}] END
    WHEN assay_type = 'ADME' THEN CASE
      WHEN len(experts) > 0 THEN list_transform(experts, lambda e: {{t: e, m: 'expert'}})
      WHEN n_free > 1 AND quartile <> free_median THEN [{{t: free_median, m: 'median'}}, {{t: quartile, m: 'quartile'}}]
      WHEN n_free > 1 THEN [{{t: free_median, m: 'median'}}] END
    WHEN assay_type = 'CATALOG-PANEL' THEN list_transform(experts, lambda e: {{t: e, m: CASE WHEN e = 4.53 THEN 'aux_low' ELSE 'expert' END}})
    WHEN assay_type = 'AUX_HTS' THEN [{{t: CASE WHEN direction = 'low' THEN -{CONFIG.hts_threshold} ELSE {CONFIG.hts_threshold} END::DOUBLE, m: 'fixed'}}] END) AS entry
  FROM own
), every_task AS (
  SELECT dense_rank() OVER (ORDER BY input_assay_id, entry.t) AS classification_task_id, input_assay_id, assay_type, "variance_quorum_OK", use_in_regression, is_binary,
    assay_type IN {_in(AUXILIARY_TYPES)} OR entry.m IN ('aux_low', 'aux_high') AS is_auxiliary, entry.t AS threshold, entry.m AS threshold_method,
    CASE WHEN is_binary THEN NULL WHEN assay_type = 'AUX_HTS' THEN direction WHEN direction = 'low' THEN 'low' ELSE 'high' END AS direction, catalog_assay_id
  FROM entries WHERE entry IS NOT NULL
  UNION ALL
  SELECT NULL, input_assay_id, assay_type, "variance_quorum_OK", use_in_regression, is_binary, NULL, NULL, NULL, direction, catalog_assay_id FROM w WHERE NOT "variance_quorum_OK"
), t3c AS (
  SELECT every_task.*, cat.catalog_task_id FROM every_task LEFT JOIN cat ON every_task.catalog_assay_id = cat.catalog_assay_id AND every_task.threshold = cat.threshold AND threshold_method = 'expert'
), all_labels AS (
  SELECT classification_task_id, descriptor_vector_id, fold_id, input_assay_id, standard_qualifier, standard_value, threshold,
    CASE WHEN is_binary THEN CAST(standard_value AS INT)
      WHEN assay_type = 'AUX_HTS' THEN CASE WHEN CASE direction WHEN 'high' THEN standard_value >= threshold WHEN 'low' THEN standard_value <= threshold ELSE abs(standard_value) >= threshold END THEN 1 ELSE -1 END
      ELSE {_label("standard_value", "standard_qualifier", "threshold", "coalesce(direction = 'low', FALSE)")} END AS class_label
  FROM t4r JOIN t3c USING (input_assay_id) WHERE classification_task_id IS NOT NULL
), t4c AS (SELECT * FROM all_labels WHERE class_label IS NOT NULL)
"""
)

_TC, _EC, _C = CONFIG.training_classification, CONFIG.evaluation_classification, CONFIG.catalog
_CLASSES = (
    _TASKS
    + f""", class_counts AS (
  SELECT classification_task_id, sum(x) AS num_total_actives, min(x) AS num_fold_min_actives, sum(y) AS num_total_inactives, min(y) AS num_fold_min_inactives
  FROM (SELECT classification_task_id, fold_id, count(*) FILTER (class_label = 1) AS x, count(*) FILTER (class_label = -1) AS y FROM t4c GROUP BY 1, 2) GROUP BY 1
), told AS (
  SELECT t3c.* EXCLUDE (assay_type), num_total_actives, num_fold_min_actives, num_total_inactives, num_fold_min_inactives, assay_type AS given_type,
    CASE WHEN catalog_task_id IS NOT NULL AND num_total_actives + num_total_inactives < {_C["num_total"]} THEN 'failed_quorum'
      WHEN catalog_task_id IS NULL AND catalog_assay_id IS NOT NULL THEN 'missing_ref_task' END AS "catalog_check_INFO"
  FROM t3c JOIN class_counts USING (classification_task_id)
), typed AS (SELECT *, CASE WHEN "catalog_check_INFO" IS NULL THEN given_type ELSE 'NON-CATALOG-PANEL' END AS assay_type FROM told),
judged AS (
  SELECT *,
    CASE WHEN assay_type = 'CATALOG-PANEL' THEN num_total_actives + num_total_inactives >= {_C["num_total"]}
      ELSE {_reached("num_total_actives", _TC, "num_active_total")} AND {_reached("num_total_inactives", _TC, "num_inactive_total")} END AS "training_quorum_OK",
    CASE WHEN assay_type = 'CATALOG-PANEL' THEN num_fold_min_actives >= {_C["num_active_fold_min"]} AND num_fold_min_inactives >= {_C["num_inactive_fold_min"]}
      ELSE {_reached("num_fold_min_actives", _EC, "num_active_fold_min")} AND {_reached("num_fold_min_inactives", _EC, "num_inactive_fold_min")} END AS "evaluation_quorum_OK"
  FROM typed
), weighed AS (
  SELECT * EXCLUDE (catalog_task_id, given_type),
    CASE WHEN NOT (assay_type = 'NON-CATALOG-PANEL' AND catalog_assay_id IS NOT NULL AND "training_quorum_OK") THEN catalog_task_id END AS catalog_task_id,
    CASE WHEN is_auxiliary OR NOT "evaluation_quorum_OK" THEN 0 ELSE 1 END AS aggregation_weight,
    nullif(count(*) FILTER ("training_quorum_OK") OVER (PARTITION BY input_assay_id), 0) AS n_tasks
  FROM judged
), numbered AS (
  SELECT classification_task_id, dense_rank() OVER (ORDER BY classification_task_id) - 1 AS cont_classification_task_id FROM (SELECT DISTINCT classification_task_id FROM judged WHERE "training_quorum_OK")
), t8c AS (
  SELECT *, CASE WHEN "training_quorum_OK" THEN coalesce({_case("assay_type", dict(CONFIG.initial_weights))}, 1.0) / n_tasks END AS weight,
    count(cont_classification_task_id) OVER (PARTITION BY input_assay_id) AS retained_tasks
  FROM weighed LEFT JOIN numbered USING (classification_task_id)
  UNION ALL BY NAME
  SELECT * FROM t3c WHERE input_assay_id NOT IN (SELECT input_assay_id FROM judged)
), kept AS (SELECT t4c.*, cont_classification_task_id FROM t4c JOIN numbered USING (classification_task_id)),
t10c AS (
  SELECT cont_classification_task_id, descriptor_vector_id, fold_id, class_label FROM kept
  QUALIFY row_number() OVER (PARTITION BY cont_classification_task_id, descriptor_vector_id ORDER BY fold_id, standard_value, standard_qualifier, threshold, class_label) = 1
)
"""
)

_TR, _ER = CONFIG.training_regression, CONFIG.evaluation_regression
_REGRESSION = f""", regression_counts AS (
  SELECT input_assay_id, CAST(sum(n) AS BIGINT) AS num_total, min(n) AS num_fold_min, CAST(sum(k) AS BIGINT) AS num_uncensored_total, min(k) AS num_uncensored_fold_min, CAST(sum(n) - sum(k) AS BIGINT) AS num_censored_total
  FROM (SELECT input_assay_id, fold_id, count(*) AS n, count(*) FILTER (standard_qualifier = '=') AS k FROM t4r GROUP BY 1, 2) GROUP BY 1
), fold_std AS (
  SELECT input_assay_id, CASE WHEN min(n) >= 2 THEN min(sd) ELSE 0 END AS std_min
  FROM (SELECT input_assay_id, fold_id, count(*) AS n, CASE WHEN count(*) > 1 THEN stddev_samp(standard_value) END AS sd FROM t4r WHERE standard_qualifier = '=' GROUP BY 1, 2) GROUP BY 1
), t3r AS (
  SELECT u.* EXCLUDE (use_in_regression), CASE WHEN is_binary THEN FALSE ELSE use_in_regression END AS use_in_regression, (SELECT arg_min(assay_type, input_assay_id) FROM u) = 'AUX_HTS' AS is_auxiliary FROM u
), counted AS (
  SELECT t3r.* REPLACE (CASE WHEN assay_type = 'CATALOG-PANEL' THEN 'NON-CATALOG-PANEL' ELSE assay_type END AS assay_type), regression_counts.* EXCLUDE (input_assay_id), std_min
  FROM t3r JOIN regression_counts USING (input_assay_id) LEFT JOIN fold_std USING (input_assay_id)
), decided AS (
  SELECT *, {_reached("num_total", _TR, "num_total")} AND {_reached("num_uncensored_total", _TR, "num_uncensored_total")} AS "training_quorum_OK",
    {_reached("num_uncensored_fold_min", _ER, "num_uncensored_fold_min")} AND {_reached("num_uncensored_total", _TR, "num_uncensored_total")} AS "evaluation_quorum_OK",
    CASE WHEN is_auxiliary THEN {_case("assay_type", dict(CONFIG.initial_weights))} ELSE 1.0 END AS weight, num_censored_total / num_total AS fraction_censored
  FROM counted
), spread AS (
  SELECT * EXCLUDE (std_min), assay_type = 'ADME' OR CASE WHEN "training_quorum_OK" AND use_in_regression THEN coalesce(std_min, 0) ELSE 0 END >= {CONFIG.min_evaluation_std} AS "evaluation_stdv_quorum_OK",
    CASE WHEN fraction_censored > {CONFIG.knock_in_barrier} THEN {CONFIG.knock_in_barrier} * (1 - fraction_censored) / (fraction_censored * (1 - {CONFIG.knock_in_barrier})) ELSE 1.0 END AS censored_weight
  FROM decided
), regression_numbers AS (
  SELECT input_assay_id, dense_rank() OVER (ORDER BY input_assay_id) - 1 AS cont_regression_task_id FROM spread WHERE "training_quorum_OK" AND use_in_regression
), t8r AS (
  SELECT *, CASE WHEN "evaluation_quorum_OK" AND "evaluation_stdv_quorum_OK" THEN 1.0 ELSE 0.0 END AS aggregation_weight FROM spread LEFT JOIN regression_numbers USING (input_assay_id)
  UNION ALL BY NAME
  SELECT *, assay_type = 'ADME' AS "evaluation_stdv_quorum_OK", 0.0 AS aggregation_weight FROM t3r WHERE input_assay_id NOT IN (SELECT input_assay_id FROM spread)
), kept_r AS (SELECT t4r.*, cont_regression_task_id FROM t4r JOIN regression_numbers USING (input_assay_id)),
t10r AS (
  SELECT input_assay_id, descriptor_vector_id, fold_id, standard_qualifier, standard_value, cont_regression_task_id FROM kept_r
  QUALIFY row_number() OVER (PARTITION BY cont_regression_task_id, descriptor_vector_id ORDER BY fold_id, standard_value, standard_qualifier) = 1
)
"""
_FEATS = r"""list_transform(regexp_extract_all(fp_feat, '"[^"]*"|''[^'']*''|[0-9]+(?:\.[0-9]*)?'), lambda p: CAST(split_part(regexp_replace(p, '["'',\s]', '', 'g'), '.', 1) AS BIGINT))"""
_CONT = (
    _CLASSES
    + _REGRESSION
    + f""", row_numbers AS (
  SELECT descriptor_vector_id, dense_rank() OVER (ORDER BY descriptor_vector_id) - 1 AS cont_descriptor_vector_id FROM (SELECT descriptor_vector_id FROM t10c UNION SELECT descriptor_vector_id FROM t10r)
), x AS (
  SELECT DISTINCT cont_descriptor_vector_id AS "row", unnest({_FEATS}) AS col, 1 AS value FROM test_calculate_desc_t6 JOIN row_numbers USING (descriptor_vector_id)
)
"""
)
_IDS = """
WITH rows_ AS (SELECT DISTINCT * FROM test_desc_duplicates WHERE success AND fold_id >= 0 AND fp_feat IS NOT NULL AND fp_val IS NOT NULL),
numbered AS (SELECT *, dense_rank() OVER (ORDER BY fp_feat, fp_val, fold_id) - 1 AS descriptor_vector_id FROM rows_)
"""


def _hmac_sql(message: str) -> str:
    import hashlib

    key = CONFIG.key.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    pad = lambda p: "unhex('" + bytes(b ^ p for b in key).hex() + "')"
    return f"sha256({pad(0x5C)} || unhex(sha256({pad(0x36)} || encode({message}))))"


_PERMUTATION = f"""
WITH keyed AS (SELECT range AS feature, CAST('0x' || {_hmac_sql("CAST(range AS VARCHAR)")}[49:64] AS UBIGINT) % 9223372036854775808 AS k FROM range({CONFIG.fold_size})),
permutation AS (SELECT feature, CAST(row_number() OVER (ORDER BY k, feature) - 1 AS INT) AS scrambled FROM keyed)
"""
_LABELS = _VALUES + """, binary_labels AS (
  SELECT input_assay_id AS classification_task_id, descriptor_vector_id, fold_id, CAST(x = 1 AS INT) AS label FROM acc WHERE is_binary
), tallied AS (
  SELECT classification_task_id, descriptor_vector_id, count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1 FROM binary_labels GROUP BY 1, 2
)
"""


def _sizes(left: str, right: str, key: str) -> str:
    return f"""SELECT '{key}' AS key, *, CASE WHEN n_right < n_left THEN 'WARNING' WHEN n_left < n_right THEN 'ERROR' ELSE 'OK' END AS level
FROM (SELECT (SELECT count(DISTINCT {key}) FROM {left}) AS n_left, (SELECT count(DISTINCT {key}) FROM {right}) AS n_right)"""


def _checks(table: str, rules: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{n}' AS \"check\", '{level}' AS level, ({f'SELECT count(*) FROM {table} WHERE {rule}' if not rule.startswith('SELECT') else rule}) AS n" for n, level, rule in rules)


SQL = {
    "scan_union": """SELECT success, error_message, count(*) AS n_rows, count(DISTINCT input_compound_id) AS n_compounds
FROM (SELECT input_compound_id, success, error_message FROM sn_fold_output UNION ALL SELECT input_compound_id, NULL, NULL FROM test_standardizer) GROUP BY 1, 2""",
    "structures_failed": "SELECT input_compound_id, smiles, error_message FROM sn_fold_output WHERE NOT coalesce(success, FALSE)",
    "joined_measurements": _VALUES + "SELECT assay_type, is_binary, reject, count(*) AS n_rows, count(descriptor_vector_id) AS n_vectors FROM c GROUP BY 1, 2, 3",
    "credibility_range_failed": _VALUES + "SELECT input_compound_id, input_assay_id, standard_qualifier, standard_value FROM c WHERE reject = 'range'",
    "binary_failed": _VALUES + "SELECT input_compound_id, input_assay_id, standard_qualifier, standard_value FROM c WHERE reject = 'binary'",
    "mapped_qualifiers": _VALUES + "SELECT standard_qualifier AS qualifier, q AS mapped, count(*) AS n_rows FROM mapped GROUP BY 1, 2",
    "duplicates_t1": _VALUES
    + """SELECT input_assay_id, input_compound_id, descriptor_vector_id, fold_id, q AS standard_qualifier, standard_value FROM acc
QUALIFY count(*) OVER (PARTITION BY input_assay_id, descriptor_vector_id, fold_id) > 1""",
    "replicate_candidates": _VALUES
    + """SELECT input_assay_id, descriptor_vector_id, fold_id, median_value, median_qualifier, least_value, least_qualifier, most_value, most_qualifier,
  largest_value, largest_qualifier, mode_value FROM candidates""",
    "replicate_aggregation": _VALUES + "SELECT * FROM t4r",
    "failed_aggregation": _VALUES + "SELECT descriptor_vector_id, input_assay_id, standard_qualifier, standard_value, fold_id FROM grouped WHERE standard_qualifier IS NULL",
    "failed_std": _VALUES
    + "SELECT descriptor_vector_id, input_assay_id, standard_qualifier, standard_value, fold_id FROM valued WHERE input_assay_id IN (SELECT input_assay_id FROM variance WHERE flat AND NOT catalog)",
    "t0_updated": _VALUES + "SELECT * FROM u",
    "assay_thresholds": _TASKS + "SELECT * FROM stats",
    "t3c": _TASKS + "SELECT * FROM t3c",
    "t4c": _TASKS + "SELECT * FROM t4c",
    "t4c_failed": _TASKS + "SELECT * FROM all_labels WHERE class_label IS NULL",
    "class_counts": _CLASSES + "SELECT * FROM class_counts",
    "t8c": _CLASSES + "SELECT * FROM t8c",
    "t8c_assays": _CLASSES + "SELECT t8c.*, a.parent_assay_id FROM t8c LEFT JOIN a USING (input_assay_id)",
    "t10c": _CLASSES + "SELECT * FROM t10c",
    "t4c_filtered_out": _CLASSES + "SELECT * FROM t4c WHERE classification_task_id NOT IN (SELECT classification_task_id FROM numbered)",
    "t4c_duplicates": _CLASSES + "SELECT * FROM kept QUALIFY count(*) OVER (PARTITION BY cont_classification_task_id, descriptor_vector_id) > 1",
    "regression_counts": _VALUES + _REGRESSION + "SELECT * FROM regression_counts",
    "fold_std_min": _VALUES + _REGRESSION + "SELECT input_assay_id, round(std_min, 6) AS std_min FROM fold_std",
    "t8r": _VALUES + _REGRESSION + "SELECT * FROM t8r",
    "t10r": _VALUES + _REGRESSION + "SELECT * FROM t10r",
    "t4r_filtered_out": _VALUES + _REGRESSION + "SELECT * FROM t4r WHERE input_assay_id NOT IN (SELECT input_assay_id FROM regression_numbers)",
    "t4r_duplicates": _VALUES
    + _REGRESSION
    + """SELECT input_assay_id, descriptor_vector_id, fold_id, standard_qualifier, standard_value, cont_regression_task_id FROM kept_r
QUALIFY count(*) OVER (PARTITION BY cont_regression_task_id, descriptor_vector_id) > 1""",
    "type_counts_classification": _CLASSES + "SELECT assay_type, count(DISTINCT input_assay_id) AS n_assays, count(*) AS n_tasks FROM t8c WHERE cont_classification_task_id IS NOT NULL GROUP BY 1",
    "type_counts_regression": _VALUES + _REGRESSION + "SELECT assay_type, count(DISTINCT input_assay_id) AS n_assays, count(*) AS n_tasks FROM t8r WHERE cont_regression_task_id IS NOT NULL GROUP BY 1",
    "classification_weights": _CLASSES
    + """SELECT CAST(cont_classification_task_id AS INT) AS task_id, catalog_task_id AS catalog_id, assay_type AS task_type, weight AS training_weight, aggregation_weight
FROM t8c WHERE cont_classification_task_id IS NOT NULL""",
    "regression_weights": _VALUES
    + _REGRESSION
    + """SELECT CAST(cont_regression_task_id AS INT) AS task_id, assay_type AS task_type, weight AS training_weight, aggregation_weight, censored_weight
FROM t8r WHERE cont_regression_task_id IS NOT NULL""",
    "row_numbers": _CONT + "SELECT * FROM row_numbers",
    "x_coo": _CONT + "SELECT * FROM x",
    "x_coo_dense": _CONT + 'SELECT "row", dense_rank() OVER (ORDER BY col) - 1 AS col, value FROM x',
    "fold_vector": _CONT + 'SELECT DISTINCT cont_descriptor_vector_id AS "row", fold_id FROM test_calculate_desc_t6 JOIN row_numbers USING (descriptor_vector_id)',
    "y_classification_coo": _CONT
    + """SELECT cont_descriptor_vector_id AS "row", cont_classification_task_id AS col, CAST(sum(class_label) AS FLOAT) AS value
FROM t10c JOIN row_numbers USING (descriptor_vector_id) WHERE class_label <> 0 GROUP BY 1, 2""",
    "y_regression_coo": _CONT
    + """SELECT cont_descriptor_vector_id AS "row", cont_regression_task_id AS col, CAST(sum(CAST(standard_value AS FLOAT)) AS FLOAT) AS value
FROM t10r JOIN row_numbers USING (descriptor_vector_id) GROUP BY 1, 2""",
    "censor_mask": _CONT
    + """SELECT cont_descriptor_vector_id AS "row", cont_regression_task_id AS col, CASE standard_qualifier WHEN '<' THEN -1 WHEN '=' THEN 0 WHEN '>' THEN 1 END AS value
FROM t10r JOIN row_numbers USING (descriptor_vector_id)""",
    "descriptor_t5": _IDS + "SELECT input_compound_id, fold_id, descriptor_vector_id FROM numbered",
    "descriptor_t6": _IDS + "SELECT DISTINCT descriptor_vector_id, fp_feat, fp_val, fold_id FROM numbered",
    "descriptor_duplicates": _IDS
    + "SELECT input_compound_id, canonical_smiles, fp_feat, fp_val, fold_id, descriptor_vector_id FROM numbered QUALIFY count(*) OVER (PARTITION BY descriptor_vector_id) > 1",
    "prediction_ids": """
WITH n AS (SELECT *, dense_rank() OVER (ORDER BY input_compound_id) AS descriptor_vector_id FROM (SELECT DISTINCT input_compound_id, fp_feat FROM test_desc_duplicates)),
d AS (SELECT descriptor_vector_id, dense_rank() OVER (ORDER BY descriptor_vector_id) - 1 AS cont_descriptor_vector_id FROM (SELECT DISTINCT descriptor_vector_id FROM n WHERE fp_feat IS NOT NULL))
SELECT DISTINCT input_compound_id, descriptor_vector_id, cont_descriptor_vector_id FROM n LEFT JOIN d USING (descriptor_vector_id)""",
    "hmac_permutation": _PERMUTATION + f"SELECT DISTINCT CAST(feature AS BIGINT) AS feature, scrambled FROM (SELECT DISTINCT unnest({_FEATS}) AS feature FROM test_calculate_desc_t6) JOIN permutation USING (feature)",
    "scrambled_features": _PERMUTATION
    + """, parts AS (SELECT DISTINCT descriptor_vector_id, regexp_extract_all(fp_feat, '[0-9]+') AS f FROM test_calculate_desc_duplicates),
each AS (SELECT descriptor_vector_id, f, unnest(list_transform(f, lambda x: CAST(x AS BIGINT))) AS feature FROM parts)
SELECT DISTINCT descriptor_vector_id, fp_feat FROM (
  SELECT descriptor_vector_id, f, '[' || string_agg(scrambled, ', ' ORDER BY scrambled) || ']' AS fp_feat FROM each JOIN permutation USING (feature) GROUP BY 1, 2)""",
    "lsh_bits": f"""SELECT DISTINCT descriptor_vector_id, array_to_string(list_transform([{", ".join(map(str, CONFIG.lsh_bits))}],
  lambda b: CASE WHEN list_contains(regexp_extract_all(fp_feat, '[0-9]+'), CAST(b AS VARCHAR)) THEN '1' ELSE '0' END), '') AS lsh FROM test_calculate_desc_duplicates""",
    "informative_bits": f"""
WITH r AS (SELECT descriptor_vector_id, any_value({_FEATS}) AS f FROM test_calculate_desc_t6 GROUP BY 1),
s AS (SELECT feat, count(*) / (SELECT count(*) FROM r) AS share FROM (SELECT unnest(list_distinct(f)) AS feat FROM r) GROUP BY 1)
SELECT feat, round(share, 9) AS share FROM s WHERE share > 0.1 AND share < 0.9""",
    "check_t0": _VALUES
    + _checks(
        "a",
        [
            ("assay_type unknown", "ERROR", f"assay_type NOT IN {_in(ASSAY_TYPES)}"),
            ("assay_type null", "ERROR", "assay_type IS NULL"),
            ("use_in_regression null", "ERROR", "use_in_regression IS NULL"),
            ("is_binary null", "ERROR", "is_binary IS NULL"),
            ("catalog id on other type", "ERROR", "catalog_assay_id IS NOT NULL AND assay_type <> 'CATALOG-PANEL'"),
            ("AUX_PL not binary", "ERROR", "assay_type = 'AUX_PL' AND NOT is_binary"),
            ("binary in regression", "WARNING", "is_binary AND use_in_regression"),
            ("input_assay_id repeated", "ERROR", "SELECT count(*) - count(DISTINCT input_assay_id) FROM a"),
            ("catalog_assay_id repeated", "ERROR", "SELECT count(*) - count(DISTINCT catalog_assay_id) FROM a WHERE assay_type = 'CATALOG-PANEL' AND catalog_assay_id IS NOT NULL"),
        ],
    ),
    "check_t1": _checks(
        "t1",
        [
            ("input_assay_id null", "ERROR", "input_assay_id IS NULL"),
            ("input_compound_id null", "ERROR", "input_compound_id IS NULL"),
            ("standard_value null", "ERROR", "standard_value IS NULL OR isnan(standard_value)"),
            ("standard_value infinite", "WARNING", "isinf(standard_value)"),
        ],
    ),
    "check_t2": _checks(
        "test_standardizer",
        [("smiles null", "ERROR", "smiles IS NULL"), ("input_compound_id repeated", "ERROR", "SELECT count(*) - count(DISTINCT input_compound_id) FROM test_standardizer")],
    ),
    "check_assay_types": f"""
WITH k AS (SELECT unnest([{", ".join(f"'{t}'" for t in ASSAY_TYPES)}]) AS assay_type), s AS (SELECT trim(assay_type) AS assay_type, count(*) AS n FROM t0 GROUP BY 1)
SELECT coalesce(s.assay_type, k.assay_type) AS assay_type, coalesce(n, 0) AS n,
  CASE WHEN s.assay_type IS NULL AND k.assay_type IS NULL THEN 'ERROR' WHEN k.assay_type IS NULL THEN 'WARNING' WHEN n IS NULL THEN CASE WHEN k.assay_type IN {_in(AUXILIARY_TYPES)} THEN 'ERROR' ELSE 'INFO' END ELSE 'OK' END AS level
FROM s FULL JOIN k ON s.assay_type = k.assay_type""",
    "check_assay_sizes": _sizes("t0", "t1", "input_assay_id"),
    "check_compound_sizes": _sizes("t1", "test_desc_duplicates", "input_compound_id"),
    "assays_without_values": "SELECT input_assay_id FROM t0 WHERE input_assay_id NOT IN (SELECT input_assay_id FROM t1 WHERE input_assay_id IS NOT NULL)",
    "common_compounds": "SELECT input_compound_id FROM t1 INTERSECT SELECT input_compound_id FROM test_desc_duplicates INTERSECT SELECT input_compound_id FROM test_calculate_desc_t5",
    "structures_not_measured": "SELECT DISTINCT input_compound_id FROM test_desc_duplicates WHERE input_compound_id NOT IN (SELECT input_compound_id FROM t1 WHERE input_compound_id IS NOT NULL)",
    "label_modes": _LABELS
    + """SELECT classification_task_id, descriptor_vector_id, greatest(n0, n1) AS mode_count, CASE WHEN n0 = n1 THEN '0,1' WHEN n0 > n1 THEN '0' ELSE '1' END AS modes FROM tallied""",
    "resolved_labels": _LABELS
    + """SELECT classification_task_id, descriptor_vector_id, CASE WHEN n0 > n1 THEN -1 WHEN n0 < n1 THEN 1
  WHEN (SELECT sum(n0) < sum(n1) FROM tallied) THEN -1 ELSE 1 END AS class_label FROM tallied""",
    "tasks_with_both": _TASKS
    + """SELECT classification_task_id, count(*) FILTER (class_label = -1) AS n_inactive, count(*) FILTER (class_label = 1) AS n_active FROM t4c GROUP BY 1
HAVING count(*) FILTER (class_label = -1) >= 5 AND count(*) FILTER (class_label = 1) >= 5""",
    "fold_label_counts": _TASKS
    + """SELECT classification_task_id, fold_id, count(*) FILTER (class_label = -1) AS n_inactive, count(*) FILTER (class_label = 1) AS n_active
FROM (SELECT * FROM (SELECT DISTINCT classification_task_id FROM t4c), (SELECT DISTINCT fold_id FROM t4c)) LEFT JOIN t4c USING (classification_task_id, fold_id) GROUP BY 1, 2""",
}

SQL["scaffold_fold_check"] = """SELECT coalesce(sn_smiles, 'None') AS text, count(*) AS n_rows, 1 AS n_folds, TRUE AS in_range
FROM (SELECT DISTINCT input_compound_id, sn_smiles FROM test_desc_duplicates WHERE success) GROUP BY 1"""
SQL["lsh_fold_check"] = f"SELECT lsh AS text, count(*) AS n_rows, 1 AS n_folds, TRUE AS in_range FROM ({SQL['lsh_bits']}) GROUP BY 1"
