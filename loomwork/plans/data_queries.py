"""Registered queries of the general problems 3, 4 and 7, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.operators import packed, skew
from loomwork.session import read
from loomwork.sources import raw_lines


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return raw_lines.rejected(read(spark, folder, "raw_lines"), ("line_id",)).select("line_id", "reason")


def p3_standardizer_rows(spark: SparkSession, folder: str) -> DataFrame:
    return raw_lines.loaded(read(spark, folder, "raw_lines"), "test_standardizer", ("line_id",))


def p3_fold_rows(spark: SparkSession, folder: str) -> DataFrame:
    return raw_lines.loaded(read(spark, folder, "raw_lines"), "sn_fold_output", ("line_id",))


def p3_reject_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = raw_lines.classify(read(spark, folder, "raw_lines"))
    return rows.groupBy("file_kind", F.coalesce("reason", F.lit("loaded")).alias("outcome")).agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("file_name").alias("n_files"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return packed.value_rows(read(spark, folder, "test_calculate_desc_t6"), "descriptor_vector_id", "fp_feat", "fp_val")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return skew.keys_above(read(spark, folder, "t1"), "input_assay_id", 0.02).select("input_assay_id")


def p7_assay_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Means and deviations to nine digits, as sums of doubles depend on their order."""
    found = skew.value_statistics(read(spark, folder, "t1"), "input_assay_id", "standard_value")
    return found.withColumns({c: F.format_string("%.8e", c).cast("double") for c in ("mean_value", "std_value")}).withColumns({c: F.when(F.col("n_values") > n, F.col(c)) for c, n in (("mean_value", 0), ("std_value", 1))})


QUERIES = {f.__name__: f for f in (p3_found, p3_standardizer_rows, p3_fold_rows, p3_reject_report, p4_found, p7_found, p7_assay_statistics)}

_FIELD = '(?:"(?:[^"]|"")*"|[^",]*)'
_ATOM = r"(?:Cl|Br|[BCNOPSFIbcnosp]|\[[^\[\]\s]+\])"


def _well_formed(c: str) -> str:
    bare = rf"regexp_replace(coalesce({c}, ''), '\[[^\[\]\s]+\]', '', 'g')"
    rings = f"list_transform(regexp_extract_all({bare}, '%[0-9][0-9]|[0-9]'), lambda t: CAST(ltrim(t, '%') AS INT))"
    marks = f"regexp_replace({bare}, '[^()]', '', 'g')"
    return rf"""(regexp_full_match(coalesce({c}, ''), '{_ATOM}(?:{_ATOM}|[-=#:/\\.()]|%[0-9][0-9]|[0-9])*')
      AND len(list_filter(list_distinct({rings}), lambda r: len(list_filter({rings}, lambda x: x = r)) % 2 = 1)) = 0
      AND 2 * length(replace({marks}, ')', '')) = length({marks})
      AND coalesce(list_min(list_transform(range(1, length({marks}) + 1), lambda i: 2 * length(replace({marks}[1:i], ')', '')) - i)), 0) >= 0)"""


_LINES = rf"""
WITH parts AS (
  SELECT line_id, file_kind, file_name, line,
    coalesce(regexp_full_match(line, '{_FIELD}(?:,{_FIELD})*'), TRUE) AS quoted,
    list_transform(regexp_extract_all(',' || line, ',{_FIELD}'),
      lambda f: regexp_replace(CASE WHEN f[2:2] = '"' THEN replace(f[3:length(f) - 1], '""', '"') ELSE f[2:] END, '^\s+|\s+$', '', 'g')) AS f
  FROM raw_lines
), named AS (
  SELECT line_id, file_kind, file_name, quoted, file_kind = 'test_standardizer' AS simple, len(f) AS n,
    CASE WHEN file_kind = 'test_standardizer' THEN f[1] ELSE f[2] END AS id,
    CASE WHEN file_kind = 'test_standardizer' THEN f[2] ELSE f[3] END AS smiles,
    f[1] AS idx, f[4] AS canonical, lower(f[5]) AS success, f[6] AS message
  FROM parts
), tested AS (
  SELECT *, {_well_formed("smiles")} AS good, {_well_formed("canonical")} AS good_canonical FROM named
), judged AS (
  SELECT line_id, file_kind, file_name, id, smiles, idx, canonical, success, message,
    CASE WHEN NOT quoted THEN 'quoting'
      WHEN n IS NULL OR n <> CASE WHEN simple THEN 2 ELSE 6 END THEN 'columns'
      WHEN NOT regexp_full_match(id, 'CMP[0-9]+') THEN 'value'
      WHEN simple THEN CASE WHEN good THEN NULL ELSE 'value' END
      WHEN NOT regexp_full_match(idx, '[0-9]+') OR success NOT IN ('true', 'false') THEN 'value'
      WHEN success = 'true' AND NOT (good AND good_canonical AND message = '') THEN 'value'
      WHEN success = 'false' AND (message = '' OR canonical <> '') THEN 'value' END AS reason
  FROM tested
)
"""

SQL = {
    "p3_found": _LINES + "SELECT line_id, reason FROM judged WHERE reason IS NOT NULL",
    "p3_standardizer_rows": _LINES + "SELECT line_id, id AS input_compound_id, smiles FROM judged WHERE reason IS NULL AND file_kind = 'test_standardizer'",
    "p3_fold_rows": _LINES
    + """SELECT line_id, CAST(idx AS BIGINT) AS idx, id AS input_compound_id, nullif(smiles, '') AS smiles, nullif(canonical, '') AS canonical_smiles,
  success = 'true' AS success, nullif(message, '') AS error_message FROM judged WHERE reason IS NULL AND file_kind = 'sn_fold_output'""",
    "p3_reject_report": _LINES
    + "SELECT file_kind, coalesce(reason, 'loaded') AS outcome, count(*) AS n_lines, count(DISTINCT file_name) AS n_files FROM judged GROUP BY 1, 2",
    "p4_found": r"""
WITH pieces AS (
  SELECT descriptor_vector_id,
    list_transform(regexp_extract_all(fp_feat, '"[^"]*"|''[^'']*''|[0-9]+(?:\.[0-9]*)?'), lambda p: CAST(split_part(regexp_replace(p, '["'',\s]', '', 'g'), '.', 1) AS BIGINT)) AS feats,
    list_transform(regexp_extract_all(fp_val, '"[^"]*"|''[^'']*''|[0-9]+(?:\.[0-9]*)?'), lambda p: CAST(split_part(regexp_replace(p, '["'',\s]', '', 'g'), '.', 1) AS BIGINT)) AS vals
  FROM test_calculate_desc_t6
)
SELECT DISTINCT descriptor_vector_id, CAST(i - 1 AS INT) AS pos, feats[i] AS feat, vals[i] AS val
FROM (SELECT *, unnest(range(1, len(feats) + 1)) AS i FROM pieces)""",
    "p7_found": "SELECT input_assay_id FROM t1 WHERE input_assay_id IS NOT NULL GROUP BY 1 HAVING count(*) > 0.02 * (SELECT count(*) FROM t1)",
    "p7_assay_statistics": """
WITH v AS (SELECT input_assay_id, CASE WHEN isfinite(standard_value) THEN standard_value END AS x FROM t1)
SELECT input_assay_id, count(*) AS n_rows, count(x) AS n_values, min(x) AS min_value, max(x) AS max_value,
  CAST(printf('%.8e', CASE WHEN min(x) = max(x) THEN min(x) ELSE avg(x) END) AS DOUBLE) AS mean_value,
  CASE WHEN count(x) > 1 THEN CAST(printf('%.8e', CASE WHEN min(x) = max(x) THEN 0.0 ELSE stddev_samp(x) END) AS DOUBLE) END AS std_value
FROM v GROUP BY 1""",
}
