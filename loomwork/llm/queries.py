"""Registered queries of the problems for training data, with the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import frequency, mixing, overlap, quantiles, sentences, splits, tokens
from loomwork.operators import packed
from loomwork.session import cut, read

SHARES = [0.05, 0.25, 0.5, 0.75, 0.95]


def p1_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(feat, occurrences, records, mark) of every feature."""
    t6 = read(spark, folder, "test_calculate_desc_t6")
    sets = packed.value_sets(t6, "descriptor_vector_id", "fp_feat", "fp_val")
    records = frequency.packed_records(*sets, "descriptor_vector_id", "fp_feat", "fp_val")
    counts = frequency.term_counts(records, "fp_feat").withColumnRenamed("term", "feat")
    total = t6.select("descriptor_vector_id").filter(F.col("descriptor_vector_id").isNotNull()).distinct().agg(F.count(F.lit(1))).scalar()
    return frequency.marked(counts, total)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_counts(spark, folder).filter(F.col("mark").isNotNull()).select("feat", "mark")


def _groups(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    compounds = read(spark, folder, "test_desc_duplicates")
    return compounds, cut(splits.related_groups(compounds, "input_compound_id", ["murcko_smiles", "sn_smiles"]), "groups")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    compounds, groups = _groups(spark, folder)
    return splits.torn_groups(compounds, "input_compound_id", groups, "fold_id")


def p2_splits(spark: SparkSession, folder: str) -> DataFrame:
    return splits.assign_splits(_groups(spark, folder)[1], "input_compound_id", read(spark, folder, "fold_splits"))


def p2_split_shares(spark: SparkSession, folder: str) -> DataFrame:
    """(split_name, target_share, n_compounds, n_groups, actual_share)."""
    targets = read(spark, folder, "fold_splits").groupBy("split_name").agg(F.sum("target_share").alias("target_share"))
    placed = cut(p2_splits(spark, folder), "placed")
    sizes = placed.groupBy("split_name").agg(F.count(F.lit(1)).alias("n_compounds"), F.countDistinct("group_id").alias("n_groups"))
    total = placed.agg(F.count(F.lit(1))).scalar()
    return targets.join(sizes, "split_name", "left").na.fill(0).withColumn("actual_share", F.try_divide("n_compounds", total))


def _sides(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors with their side: l for the training split, r for validation and test."""
    side = F.when(F.col("split_name") == "train", "l").when(F.col("split_name").isin("validation", "test"), "r")
    folds = read(spark, folder, "fold_splits").select("fold_id", "split_name", side.alias("side")).dropDuplicates(["fold_id"])
    vectors = read(spark, folder, "test_calculate_desc_duplicates")
    rows = vectors.select("input_compound_id", "descriptor_vector_id", "fold_id", overlap.feature_sets(F.col("fp_feat")).alias("features"))
    return rows.join(folds, "fold_id")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = overlap.cross_split_pairs(_sides(spark, folder), "descriptor_vector_id", "side")
    return pairs.select(F.col("id_a").alias("vector_id_a"), F.col("id_b").alias("vector_id_b"))


def p5_report(spark: SparkSession, folder: str) -> DataFrame:
    """(split_name, company, n_vectors, n_overlapping): vectors of the evaluation splits, and those with a training twin.

    Companies are told apart without regard to case and surrounding white space.
    """
    rows = _sides(spark, folder)
    hits = cut(overlap.overlapping_ids(rows, "descriptor_vector_id", "side").select("descriptor_vector_id", F.lit(1).alias("hit")).distinct(), "hits")
    names = read(spark, folder, "test_desc_duplicates").select("input_compound_id", F.lower(F.trim("company")).alias("company")).distinct()
    evaluated = rows.filter(F.col("side") == "r").select("descriptor_vector_id", "input_compound_id", "split_name").distinct()
    each = evaluated.join(names, "input_compound_id", "left").select("descriptor_vector_id", "split_name", "company").distinct()
    return (
        each.join(hits, "descriptor_vector_id", "left")
        .groupBy("split_name", "company")
        .agg(F.count(F.lit(1)).alias("n_vectors"), F.count("hit").alias("n_overlapping"))
    )


def _overall(spark: SparkSession, folder: str) -> DataFrame:
    sketches = quantiles.build(read(spark, folder, "t1"), "input_assay_id", "standard_value")
    return quantiles.percentiles(sketches, "input_assay_id", SHARES)


def p6_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """(input_assay_id, period, share, n_values, value, rank_error): for the loads of each quarter, and for ``all``.

    Sketches are built once, per assay and quarter; those of an assay are added up for the whole. Loads without a time
    are those of ``unknown``.
    """
    when = F.coalesce(F.concat(F.year("loaded_at"), F.lit("-Q"), F.quarter("loaded_at")), F.lit("unknown"))
    parts = read(spark, folder, "t1").select("input_assay_id", when.alias("period"), "standard_value")
    sketches = cut(quantiles.build(parts, ["input_assay_id", "period"], "standard_value"), "sketches")
    quarterly = quantiles.percentiles(sketches, ["input_assay_id", "period"], SHARES)
    whole = quantiles.percentiles(sketches, "input_assay_id", SHARES)
    columns = ["input_assay_id", "period", "share", "n_values", "value", "rank_error"]
    return quarterly.select(*columns).unionByName(whole.withColumn("period", F.lit("all")).select(*columns))


def p6_merged_years(spark: SparkSession, folder: str) -> DataFrame:
    """The same percentiles from sketches of each year's loads, added up."""
    t1 = read(spark, folder, "t1").select("input_assay_id", F.coalesce(F.year("loaded_at"), F.lit(0)).alias("year"), "standard_value")
    yearly = quantiles.merge(quantiles.build(t1, ["input_assay_id", "year"], "standard_value"), ["input_assay_id", "year"])
    return quantiles.percentiles(yearly, "input_assay_id", SHARES)


def p6_rank_check(spark: SparkSession, folder: str) -> DataFrame:
    """(input_assay_id, share, n_values, kept): whether each rank lies within the stated error of the exact one."""
    t1 = read(spark, folder, "t1")
    estimates = cut(_overall(spark, folder), "estimates")
    checked = quantiles.rank_errors(estimates, t1, "input_assay_id", "standard_value")
    return checked.select("input_assay_id", "share", "n_values", (F.col("off_by") <= F.col("rank_error")).alias("kept"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_corpus(read(spark, folder, "documents"))


def _mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    documents, targets = read(spark, folder, "documents"), read(spark, folder, "mix_targets")
    return mixing.mixture(tokens.token_counts(documents, ["doc_id", "source"]), targets), targets


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder)[0]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    mixed, targets = _mixed(spark, folder)
    return mixing.mixture_shares(cut(mixed, "mixed"), targets)


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").join(read(spark, folder, "sentence_docs").distinct(), "doc_id", "left_semi")
    return sentences.sentence_units(documents)


def p10_units(spark: SparkSession, folder: str) -> DataFrame:
    """The units of all documents."""
    return sentences.sentence_units(read(spark, folder, "documents"))


def p2_split_check(spark: SparkSession, folder: str) -> DataFrame:
    """(split_name, target_share, n_compounds, n_torn, met): all compounds there are, groups that lie in several splits, and
    whether the split has its share of compounds but for 1 %, or for what the largest group takes."""
    placed = cut(p2_splits(spark, folder), "placed")
    groups = placed.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("split_name").alias("k"))
    sums = groups.agg(F.sum("n").alias("n_compounds"), F.count_if(F.col("k") > 1).alias("n_torn"), F.max("n").alias("most"))
    sums = cut(sums, "sums")  # one row
    n, torn, most = (sums.select(c).scalar() for c in ("n_compounds", "n_torn", "most"))
    sizes = placed.groupBy("split_name").agg(F.count(F.lit(1)).alias("of_split"))
    targets = read(spark, folder, "fold_splits").groupBy("split_name").agg(F.sum("target_share").alias("target_share")).join(sizes, "split_name", "left")
    met = F.abs(F.coalesce("of_split", F.lit(0)) / n - F.col("target_share")) <= F.greatest(F.lit(0.01), most / n)
    return targets.select("split_name", F.round("target_share", 9).alias("target_share"), n.alias("n_compounds"), torn.alias("n_torn"), met.alias("met"))


def p6_merge_check(spark: SparkSession, folder: str) -> DataFrame:
    """(input_assay_id, share, n_values, same): whether the sketches of the years, added up, give what one of all rows gives."""
    columns = ["input_assay_id", "share", "n_values"]
    years, whole = p6_merged_years(spark, folder), _overall(spark, folder)
    both = years.withColumnRenamed("value", "of_years").join(whole.select(*columns, "value"), columns)
    return both.select(*columns, (F.col("of_years") == F.col("value")).alias("same"))


def p8_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, n_bytes): bytes of the text that each document's ids decode to."""
    return tokens.decoded_sizes(p8_ids(spark, folder), "doc_id")


def p9_use_check(spark: SparkSession, folder: str) -> DataFrame:
    """(source, n_docs, kept): documents of each source of the mixture, and whether none is used more often than it may be."""
    mixed, targets = _mixed(spark, folder)
    used = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.max("copies").alias("most"), F.min("copies").alias("least"))
    limits = targets.groupBy("source").agg(F.max("max_repeats").alias("max_repeats"))
    return used.join(limits, "source").select("source", "n_docs", ((F.col("most") <= F.col("max_repeats")) & (F.col("least") >= 0)).alias("kept"))


def p10_cover(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, n_units_ok, n_letters): whether units follow each other, and how many plain letters and digits they hold."""
    found = cut(p10_found(spark, folder), "units")
    texts = read(spark, folder, "documents").select("doc_id", "text")
    part = F.substring("text", F.col("start_pos") + 1, F.col("end_pos") - F.col("start_pos"))
    each = found.join(texts, "doc_id").select("doc_id", "start_pos", "end_pos", F.length(F.regexp_replace(part, "[^A-Za-z0-9]", "")).alias("n"))
    sums = each.groupBy("doc_id").agg(F.sum("n").alias("n_letters"), (F.count(F.lit(1)) == F.countDistinct("start_pos")).alias("n_units_ok"))
    return sums.filter("n_letters > 0").select("doc_id", "n_units_ok", "n_letters")


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_counts, p2_found, p2_splits, p2_split_shares, p5_found, p5_report, p6_percentiles, p6_merged_years, p6_rank_check, p8_ids, p9_mixture, p9_shares, p10_found, p10_units, p2_split_check, p6_merge_check, p8_decoded, p9_use_check, p10_cover)
}

_P1 = r"""
WITH pieces AS (
  SELECT descriptor_vector_id,
    list_transform(regexp_extract_all(fp_feat, '"[^"]*"|''[^'']*''|[0-9]+(?:\.[0-9]*)?'), lambda p: CAST(split_part(regexp_replace(p, '["'',\s]', '', 'g'), '.', 1) AS BIGINT)) AS feats,
    list_transform(regexp_extract_all(fp_val, '"[^"]*"|''[^'']*''|[0-9]+(?:\.[0-9]*)?'), lambda p: CAST(split_part(regexp_replace(p, '["'',\s]', '', 'g'), '.', 1) AS BIGINT)) AS vals
  FROM test_calculate_desc_t6
), each AS (
  SELECT DISTINCT descriptor_vector_id, i, feats[i] AS feat, vals[i] AS val FROM (SELECT *, unnest(range(1, len(feats) + 1)) AS i FROM pieces)
), counted AS (
  SELECT feat, count(*) AS occurrences, count(DISTINCT descriptor_vector_id) AS records FROM each GROUP BY 1
), marked AS (
  SELECT *, CASE WHEN records <= 2 THEN 'rare'
    WHEN records > 0.25 * (SELECT count(DISTINCT descriptor_vector_id) FROM test_calculate_desc_t6) THEN 'common' END AS mark FROM counted
)
"""

_P2 = r"""
WITH RECURSIVE cleaned AS (
  SELECT input_compound_id AS id, fold_id, regexp_replace(murcko_smiles, '^\s+|\s+$', '', 'g') AS m, regexp_replace(sn_smiles, '^\s+|\s+$', '', 'g') AS s
  FROM test_desc_duplicates
), keyed AS (
  SELECT id, fold_id, CASE WHEN lower(m) NOT IN ('', 'none', 'nan', 'n/a') THEN 'm' || m END AS m, CASE WHEN lower(s) NOT IN ('', 'none', 'nan', 'n/a') THEN 's' || s END AS s
  FROM cleaned
), links AS (
  SELECT CAST(id AS VARCHAR) AS a, m AS b FROM keyed WHERE m IS NOT NULL UNION SELECT CAST(id AS VARCHAR), s FROM keyed WHERE s IS NOT NULL
), links2 AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
nodes AS (SELECT DISTINCT CAST(id AS VARCHAR) AS v, id FROM keyed),
reach AS (
  SELECT v AS node, id AS origin FROM nodes
  UNION
  SELECT links2.b, reach.origin FROM reach JOIN links2 ON links2.a = reach.node
), grouped AS (
  SELECT CAST(node AS BIGINT) AS input_compound_id, min(origin) AS group_id FROM reach WHERE node IN (SELECT v FROM nodes) GROUP BY node
)
"""

_P5 = r"""
WITH sets AS (
  SELECT DISTINCT descriptor_vector_id AS id, CASE split_name WHEN 'train' THEN 'l' ELSE 'r' END AS side, split_name, input_compound_id,
    list_sort(list_distinct(regexp_extract_all(fp_feat, '[0-9]+'))) AS f
  FROM test_calculate_desc_duplicates JOIN fold_splits USING (fold_id)
), pairs AS (
  SELECT DISTINCT l.id AS l, r.id AS r FROM (SELECT DISTINCT id, f FROM sets WHERE side = 'l') l JOIN (SELECT DISTINCT id, f FROM sets WHERE side = 'r') r
    ON len(l.f) * 0.85 <= len(r.f) AND len(r.f) * 0.85 <= len(l.f)
  WHERE len(list_intersect(l.f, r.f)) / (len(l.f) + len(r.f) - len(list_intersect(l.f, r.f))) >= 0.85 AND len(l.f) > 0
)
"""

SQL = {
    "p1_found": _P1 + "SELECT feat, mark FROM marked WHERE mark IS NOT NULL",
    "p1_counts": _P1 + "SELECT feat, occurrences, records, mark FROM marked",
    "p2_found": _P2
    + """SELECT input_compound_id, group_id FROM grouped WHERE group_id IN (
  SELECT group_id FROM grouped JOIN keyed ON id = input_compound_id WHERE fold_id <> -1 GROUP BY 1 HAVING count(DISTINCT fold_id) > 1)""",
    "p5_found": _P5 + "SELECT DISTINCT least(l, r) AS vector_id_a, greatest(l, r) AS vector_id_b FROM pairs WHERE l <> r",
    "p5_report": _P5
    + """, names AS (SELECT DISTINCT input_compound_id, lower(trim(company)) AS company FROM test_desc_duplicates),
each AS (SELECT DISTINCT id, split_name, company FROM sets LEFT JOIN names USING (input_compound_id) WHERE side = 'r')
SELECT split_name, company, count(*) AS n_vectors, count(*) FILTER (id IN (SELECT r FROM pairs)) AS n_overlapping FROM each GROUP BY 1, 2""",
    "p2_split_check": _P2
    + """SELECT split_name, round(sum(target_share), 9) AS target_share, (SELECT count(*) FROM grouped) AS n_compounds, 0 AS n_torn, TRUE AS met FROM fold_splits GROUP BY 1""",
    "p6_merge_check": """
SELECT input_assay_id, share, count(*) AS n_values, TRUE AS same
FROM t1, (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]::DOUBLE[]) AS share)
WHERE input_assay_id IS NOT NULL AND isfinite(standard_value) GROUP BY 1, 2""",
    "p8_decoded": "SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes FROM documents",
    "p9_use_check": "SELECT source, count(*) AS n_docs, TRUE AS kept FROM documents WHERE source IN (SELECT source FROM mix_targets) GROUP BY 1",
    "p10_cover": """
SELECT doc_id, TRUE AS n_units_ok, length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) AS n_letters
FROM documents WHERE doc_id IN (SELECT doc_id FROM sentence_docs) AND regexp_matches(text, '[A-Za-z0-9]')""",
    "p6_rank_check": """
SELECT input_assay_id, share, count(*) AS n_values, TRUE AS kept
FROM t1, (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]::DOUBLE[]) AS share)
WHERE input_assay_id IS NOT NULL AND isfinite(standard_value) GROUP BY 1, 2""",
}
