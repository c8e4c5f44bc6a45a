import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.config import Config
from loomwork.functions import keyed
from loomwork.operators import aggregate, checks, features, ids, labels, matrix, quorum, threshold
from loomwork.sources import tables

T0 = "input_assay_id bigint, assay_type string, use_in_regression boolean, is_binary boolean, expert_threshold_1 double, expert_threshold_2 double, expert_threshold_3 double, expert_threshold_4 double, expert_threshold_5 double, direction string, catalog_assay_id double, parent_assay_id double, meta string"
T1 = "input_compound_id bigint, input_assay_id bigint, standard_qualifier string, standard_value double, loaded_at int"


def assays(spark, *rows):
    """Rows are (id, type, binary, direction)."""
    return spark.createDataFrame([(i, t, not b, b, None, None, None, None, None, d, None, None, "m") for i, t, b, d in rows], T0)


def one(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    "kind,binary,direction,members,want",
    [
        ("ADME", False, "high", [("=", 1.0), ("<", 2.0), ("<", 4.0)], ("<", 2.0)),
        ("ADME", False, "high", [("=", 1.0), ("<", 2.0)], ("=", 1.5)),
        ("ADME", False, "high", [(">", 1.0), ("<", 2.0)], None),
        ("AUX_HTS", False, "low", [("=", 1.0), ("<", 1.0), ("=", 4.0)], ("=", 1.0)),
        ("AUX_HTS", False, "high", [("<", 9.0), ("=", 4.0), ("=", 1.0)], ("=", 4.0)),
        ("AUX_HTS", False, "high", [("<", 9.0), ("<", 4.0)], ("<", 9.0)),
        ("AUX_HTS", False, None, [("=", -9.0), ("=", 4.0)], ("=", -9.0)),
        ("OTHER", False, "low", [("=", 4.016), ("=", 3.0)], ("=", 4.02)),
        ("OTHER", False, "low", [("~", 4.0)], ("=", 4.0)),
        ("AUX_PL", True, None, [("<", 1.0), ("=", -1.0)], ("=", 1.0)),
        ("AUX_PL", True, None, [("=", -1.0), ("=", -1.0), ("=", 1.0)], ("=", -1.0)),
    ],
)
def test_replicates(spark, kind, binary, direction, members, want):
    t0 = tables.ingest_assays(assays(spark, (1, kind, binary, direction)))
    t1 = tables.ingest_values(spark.createDataFrame([(7, 1, q, v, i) for i, (q, v) in enumerate(members)], T1))
    t5 = tables.ingest_vectors(spark.createDataFrame([(7, 0.0, 70.0), (7, 0.0, 70.0), (8, None, 80.0)], tables.SCHEMAS["t5"]))
    r = aggregate.Replicates(t0, t1, t5)
    got = one(r.grouped.select("standard_qualifier", aggregate.rounded(F.col("standard_value"), F.col("assay_type"))))
    if want is None:
        assert got[0][0] is None and r.failed_aggregation().count() == 1
    else:
        assert got == [(want[0], pytest.approx(want[1]))]


def test_rejects_and_conservation(spark):
    t0 = tables.ingest_assays(assays(spark, (1, "OTHER", False, "high"), (2, "AUX_PL", True, None), (3, "CATALOG-PANEL", False, None)))
    values = [None, float("nan"), float("inf"), 2.9, 3.0, 10.0, 10.1, 1.0, -1.0, 0.5]
    rows = [(c, a, "=", v, 0) for c, a, v in itertools.product((7, 9), (1, 2, 3), values)]
    t1 = tables.ingest_values(spark.createDataFrame(rows, T1))
    t5 = tables.ingest_vectors(spark.createDataFrame([(7, 0.0, 70.0)], tables.SCHEMAS["t5"]))
    r = aggregate.Replicates(t0, t1, t5)
    n = {(x.input_assay_id, x.reject): x["count"] for x in r.classified.groupBy("input_assay_id", "reject").count().collect()}
    assert n[1, "range"] == 16 and n[1, None] == 2 and n[1, "no_vector"] == 2
    assert n[2, "binary"] == 16 and n[2, None] == 2
    assert n[3, "range"] == 4 and n[3, None] == 8
    assert sum(n.values()) == len(rows)
    assert r.duplicates().count() == r.accepted.count()


def test_order_of_input_does_not_matter(spark):
    t0 = tables.ingest_assays(assays(spark, (1, "AUX_HTS", False, None)))
    rows = [(c, 1, q, v, t) for c in (7, 8) for t, (q, v) in enumerate([("<", 2.0), (">", -2.0), ("=", 2.0), ("<", 2.0)])]
    t5 = spark.createDataFrame([(7, 1.0, 70.0), (8, 2.0, 70.0)], tables.SCHEMAS["t5"])
    got = set()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, T1).repartition(3)
        got.add(str(sorted(one(aggregate.Replicates(t0, tables.ingest_values(df), tables.ingest_vectors(t5)).grouped))))
    assert len(got) == 1


def test_std_filter_counts_missing_folds_as_constant(spark):
    rows = [(1, "OTHER", f, v) for f in (0, 1) for v in (1.0, 2.0)] + [(2, "OTHER", 0, 1.0), (2, "OTHER", 0, 2.0)] + [(3, "CATALOG-PANEL", 0, 5.0), (3, "CATALOG-PANEL", 0, 5.0)]
    df = spark.createDataFrame(rows, "input_assay_id bigint, assay_type string, fold_id int, standard_value double")
    assert sorted(one(aggregate.fold_variance(df, 1e-12))) == [(1, False, False), (2, False, True), (3, True, True)]


def test_rounding_is_half_to_even_after_scaling(spark):
    df = spark.createDataFrame([(1.015,), (2.675,), (0.125,), (None,)], "v double")
    got = [r[0] for r in df.select(aggregate.rounded(F.col("v"), F.lit("OTHER"))).collect()]
    assert got == [float(np.round(1.015, 2)), float(np.round(2.675, 2)), float(np.round(0.125, 2)), None]


def test_class_labels(spark):
    rows = [(d, q, v) for d in ("high", "low") for q in "<>=" for v in (4.0, 5.0, 6.0)]
    df = spark.createDataFrame(rows, "d string, q string, v double")
    got = [r[0] for r in df.select(threshold.class_label(F.col("v"), F.col("q"), F.lit(5.0), F.col("d"))).collect()]
    assert got == [-1, -1, None, None, 1, 1, -1, 1, 1, 1, 1, None, None, -1, -1, 1, 1, -1]


def test_screening_labels(spark):
    df = spark.createDataFrame([("high", 3.0, 3.0), ("low", -3.0, -3.0), ("low", 3.0, -3.0), (None, -4.0, 3.0), (None, 2.0, 3.0)], "d string, v double, t double")
    assert [r[0] for r in df.select(threshold.screening_label(F.col("v"), F.col("t"), F.col("d"))).collect()] == [1, 1, -1, 1, -1]


def test_censored_weight(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.5,), (1.0,)], "f double")
    assert [r[0] for r in df.select(quorum.censored_weight(F.col("f"), 0.05)).collect()] == pytest.approx([1, 1, 0.05 * 0.5 / (0.5 * 0.95), 0])
    with pytest.raises(ValueError):
        Config(knock_in_barrier=1.5)


def test_dense_ids(spark):
    rng = np.random.default_rng(1)
    values = [int(x) for x in rng.integers(0, 400, 3000)] + [None] * 5
    df = spark.createDataFrame([(v, str(v)) for v in values], "k bigint, __part string").repartition(6)
    got = dict(one(ids.dense_ids(df, ["k"], "id", 1)))
    assert got == {v: i + 1 for i, v in enumerate(sorted({v for v in values if v is not None}))}
    assert ids.dense_ids(df.filter("false"), ["k"], "id").count() == 0


def test_descriptor_ids(spark):
    rows = [(1, "c", "[2]", "[1]", 0), (2, "c", "[10]", "[1]", 0), (3, "c", "[2]", "[1]", 0), (4, "c", "[2]", "[1]", 1), (5, "c", None, "[1]", 1), (6, "c", "[2]", "[1]", -1)]
    df = spark.createDataFrame(rows, "input_compound_id bigint, canonical_smiles string, fp_feat string, fp_val string, fold_id int")
    t5, t6, dup = ids.descriptor_ids(df)
    assert sorted((r.input_compound_id, r.descriptor_vector_id) for r in t5.collect()) == [(1, 1), (2, 0), (3, 1), (4, 2)]
    assert t6.count() == 3 and sorted(r.input_compound_id for r in dup.collect()) == [1, 3]


def test_keyed_hash_and_folds(spark):
    import hashlib
    import hmac

    df = spark.createDataFrame([("0",), ("é",), (None,)], "t string")
    for key in ("k", "k" * 100):
        want = [hmac.new(key.encode(), t.encode(), hashlib.sha256).hexdigest() for t in ("0", "é")] + [None]
        assert [r[0] for r in df.select(keyed.hmac_sha256(key, F.col("t"))).collect()] == want
    p = [r.scrambled for r in keyed.permutation(spark, "k", 500).orderBy("feature").collect()]
    tail = [int.from_bytes(hmac.new(b"k", str(i).encode(), hashlib.sha256).digest()[-8:]) % 2**63 for i in range(500)]
    assert p == np.argsort(np.argsort(tail)).tolist()
    folds = {r.t: r.fold_id for r in keyed.keyed_folds(df, "t", "k", 5).collect()}
    assert folds["0"] == keyed.fold_of("0", "k", 5) and folds[None] == keyed.fold_of("None", "k", 5)


def test_scramble_and_bits(spark):
    df = spark.createDataFrame([([1, 2, 99],), ([],), (None,)], "f array<bigint>")
    p = {r.feature: r.scrambled for r in keyed.permutation(spark, "k", 10).collect()}
    assert [r.f for r in keyed.scramble(df, "f", "k", 10).collect()] == [[p[1], p[2], None], [], None]
    assert [r[0] for r in df.select(keyed.bit_string(F.col("f"), (2, 3, 1))).collect()][:2] == ["101", "000"]
    assert [r[0] for r in df.select(features.to_json_list(F.col("f"))).collect()] == ["[1, 2, 99]", "[]", None]


def test_labels(spark):
    rows = [(1, 1, 0, 0), (1, 1, 0, 1), (1, 2, 0, 1), (1, 2, 0, 1), (1, 2, 1, 0), (2, 1, 1, 0), (2, 1, 1, 0), (2, 1, 1, None)]
    df = spark.createDataFrame(rows, "classification_task_id bigint, descriptor_vector_id bigint, fold_id int, label int")
    assert sorted(one(labels.label_modes(df, labels.KEYS, "label"))) == [(1, 1, 1, [0, 1]), (1, 2, 2, [1]), (2, 1, 2, [0])]
    assert sorted(one(labels.resolved_labels(df, labels.KEYS, "label"))) == [(1, 1, 1), (1, 2, 1), (2, 1, -1)]
    signed = df.withColumn("class_label", F.when(F.col("label") == 0, -1).otherwise(F.col("label")))
    assert one(labels.tasks_with_both(signed, 2)) == [(1, 2, 3)]
    assert sorted(one(labels.fold_label_counts(signed))) == [(1, 0, 1, 3), (1, 1, 1, 0), (2, 0, 0, 0), (2, 1, 2, 0)]


def test_checks(spark):
    t0 = assays(spark, (1, "OTHER", False, None), (1, "ODD", True, None), (2, None, False, None))
    got = {r.check: r.n for r in checks.check_assays(t0).collect()}
    assert got["assay_type unknown"] == 1 and got["assay_type null"] == 1 and got["input_assay_id repeated"] == 1 and got["is_binary null"] == 0
    levels = {r.assay_type: r.level for r in checks.check_types(t0, False).collect()}
    assert levels["OTHER"] == "OK" and levels["ODD"] == "WARNING" and levels[None] == "ERROR" and levels["AUX_HTS"] == "INFO"


def test_matrix_files(spark, tmp_path):
    coo = spark.createDataFrame([(0, 3, 1.0), (2, 0, 2.0), (0, 1, 3.0)], "row int, col int, value float")
    matrix.save_npz(coo, tmp_path / "x.npz", (4, 5), "float32")
    f = np.load(tmp_path / "x.npz")
    assert f["indptr"].tolist() == [0, 2, 2, 3, 3] and f["indices"].tolist() == [1, 3, 0] and f["data"].tolist() == [3, 1, 2] and f["shape"].tolist() == [4, 5]
    mask = spark.createDataFrame([("<",), ("?",)], "q string")
    with pytest.raises(Exception, match="unknown qualifier"):
        mask.select(matrix.censoring(F.col("q"))).collect()


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, "<", float("inf")), (3, 4, None, 1.5)], tables.SCHEMAS["t1"])
    tables.write_csv(df.withColumn("standard_value", F.when(F.col("standard_value") == float("inf"), "inf").otherwise(F.col("standard_value").cast("string"))), str(tmp_path / "t1"), single=True)
    assert sorted(one(tables.read_input(spark, str(tmp_path / "t1"), tables.SCHEMAS["t1"])), key=str) == sorted(one(df), key=str)
    tables.write_csv(df.filter("false"), str(tmp_path / "none"))
    with pytest.raises(ValueError):
        tables.read_input(spark, str(tmp_path / "none"), tables.SCHEMAS["t1"])
    assert tables.union_tables([df, df.drop("standard_qualifier")]).count() == 4
