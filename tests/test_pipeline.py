import json

import numpy as np
import pytest

from loomwork import cli
from loomwork.config import Config, load_parameters
from loomwork.functions import calculators
from loomwork.plans import pipeline
from loomwork.sources import tables
from loomwork.streaming import values


def test_calculator_failures_are_rows(spark):
    class Length(calculators.Calculator):
        inputs = ("smiles",)
        outputs = {"n": "int"}

        def calculate(self, smiles):
            if smiles == "bad":
                raise ValueError("bad structure")
            return (len(smiles),)

    df = spark.createDataFrame([(1, "CCO", "x"), (2, "bad", "x"), (3, None, "x")], "id bigint, smiles string, n string")
    rows = {r.id: r for r in calculators.apply(df, Length()).collect()}
    assert (rows[1].n, rows[1].success, rows[1].error_message) == (3, True, None)
    assert (rows[2].n, rows[2].success, rows[2].error_message) == (None, False, "bad structure")
    ok, failed = calculators.split_success(calculators.apply(df, Length()))
    assert ok.count() == 1 and failed.count() == 2
    assert calculators.apply(df.filter("false"), Length()).count() == 0


def test_structures_without_the_toolkit_fail_as_rows(spark):
    df = spark.createDataFrame([(1, "CCO")], "input_compound_id bigint, smiles string")
    done, failed = calculators.structures(df)
    assert done.count() + failed.count() == 1


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    at = tmp_path_factory.mktemp("in")
    rng = np.random.default_rng(2)
    t0 = ["input_assay_id,assay_type,use_in_regression,is_binary,expert_threshold_1,expert_threshold_2,expert_threshold_3,expert_threshold_4,expert_threshold_5,direction,catalog_assay_id,parent_assay_id"]
    t0 += [f"{i},{t},{r},{b},{e},,,,,{d},," for i, (t, r, b, e, d) in enumerate([("ADME", True, False, "", "high"), ("OTHER", True, False, "6.0", "low"), ("OTHER", True, False, "", "high"), ("AUX_PL", False, True, "", "")])]
    t1 = ["input_compound_id,input_assay_id,standard_qualifier,standard_value"]
    t1 += [f"{c},{a},{rng.choice(['=', '=', '=', '<', '>'])},{rng.choice([-1, 1]) if a == 3 else round(rng.uniform(3.5, 9.5), 3)}" for c in range(300) for a in range(4)]
    t5 = ["input_compound_id,fold_id,descriptor_vector_id"] + [f"{c},{float(c % 5)},{float(c)}" for c in range(299)]
    t6 = ["descriptor_vector_id,fp_feat,fp_val,fold_id"] + [f'{c},"[{c % 7}, 50, {100 + c}]","[1, 2, 1]",{c % 5}' for c in range(299)]
    for name, lines in (("T0", t0), ("T1", t1), ("T5", t5), ("T6", t6)):
        (at / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return at


def test_activity_run(spark, inputs, tmp_path):
    parameters = {"training_quorum": {"classification": {t: {"num_active_total": 5, "num_inactive_total": 5} for t in ("ADME", "OTHER", "AUX_PL")}}, "lsh": {"nfolds": 5, "bits": [1, 2]}}
    (tmp_path / "p.json").write_text(json.dumps(parameters))
    args = ["--assays", f"{inputs}/T0.csv", "--values", f"{inputs}/T1.csv", "--vectors", f"{inputs}/T5.csv", "--features", f"{inputs}/T6.csv"]
    args += ["--output", str(tmp_path), "--name", "run", "--parameters", f"{tmp_path}/p.json", "--delivery", f"{tmp_path}/out"]
    cli.main(["prepare_activity_data", *args], spark)
    report = json.loads((tmp_path / "run/run_report.json").read_text())["rows"]
    assert report["T4r"] == 299 * 4 and report["T10r"] > 0 and report["T8r"] == 4 and report["X"] == 3 * 299
    x, y = np.load(tmp_path / "out/wo_aux/cls/cls_T11_x.npz"), np.load(tmp_path / "out/wo_aux/cls/cls_T10_y.npz")
    assert len(x["data"]) == report["X"] and x["shape"].tolist() == [299, 32000] and set(np.unique(y["data"])) <= {-1.0, 1.0}
    assert np.load(tmp_path / "out/wo_aux/reg/reg_T11_fold_vector.npy").tolist() == [i % 5 for i in range(299)]
    assert json.loads((tmp_path / "run/run_report.json").read_text())["fraction_censored_reg"] > 0
    hybrid = {p.name for p in (tmp_path / "out/wo_aux/hyb").iterdir()}
    assert hybrid == set(pipeline.DELIVERY["hyb"].values()) and (np.load(tmp_path / "out/wo_aux/hyb/hyb_T11_x.npz")["data"] == x["data"]).all()
    cli.main(["make_delivery", "--source", f"{tmp_path}/out", "--target", f"{tmp_path}/ready", "--phase", "phase2"])
    assert {p.name for p in (tmp_path / "ready").iterdir()} == {"cls_phase2", "reg_phase2", "hyb_phase2"}

    # The same stages one by one, on the files of those before them, give the same tables.
    base, at = [f"--output={tmp_path}", "--name=steps", f"--parameters={tmp_path}/p.json"], f"{tmp_path}/steps/results"
    for command, *given in (
        ("agg_activity_data", *args[:6]),
        ("apply_thresholding", f"--assays={at}/T0_upd", f"--activities={at}/T4r"),
        ("filter_classification_data", f"--tasks={at}/T3c", f"--labels={at}/T4c"),
        ("filter_regression_data", f"--assays={at}/T0_upd", f"--activities={at}/T4r"),
        ("make_matrices", "--features", f"{inputs}/T6.csv", f"--classification_rows={at}/T10c", f"--regression_rows={at}/T10r", f"--classification_tasks={at}/T8c", f"--regression_tasks={at}/T8r", f"--delivery={tmp_path}/aux", "--auxiliary=yes"),
    ):
        cli.main([command, *given, *base], spark)
    for name in ("T4r", "T8r", "T10c", "T10r", "X", "Y_cls", "Y_reg", "censor"):
        one, two = (sorted(map(str, spark.read.parquet(f"{tmp_path}/{r}/results/{name}").collect())) for r in ("run", "steps"))
        assert one == two
    assert {p.name for p in (tmp_path / "aux/w_aux/clsaux").iterdir()} == set(pipeline.DELIVERY["clsaux"].values())
    with pytest.raises(Exception, match="(?i)already exists"):
        cli.main(["filter_regression_data", f"--assays={at}/T0_upd", f"--activities={at}/T4r", *base], spark)
    (tmp_path / "out/wo_aux/cls/more.txt").write_text("")
    with pytest.raises(ValueError, match="additional"):
        pipeline.copy_delivery(tmp_path / "out", tmp_path / "ready2")


def test_run_parameters_and_checks(spark, inputs, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"outputs": "x"}))
    with pytest.raises(ValueError, match="unknown run parameters"):
        cli.main(["agg_activity_data", "--run_parameters", f"{tmp_path}/r.json"], spark)
    (tmp_path / "r.json").write_text(json.dumps({"assays": [f"{inputs}/T0.csv"], "values": [f"{inputs}/T1.csv"], "vectors": [f"{inputs}/T5.csv"], "output": str(tmp_path), "name": "agg"}))
    cli.main(["agg_activity_data", "--run_parameters", f"{tmp_path}/r.json"], spark)
    assert spark.read.parquet(f"{tmp_path}/agg/results/T4r").count() == 299 * 4
    run = pipeline.Run(spark, str(tmp_path), "x")
    with pytest.raises(ValueError, match="is_binary null: 1"):
        run.check(pipeline.checks.check_assays(spark.createDataFrame([(1, "OTHER", True, None, *[None] * 8)], tables.SCHEMAS["t0"])))


def test_parameters_and_hash(tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"credibility_range": {"ADME": {"min": 0, "max": 1}, "std": {"min": 0.5}}, "fingerprint": {"fold_size": 10}}))
    (tmp_path / "k.json").write_text(json.dumps({"key": "secret"}))
    c = load_parameters(tmp_path / "p.json", tmp_path / "k.json")
    assert c.ranges == {"ADME": (0, 1)} and c.min_std == 0.5 and c.fold_size == 10 and c.key == "secret" and c.hts_threshold == Config().hts_threshold
    one = pipeline.reference_hash(tmp_path / "p.json", {"a": 1}, {"key": "x"})
    assert one == pipeline.reference_hash(tmp_path / "p.json", {"a": 1}, {"key": "x"}) != pipeline.reference_hash(tmp_path / "p.json", {"a": 2}, {"key": "x"})
    (tmp_path / "h.json").write_text(json.dumps({"unit_test_hash": one}))
    pipeline.compare_reference_hash(one, tmp_path / "h.json")
    with pytest.raises(ValueError, match="reference hash"):
        pipeline.compare_reference_hash("0" * 64, tmp_path / "h.json")


def test_stream(spark, tmp_path):
    schema = tables.SCHEMAS["t1"] + ", loaded_at timestamp"
    batch = spark.sql("SELECT 7L AS input_compound_id, a AS input_assay_id, '<=' AS standard_qualifier, v AS standard_value, timestamp'2024-01-01 10:00:00' AS loaded_at FROM VALUES (1L, 5D), (1L, 99D), (2L, 5D) AS t(a, v)")
    batch.write.parquet(f"{tmp_path}/in")
    t0 = tables.ingest_assays(spark.createDataFrame([(1, "OTHER", True, False, *[None] * 8)], tables.SCHEMAS["t0"]))
    t5 = tables.ingest_vectors(spark.createDataFrame([(7, 0.0, 70.0)], tables.SCHEMAS["t5"]))
    stream = values.read_values(spark, f"{tmp_path}/in")
    assert stream.isStreaming and stream.schema == spark.createDataFrame([], schema).schema
    for name, df, mode in (("classified", values.classified(stream, t0, t5).select("reject", "qualifier"), "append"), ("daily", values.daily_counts(stream), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/c-{name}").start()
        q.processAllAvailable()
        q.stop()
    assert sorted(map(tuple, spark.table("classified").collect()), key=str) == [("range", "<"), (None, "<")]
    assert {r.input_assay_id: r.n_values for r in spark.table("daily").collect()} == {1: 2, 2: 1}
