import pytest
from pyspark.sql import functions as F

from loomwork import cli
from loomwork.config import Config
from loomwork.functions import calculators, keyed
from loomwork.plans import pipeline


def test_structures_fold_by_lsh_of_unscrambled_features(spark, tmp_path, monkeypatch):
    config = Config(fold_size=20, lsh_bits=(1, 2, 3), nfolds=5)
    rows = [(i, f"s{i}", [b for b in range(4) if i >> b & 1] + [5 + i]) for i in range(12)]
    found = spark.createDataFrame(rows, "input_compound_id bigint, canonical_smiles string, fp_feat array<int>")
    done = found.withColumns({"murcko_smiles": F.lit("one"), "fp_val": F.transform("fp_feat", lambda _: F.lit(1)), "smiles": F.col("canonical_smiles")})
    failed = done.filter("false").select("input_compound_id", "smiles", F.lit("x").alias("error_message"))
    monkeypatch.setattr(calculators, "structures", lambda t2, config: (done, failed))
    t5, _ = pipeline.Run(spark, str(tmp_path), "lsh", config).structures(done, "lsh")
    want = {i: keyed.fold_of("".join("1" if b in f else "0" for b in config.lsh_bits), config.key, 5) for i, _, f in rows}
    assert {r.input_compound_id: r.fold_id for r in t5.collect()} == want and len(set(want.values())) > 1
    with pytest.raises(ValueError, match="scaffold, lsh"):
        pipeline.Run(spark, str(tmp_path), "x", config).structures(found, "other")


def test_structure_stages_one_by_one(spark, tmp_path, monkeypatch):
    class Print(calculators.Calculator):
        inputs, outputs = ("canonical_smiles",), {"fp_feat": "array<int>", "fp_val": "array<int>"}

        def __init__(self, size=0):
            self.size = size

        def calculate(self, smiles):
            return [len(smiles), len(smiles) + 1], [1, 2 // (len(smiles) - 3)]

    class Frame(calculators.Calculator):
        inputs, outputs = ("canonical_smiles",), {"murcko_smiles": "string", "sn_smiles": "string"}

        def calculate(self, smiles):
            return smiles[:1], smiles[:2]

    monkeypatch.setattr(calculators, "Fingerprint", Print)
    monkeypatch.setattr(calculators, "Scaffold", Frame)
    (tmp_path / "s.csv").write_text("input_compound_id,canonical_smiles\n" + "\n".join(f"{i},{s}" for i, s in enumerate(["CCCC", "CCN", "NCCO", "CCCCC", "NCCO"])) + "\n")
    base = [f"--output={tmp_path}", "--name=r"]
    cli.main(["calculate_descriptors", f"--structures={tmp_path}/s.csv", *base], spark)
    at = f"{tmp_path}/r/results"
    assert {r.input_compound_id for r in spark.read.parquet(f"{at}/T2_print_failed").collect()} == {1}
    cli.main(["assign_fold", f"--structures={at}/T2_descriptors", *base], spark)
    folds = spark.read.parquet(f"{at}/T2_folds")
    assert {r.input_compound_id: r.fold_id for r in folds.collect()} == {i: keyed.fold_of(s, Config().key, Config().nfolds) for i, s in ((0, "CC"), (2, "NC"), (3, "CC"), (4, "NC"))}
    cli.main(["assign_lsh_fold", f"--structures={tmp_path}/s.csv", f"--output={tmp_path}", "--name=lsh"], spark)
    t5 = spark.read.parquet(f"{tmp_path}/lsh/results/T5").collect()
    assert {r.input_compound_id for r in t5} == {0, 2, 3, 4} and len({r.descriptor_vector_id for r in t5}) == 2
