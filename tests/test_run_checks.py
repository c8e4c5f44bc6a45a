import pytest

from loomwork.plans import pipeline
from loomwork.sources import tables


def test_a_run_ends_at_wrong_values_and_structures(spark, tmp_path):
    run = pipeline.Run(spark, str(tmp_path), "x")
    table = lambda rows, name: spark.createDataFrame(rows, tables.SCHEMAS[name])
    t0 = table([(1, "OTHER", True, False, *[None] * 8)], "t0")
    t5, t6 = table([], "t5"), table([], "t6")
    for row, error in (((7, None, "=", 5.0), "input_assay_id null: 1"), ((None, 1, "=", 5.0), "input_compound_id null: 1"), ((7, 1, "=", None), "standard_value null: 1")):
        with pytest.raises(ValueError, match=error):
            run.activity(t0, table([row], "t1"), t5, t6, None)
    with pytest.raises(ValueError, match="1 in T0, 2 in T1"):
        run.activity(t0, table([(7, 1, "=", 5.0), (7, 2, "=", 5.0)], "t1"), t5, t6, None)
    with pytest.raises(ValueError, match="input_compound_id repeated: 1"):
        run.structures(table([("a", "C"), ("a", "CC")], "t2"))
    with pytest.raises(ValueError, match="smiles null: 1"):
        run.structures(table([("a", None)], "t2"))
