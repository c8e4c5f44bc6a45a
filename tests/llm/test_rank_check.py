import pytest

from loomwork.llm import quantiles, queries


@pytest.mark.parametrize("off_by,kept", [(0, True), (10, True), (11, False), (21, False)])
def test_a_rank_beyond_its_stated_error_is_not_kept(spark, tmp_path, monkeypatch, off_by, kept):
    spark.createDataFrame([(1, 0.5)], "input_assay_id long, standard_value double").write.parquet(f"{tmp_path}/t1.parquet")
    row = spark.createDataFrame([(1, 0.5, 100, 1.0, 10.0, off_by)], "input_assay_id long, share double, n_values long, value double, rank_error double, off_by long")
    monkeypatch.setattr(queries, "_overall", lambda spark, folder: row.drop("off_by"))
    monkeypatch.setattr(quantiles, "rank_errors", lambda *_: row)
    assert [r.kept for r in queries.p6_rank_check(spark, str(tmp_path)).collect()] == [kept]
