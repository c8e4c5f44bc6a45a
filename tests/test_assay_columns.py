from loomwork import cli


def test_other_assay_columns_reach_t8(spark, tmp_path):
    """Also those named like columns of the run's own tables, which keep theirs."""
    (tmp_path / "T0.csv").write_text(
        "META_site,input_assay_id,assay_type,use_in_regression,is_binary,expert_threshold_1,expert_threshold_2,expert_threshold_3,expert_threshold_4,expert_threshold_5,direction,catalog_assay_id,parent_assay_id,num_total,catalog\n"
        "a,0,ADME,True,False,,,,,,high,,7,x,y\n"
        "b,1,OTHER,True,False,6.0,,,,,low,,8,x,y\n"
    )
    values = [f"{c},{a},=,{3.5 + (c * 7 + a) % 60 / 10}" for c in range(60) for a in range(2)]
    (tmp_path / "T1.csv").write_text("\n".join(["input_compound_id,input_assay_id,standard_qualifier,standard_value", *values]) + "\n")
    (tmp_path / "T5.csv").write_text("\n".join(["input_compound_id,fold_id,descriptor_vector_id", *(f"{c},{c % 2}.0,{c}.0" for c in range(60))]) + "\n")
    (tmp_path / "T6.csv").write_text("\n".join(["descriptor_vector_id,fp_feat,fp_val,fold_id", *(f'{c},"[{c}]","[1]",{c % 2}' for c in range(60))]) + "\n")
    names = {"--assays": "T0", "--values": "T1", "--vectors": "T5", "--features": "T6"}
    cli.main(["prepare_activity_data", *[x for k, v in names.items() for x in (k, f"{tmp_path}/{v}.csv")], "--output", str(tmp_path), "--name", "run"], spark)
    for name in ("T8c", "T8r", "T0_upd"):
        rows = spark.read.parquet(f"{tmp_path}/run/results/{name}").collect()
        assert {(r.input_assay_id, r.META_site, r.parent_assay_id, r["catalog"]) for r in rows} == {(0, "a", 7.0, "y"), (1, "b", 8.0, "y")}
        assert name != "T8r" or {r.num_total for r in rows} == {60}
        assert name != "T8c" or not any(c.startswith("expert") for c in rows[0].asDict())
