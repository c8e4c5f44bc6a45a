import json
import shutil

import numpy as np
import pytest

from loomwork.config import Config
from loomwork.operators import matrix
from loomwork.plans import pipeline


def tables(spark, n):
    weights = "task_id int, task_type string, training_weight double"
    coo = "row long, col long, value"
    return {
        "x": spark.createDataFrame([(r, c, 1) for r in range(n) for c in range(r % 7)], f"{coo} int"),
        "y_cls": spark.createDataFrame([(r, 0, 1.0) for r in range(0, n, 3)], f"{coo} float"),
        "y_reg": spark.createDataFrame([(r, r % 2, r / 2) for r in range(n)], f"{coo} float"),
        "censor": spark.createDataFrame([(r, r % 2, -1) for r in range(n)], f"{coo} int"),
        "folds": spark.createDataFrame([(r, r % 5) for r in reversed(range(n))], "row long, fold_id int"),
        "cls_weights": spark.createDataFrame([(0, "OTHER", 1.0)], weights),
        "reg_weights": spark.createDataFrame([(1, "ADME", None), (0, "OTHER", 0.5)], weights),
    }


def dense(path):
    """The matrix of a file or of all shards, checked against the manifest."""
    if path.exists():
        files = [path]
    else:
        folder = path.with_name(path.name + matrix.SHARDED)
        m = json.loads((folder / "manifest.json").read_text())
        files = [folder / s["file"] for s in m["shards"]]
        entries = [len(np.load(f)["data"]) for f in files]
        assert entries == [s["entries"] for s in m["shards"]] and [s["offset"] for s in m["shards"]] == [sum(entries[:i]) for i in range(len(files))]
        assert max(entries) <= 32 and all(np.load(f)["indptr"].dtype == np.int64 for f in files)
    out = []
    for f in files:
        z = np.load(f)
        part = np.zeros(z["shape"])
        part[np.repeat(np.arange(len(z["indptr"]) - 1), np.diff(z["indptr"])), z["indices"]] = z["data"]
        out.append(part)
    return np.concatenate(out)


def test_shards_hold_what_single_files_hold(spark, tmp_path, monkeypatch):
    run, given = pipeline.Run(spark, str(tmp_path), "r", Config(fold_size=10)), tables(spark, 50)
    run.deliver(given, tmp_path / "single")
    for name, most in (("SINGLE", 32), ("SHARD", 32), ("SINGLE_CSV", 1)):
        monkeypatch.setattr(matrix, name, most)
    run.deliver(given, tmp_path / "parts")
    for name in ("wo_aux/cls/cls_T11_x.npz", "wo_aux/reg/reg_T11_x.npz", "wo_aux/cls/cls_T10_y.npz", "wo_aux/reg/reg_T10_y.npz", "wo_aux/reg/reg_T10_censor_y.npz"):
        assert not (tmp_path / "parts" / name).exists()
        assert np.array_equal(dense(tmp_path / "single" / name), dense(tmp_path / "parts" / name))
    folds = sorted((tmp_path / "parts/wo_aux/cls/cls_T11_fold_vector.npy.shards").glob("*.npy"))
    assert np.concatenate([np.load(f) for f in folds]).tolist() == np.load(tmp_path / "single/wo_aux/cls/cls_T11_fold_vector.npy").tolist() == [r % 5 for r in range(50)]
    lines = [f.read_text().splitlines()[1:] for f in sorted((tmp_path / "parts/wo_aux/reg/reg_weights.csv.shards").glob("*.csv"))]
    assert sum(lines, []) == (tmp_path / "single/wo_aux/reg/reg_weights.csv").read_text().splitlines()[1:] == ["0,OTHER,0.5", "1,ADME,"]
    with pytest.raises(ValueError, match="at most 32"):
        matrix.save_npz(given["x"], tmp_path / "x.npz", (50, 10), "int8")
    pipeline.copy_delivery(tmp_path / "parts", tmp_path / "ready")
    (tmp_path / "parts/wo_aux/reg/reg_T11_x.npz.shards/000000.npz").unlink()
    shutil.rmtree(tmp_path / "ready")
    with pytest.raises(ValueError, match="missing ..000000.npz"):
        pipeline.copy_delivery(tmp_path / "parts", tmp_path / "ready")


@pytest.mark.parametrize("n", [0, 1])
def test_no_row_and_one_row(spark, tmp_path, n):
    pipeline.Run(spark, str(tmp_path), "r", Config(fold_size=10)).deliver(tables(spark, n), tmp_path / "out")
    assert np.load(tmp_path / "out/wo_aux/cls/cls_T11_x.npz")["shape"].tolist() == [n, 10]
    assert dense(tmp_path / "out/wo_aux/reg/reg_T10_y.npz").shape == (n, 2) and len(np.load(tmp_path / "out/wo_aux/reg/reg_T11_fold_vector.npy")) == n


def test_a_vector_without_a_fold_is_an_error(spark, tmp_path):
    given = tables(spark, 4)
    with pytest.raises(ValueError, match="3 values for 4 rows"):
        matrix.save_npy(given["folds"].filter("row <> 1"), tmp_path / "v.npy", "fold_id", 4)
