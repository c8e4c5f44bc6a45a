import math
import random

import pytest
from pyspark.sql import functions as F

from loomwork.operators import skew


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    keys = ["hot"] * 600 + [None] * 50 + [f"k{i % 40}" for i in range(400)]
    data = [(k, rng.choice([None, float("nan"), float("inf"), 1.5, 2.0, rng.uniform(-9, 9)]), i) for i, k in enumerate(keys)]
    data += [("hot", 1.25, -1)] * 300  # rows that are equal in every column
    return data, spark.createDataFrame(data, "k string, v double, n_rows int").repartition(7)


def test_heavy_keys_are_bounded(rows):
    data, df = rows
    found = {r.k: r.n_rows for r in skew.heavy_keys(df, ["k"], 0.1).collect()}
    assert found == {"hot": 900}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_is_the_plain_join(spark, rows, how):
    data, df = rows
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k9", 3), ("absent", 4)], "k string, w int")
    got = skew.skew_join(df, right, "k", how, 0.05).select("k", "n_rows", "w")
    want = df.join(right, "k", how).select("k", "n_rows", "w")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_skew_join_of_empty_tables(spark, rows):
    none = spark.createDataFrame([], "k string, w int")
    assert skew.skew_join(rows[1], none, "k", "left").count() == len(rows[0])
    assert skew.skew_join(rows[1].filter("false"), none, "k").count() == 0
    with pytest.raises(ValueError):
        skew.skew_join(rows[1], none, "k", "outer")


def test_value_statistics_against_one_pass(rows):
    data, df = rows
    got = {r.k: r for r in skew.value_statistics(df, "k", "v", 8, 0.05).collect()}
    for key in {k for k, _, _ in data}:
        vals = [v for k, v, _ in data if k == key and v is not None and math.isfinite(v)]
        r = got[key]
        assert (r.n_rows, r.n_values) == (sum(k == key for k, _, _ in data), len(vals))
        if vals:
            mean = sum(vals) / len(vals)
            assert (r.min_value, r.max_value) == (min(vals), max(vals)) and r.mean_value == pytest.approx(mean, abs=1e-6)
        if len(vals) > 1:
            assert r.std_value == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in vals) / (len(vals) - 1)))
        else:
            assert r.std_value is None


def test_keys_above_counts_every_row_once(spark, rows):
    data, df = rows
    assert [r.k for r in skew.keys_above(df, "k", 0.3).collect()] == ["hot"]
    assert skew.keys_above(df.filter("false"), "k", 0.3).count() == 0
    got = skew.salted_aggregate(df, "k", {"c": F.count(F.lit(1))}, {"c2": F.sum("c")}, 5, 0.05)
    assert sum(r.c2 for r in got.collect()) == len(data)
