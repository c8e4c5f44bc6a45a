import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.llm import quantiles as q

SHARES = [0.01, 0.25, 0.5, 0.75, 0.99]


def test_encoding_keeps_the_order():
    rng = np.random.default_rng(1)
    x = np.sort(np.concatenate([rng.normal(0, 10.0 ** rng.integers(-9, 9, 4000)), [0.0, -0.0, 1e300, -1e300, 5e-324]]))
    codes = q.encode(x)
    assert (np.diff(codes.astype(np.int64)) >= 0).all()
    normal = np.abs(x) > 1e-300
    assert (np.abs(q.decode(codes)[normal] - x[normal]) <= np.abs(x[normal]) * q.VALUE_ERROR).all()


@pytest.mark.parametrize("n", [1, 5, 300, 1100, 20000, 300000])
@pytest.mark.parametrize("kind", ["normal", "constant", "two", "skewed", "rounded"])
def test_ranks_within_the_bound(n, kind):
    rng = np.random.default_rng(n)
    x = {"normal": rng.normal(6, 2, n), "constant": np.full(n, 3.5), "two": rng.choice([-1.0, 1.0], n), "skewed": rng.lognormal(0, 3, n), "rounded": np.round(rng.normal(0, 3, n), 1)}[kind]
    codes, error = q.Sketch(q.encode(x), np.ones(n, np.int64)).descend(SHARES)
    ordered = np.sort(q.encode(x))
    for share, code in zip(SHARES, codes):
        rank = np.ceil(share * n).clip(1, n)
        lo, hi = np.searchsorted(ordered, code, "left"), np.searchsorted(ordered, code, "right")
        assert max(lo + 1 - rank, rank - hi, 0) <= error
    assert error <= 0.02 * n and (n > 300 or error == 0)


def same(a, b):
    return a.level == b.level and (a.items == b.items).all() and (a.counts == b.counts).all() and all((a.finer[i] == b.finer[i]).all() for i in range(a.level + 1, q.BITS + 1))


@pytest.mark.parametrize("n", [30, 700, 9000])
def test_sketches_add_up_and_take_deletions(n):
    rng = np.random.default_rng(3)
    x, y, z = rng.normal(0, 1, n), rng.normal(5, 1, n // 3), rng.lognormal(0, 9, n // 2)
    one = lambda v, w=1: q.Sketch(q.encode(v), np.full(len(v), w, np.int64))
    whole = one(np.concatenate([x, y, z]))
    for order in ((x, y, z), (z, y, x), (y, z, x)):
        total = q.Sketch()
        for v in order:
            total.add(q.Sketch.unpack(one(v).pack()))
        assert same(total, whole) and same(q.Sketch.unpack(total.pack()), whole)
    whole.add(one(z, -1))
    codes, error = whole.descend(SHARES)
    ordered = np.sort(q.encode(np.concatenate([x, y])))
    rank = np.ceil(np.array(SHARES) * len(ordered)).clip(1)
    lo, hi = np.searchsorted(ordered, codes, "left"), np.searchsorted(ordered, codes, "right")
    assert whole.total == len(ordered) and np.maximum(lo + 1 - rank, rank - hi).max() <= error
    big = q.Sketch(q.encode(x), np.full(n, 10**12))
    assert same(q.Sketch.unpack(big.pack()), big)


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(7)
    rows = [("hot", float(v), int(i % 3)) for i, v in enumerate(rng.normal(0, 1, 4000))] + [(f"g{i % 20}", float(i), 0) for i in range(400)]
    rows += [("g1", None, 0), ("g1", float("nan"), 0), ("g1", float("inf"), 1), (None, 1.0, 0), ("bad", None, 0), ("one", -2.5, 0)]
    return spark.createDataFrame(rows, "g string, v double, s int").repartition(6)


def test_percentiles_per_group(spark, values):
    got = q.percentiles(q.build(values, "g", "v"), "g", SHARES)
    checked = q.rank_errors(got, values, "g", "v").collect()
    assert {r.g for r in checked} == {"hot", "one", *(f"g{i}" for i in range(20))}
    assert all(r.off_by <= r.rank_error for r in checked) and len(checked) == 22 * len(SHARES)
    assert {r.n_values for r in checked if r.g == "g1"} == {20}


def test_merged_days_are_the_whole(spark, values):
    rows = lambda s: sorted(map(tuple, q.percentiles(s, "g", SHARES).collect()))
    whole = q.build(values, "g", "v")
    days = [q.build(values.filter(F.col("s") == d), "g", "v") for d in range(3)]
    merged = q.merge(days[0].unionByName(days[1]).unionByName(days[2]), "g")
    assert rows(merged) == rows(whole)
    gone = q.merge(merged.unionByName(q.build(values.filter("s = 2"), "g", "v", F.lit(-1))), "g")
    left = q.rank_errors(q.percentiles(gone, "g", SHARES), values.filter("s < 2"), "g", "v").collect()
    assert all(r.off_by <= r.rank_error for r in left) and len(left) == 22 * len(SHARES)
    two = q.percentiles(q.build(values, ["g", "s"], "v"), ["g", "s"], SHARES)
    assert two.count() == 24 * len(SHARES) and two.filter("g = 'hot'").select("s").distinct().count() == 3


def test_empty(spark, values):
    assert q.percentiles(q.build(values.filter("false"), "g", "v"), "g", SHARES).count() == 0
