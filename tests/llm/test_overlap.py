import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.llm import overlap


def make(seed=4, n=260):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            base = list(rng.choice(rows)[2])
            for _ in range(rng.randint(0, 4)):
                if base and rng.random() < 0.5:
                    base.pop(rng.randrange(len(base)))
                else:
                    base.append(rng.randint(0, 5000))
        else:
            base = [rng.randint(0, 5000) for _ in range(rng.choice([0, 1, 2, 5, 8, 30, 60]))] + [1, 2, 3]
        rows.append((i, rng.choice("lr"), sorted(set(base))))
    rows += [(1000, "l", [7, 8, 9]), (1001, "r", [7, 8, 9]), (1001, "r", [7, 8, 9]), (1002, "l", [7, 8, 9]), (1002, "r", [7, 8, 9]), (1003, "l", []), (1004, "r", []), (1005, "x", [7, 8, 9])]
    return rows


def brute(rows, t):
    out = set()
    for a, sa, fa in rows:
        for b, sb, fb in rows:
            if (sa, sb) == ("l", "r") and a != b and fa and len(set(fa) & set(fb)) / len(set(fa) | set(fb)) >= t:
                out.add((min(a, b), max(a, b)))
    return out


@pytest.mark.parametrize("similarity,block_pairs", [(0.85, 20_000), (0.85, 1), (0.6, 3)])
def test_no_pair_is_lost(spark, monkeypatch, similarity, block_pairs):
    monkeypatch.setattr(overlap, "BLOCK_PAIRS", block_pairs)
    monkeypatch.setattr(overlap, "MEMBERS", 3 if block_pairs < 100 else 100_000)
    rows = make()
    df = spark.createDataFrame(rows + [(None, "l", [7, 8, 9])], "id bigint, side string, features array<bigint>").withColumn("n", F.lit("clash"))
    got = [tuple(r) for r in overlap.cross_split_pairs(df, "id", "side", similarity).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, similarity)


def test_links_per_document(spark):
    rows = make(9, 60)
    df = spark.createDataFrame(rows, "id bigint, side string, features array<bigint>")
    got = {r.id: r.n_links for r in overlap.overlapping_ids(df, "id", "side").collect()}
    want = {}
    for b, sb, fb in rows:
        sets = {tuple(fa) for a, sa, fa in rows if sa == "l" and fa and len(set(fa) & set(fb)) / len(set(fa) | set(fb)) >= 0.85}
        if sb == "r" and sets:
            want[b] = len(sets)
    assert got == want


def test_empty(spark):
    df = spark.createDataFrame([], "id bigint, side string, features array<bigint>")
    assert overlap.cross_split_pairs(df, "id", "side").count() == 0


def test_fingerprints_differ_by_no_more_than_the_sets():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a = np.unique(rng.integers(0, 500, 40))
        b = np.unique(np.concatenate([a[3:], rng.integers(0, 500, 4)]))
        x, y = (overlap.fingerprint(v, 9) for v in (a, b))
        assert sum(int(w).bit_count() for w in (x ^ y).view(np.uint64)) <= len(np.setxor1d(a, b))


def test_bands_cover_all_sizes():
    table = overlap.bands(0.85, 400)
    assert [lo for lo, _, _ in table] == [1, *(hi + 1 for _, hi, _ in table[:-1])]
    for a in range(1, 300):
        for b in range(a, int(a / 0.85) + 1):
            k = next(k for lo, hi, k in table if lo <= b <= hi)
            assert (a + b) * 0.15 / 1.85 + 1e-9 < k


def test_feature_sets(spark):
    df = spark.createDataFrame([("[ 3 ,1, 3]",), ("[]",), (None,)], "t string")
    assert [r[0] for r in df.select(overlap.feature_sets(F.col("t"))).collect()] == [[1, 3], [], []]
