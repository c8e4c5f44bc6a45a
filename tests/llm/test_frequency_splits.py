import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomwork.llm import frequency, splits


@pytest.mark.parametrize("leaf_rows", [50, 2_000_000])
def test_counts_by_brute_force(spark, leaf_rows):
    rng = random.Random(5)
    records = [None, [], [None, "a"]] + [[rng.choice(["hot", "hot", f"t{rng.randint(0, 300)}", "é" * 50]) for _ in range(rng.randint(0, 9))] for _ in range(800)]
    records += [["hot"]] * 400
    df = spark.createDataFrame([(r, "x") for r in records], "terms array<string>, term string").repartition(5)
    got = {r.term: (r.occurrences, r.records) for r in frequency.term_counts(df, "terms", leaf_rows).collect()}
    occ, rec = Counter(), Counter()
    for r in records:
        terms = [t for t in r or [] if t is not None]
        occ.update(terms)
        rec.update(set(terms))
    assert got == {t: (occ[t], rec[t]) for t in occ}


def test_counts_of_nothing(spark):
    df = spark.createDataFrame([([],), (None,)], "terms array<bigint>")
    assert frequency.term_counts(df, "terms").count() == 0
    assert frequency.term_counts(df.filter("false"), "terms").count() == 0


def test_marks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 25), ("e", 26)], "term string, records bigint")
    assert [r.mark for r in frequency.marked(df, F.lit(100)).orderBy("term").collect()] == ["rare", "rare", None, None, "common"]


def test_records_with_several_contents(spark):
    rows = [(1, [5, 5, 6], [1, 1, 1]), (2, [5, 6], [1, 1]), (2, [5, 7], [1, 2])]
    df = spark.createDataFrame(rows, "id bigint, f array<bigint>, v array<bigint>")
    got = {r.term: (r.occurrences, r.records) for r in frequency.term_counts(frequency.packed_records(df.filter("id = 1"), df.filter("id = 2"), "id", "f", "v"), "f").collect()}
    assert got == {5: (3, 2), 6: (2, 2), 7: (1, 1)}


def components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    return {frozenset(y for y in parent if find(y) == find(x)) for x in parent}


def test_contraction(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(70)]
    edges = [e for e in edges if e[0] != e[1]]
    given = edges + edges[:5] + [(b, a) for a, b in edges[:5]] + [(7, 7), (None, 3), (5, None)]
    df = spark.createDataFrame(given, "a bigint, b bigint")
    rows = splits.contract(df).collect()
    assert len(rows) == len({r.vertex for r in rows})
    groups = {}
    for r in rows:
        groups.setdefault(r.root, set()).add(r.vertex)
    assert {frozenset(g) for g in groups.values()} == components(edges)
    assert splits.contract(df.filter("false")).count() == 0


def test_related_groups(spark):
    rows = [
        (1, "A", "x"), (2, " A ", None), (3, "a", None), (4, "B", "x"), (5, None, "None"), (6, "nan", "N/A"), (7, "", " "), (8, "C", "D"), (9, "D", "E"),
        (10, "Q", None), (10, "R", None), (11, "R", "none"), (None, "A", "x"), (2, " A ", None),
    ]
    df = spark.createDataFrame(rows, "id bigint, m string, s string").withColumn("group_id", F.lit("x"))
    got = {r.id: r.group_id for r in splits.related_groups(df, "id", ["m", "s"]).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 10: 10, 11: 10}
    assert splits.related_groups(df.filter("false"), "id", ["m", "s"]).count() == 0


def test_torn_groups(spark):
    groups = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 5)], "id bigint, group_id bigint")
    folds = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, -1), (4, None), (5, 2), (6, 2), (6, 2)], "id bigint, fold_id int")
    assert sorted(map(tuple, splits.torn_groups(folds, "id", groups, "fold_id").collect())) == [(1, 1), (2, 1)]


@pytest.mark.parametrize("giant", [0, 3000])
def test_assigned_splits(spark, giant):
    rng = random.Random(8)
    sizes = [giant] * bool(giant) + [rng.choice([1, 1, 2, 5, 40]) for _ in range(1500)]
    rows, at = [], 0
    for size in sizes:
        rows += [(at + i, at) for i in range(size)]
        at += size
    groups = spark.createDataFrame(rows, "id bigint, group_id bigint")
    targets = spark.createDataFrame([("train", 0.4), ("train", 0.3), ("validation", 0.15), ("test", 0.15)], "split_name string, target_share double")
    placed = splits.assign_splits(groups, "id", targets).collect()
    assert len(placed) == len(rows) == len({r.id for r in placed})
    of = {}
    for r in placed:
        assert of.setdefault(r.group_id, r.split_name) == r.split_name
    n = Counter(r.split_name for r in placed)
    for split, share in (("train", 0.7), ("validation", 0.15), ("test", 0.15)):
        assert abs(n[split] / len(rows) - share) < 0.01
    assert splits.assign_splits(groups.filter("false"), "id", targets).count() == 0
