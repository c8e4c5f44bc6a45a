"""The same or nearly the same sets on both sides of a split, found by similarity-hash bit fingerprints.

Each feature flips one bit of one 64-bit block of a fingerprint. Two sets then differ in at most as many bits as
features, so sets within the wanted Jaccard similarity lie within a Hamming radius r that their sizes give, and of
r + 1 blocks at least one is equal. Joining equal blocks across the splits thus loses no pair; the Hamming radius
and then the exact similarity decide. Sets are fingerprinted by bands of sizes, as r grows with them. Equal sets are one
class, compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators.skew import skew_join
from loomwork.session import cut

#: Pairs that one block may propose before its members are parted by a second fingerprint of their other features.
BLOCK_PAIRS = 20_000
#: Members of a class that one task spreads its pairs to.
MEMBERS = 100_000
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@lru_cache(64)
def bands(similarity: float, largest: int) -> tuple[tuple[int, int, int], ...]:
    """(lowest size, highest size, blocks) of each band, up to ``largest``."""
    out, lo = [], 1
    while lo <= largest:
        hi = max(lo, math.floor(lo / similarity + 1e-9))
        out.append((lo, hi, math.floor(hi * (1 - similarity) / similarity + 1e-9) + 1))
        lo = hi + 1
    return tuple(out)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(seed)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


def fingerprint(features: np.ndarray, blocks: int, level: int = 0) -> np.ndarray:
    """``blocks`` 64-bit words; each feature flips one bit."""
    h = _mix(features, _SEEDS[level])
    words = np.zeros(blocks, np.uint64)
    np.bitwise_xor.at(words, (h >> np.uint64(8)) % np.uint64(blocks), np.uint64(1) << (h & np.uint64(63)))
    return words.view(np.int64)


def other_features(features: np.ndarray, blocks: int, block: int) -> np.ndarray:
    """The features that flip no bit of ``block``."""
    return features[(_mix(features, _SEEDS[0]) >> np.uint64(8)) % np.uint64(blocks) != block]


def _fingerprints(similarity: float):
    """Rows (class_id, side, n, band, blocks) of each class; a class of both sides gives rows for both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("class_id", "side", "n", "band", "blocks")}
            columns = [batch.column(c).to_pylist() for c in ("class_id", "left", "right")]
            lists = batch.column("features")
            flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.offsets) - lists.offsets[0].as_py()
            for i, (key, left, right) in enumerate(zip(*columns)):
                features = flat[offsets[i] : offsets[i + 1]]
                n = len(features)
                table = bands(similarity, math.floor(n / similarity + 1e-9) + 1)
                for band, (lo, hi, k) in enumerate(table):
                    own = lo <= n <= hi
                    near = right and hi >= math.ceil(similarity * n - 1e-9) and lo <= math.floor(n / similarity + 1e-9)
                    if own and left or near:
                        words = fingerprint(features, k).tolist()
                        for side in (*("l" * bool(own and left)), *("r" * bool(near))):
                            for c, v in zip(out, (key, side, n, band, words)):
                                out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([("class_id", pa.int64()), ("side", pa.string()), ("n", pa.int32()), ("band", pa.int32()), ("blocks", pa.list_(pa.int64()))]))

    return run


def _second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with ``blocks2``, the second fingerprint of the features outside the block of the row."""
    for batch in batches:
        lists, blocks, at = batch.column("features"), batch.column("blocks"), batch.column("pos").to_pylist()
        words = []
        for i, pos in enumerate(at):
            k = len(blocks[i])
            words.append(fingerprint(other_features(lists[i].values.to_numpy(zero_copy_only=False), k, pos), k, 1).tolist())
        rest = batch.drop_columns(["features"])
        yield rest.append_column("blocks2", pa.array(words, pa.list_(pa.int64())))


def _first_equal(a: Column, b: Column) -> Column:
    return F.array_position(F.zip_with(a, b, lambda x, y: x == y), True) - 1


def _within(a: Column, b: Column, similarity: float) -> Column:
    """Whether two fingerprints lie within the Hamming radius, and the sizes within the ratio, that their sets may have."""
    differ = F.aggregate(F.zip_with(a["blocks"], b["blocks"], lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    radius = F.floor((a["n"] + b["n"]) * F.lit((1 - similarity) / (1 + similarity)) + F.lit(1e-9))
    ratio = F.least(a["n"], b["n"]) >= F.lit(similarity - 1e-9) * F.greatest(a["n"], b["n"])
    return ratio & (differ <= radius)


def class_pairs(classes: DataFrame, similarity: float) -> DataFrame:
    """(class_l, class_r) of all classes whose sets have at least ``similarity`` of their union in common.

    ``classes``: class_id, features (distinct), left, right (whether the class occurs on that side). Sets that are equal
    are one class and pair with themselves when they occur on both sides. Empty sets pair with nothing.
    """
    prints = cut(
        classes.filter(F.size("features") > 0).mapInArrow(_fingerprints(similarity), "class_id bigint, side string, n int, band int, blocks array<bigint>"),
        "fingerprints",
    )
    rows = prints.select("class_id", "side", "n", "band", "blocks", F.posexplode("blocks").alias("pos", "block"))
    key = ["band", "pos", "block"]
    sides = rows.groupBy(*key).agg(F.count_if(F.col("side") == "l").alias("nl"), F.count_if(F.col("side") == "r").alias("nr"))
    crowded = cut(sides.filter(F.col("nl") * F.col("nr") > BLOCK_PAIRS).select(*key), "crowded")
    fp = lambda p: F.struct(F.col(f"{p}.n"), F.col(f"{p}.blocks"))

    def side(d: DataFrame, s: str) -> DataFrame:
        return d.filter(F.col("side") == s).drop("side").alias(s)

    plain = rows.join(crowded, key, "left_anti")
    near = side(plain, "l").join(side(plain, "r"), key).filter(_first_equal(F.col("l.blocks"), F.col("r.blocks")) == F.col("pos"))
    near = near.filter(_within(fp("l"), fp("r"), similarity)).select(F.col("l.class_id").alias("class_l"), F.col("r.class_id").alias("class_r"))

    if not crowded.isEmpty():
        full = rows.join(crowded, key, "left_semi").join(classes.select("class_id", "features"), "class_id")
        schema = "class_id bigint, n int, side string, band int, blocks array<bigint>, pos int, block bigint, blocks2 array<bigint>"
        again = full.select("class_id", "n", "side", "band", "blocks", "pos", "block", "features").mapInArrow(_second, schema)
        parted = again.select("*", F.posexplode("blocks2").alias("pos2", "block2"))
        both = side(parted, "l").join(side(parted, "r"), [*key, "pos2", "block2"])
        both = both.filter((_first_equal(F.col("l.blocks"), F.col("r.blocks")) == F.col("pos")) & (_first_equal(F.col("l.blocks2"), F.col("r.blocks2")) == F.col("pos2")))
        both = both.filter(_within(fp("l"), fp("r"), similarity)).select(F.col("l.class_id").alias("class_l"), F.col("r.class_id").alias("class_r"))
        near = near.unionByName(both)
    sets = classes.select("class_id", "features")
    of = lambda s: sets.select(F.col("class_id").alias(f"class_{s}"), F.col("features").alias(f"f{s}"))
    full = near.join(of("l"), "class_l").join(of("r"), "class_r")
    common = F.size(F.array_intersect("fl", "fr"))
    return full.filter(common / (F.size("fl") + F.size("fr") - common) >= F.lit(similarity)).select("class_l", "class_r")


def feature_sets(texts: Column) -> Column:
    """The distinct features of a bracketed list of integers, in order; a null text gives an empty set."""
    found = F.transform(F.regexp_extract_all(F.coalesce(texts, F.lit("")), F.lit(r"[0-9]+"), F.lit(0)), lambda x: x.try_cast("bigint"))
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull())))


def set_classes(rows: DataFrame, id_col: str, side: str) -> tuple[DataFrame, DataFrame]:
    """(classes, members) of rows with ``id_col``, ``side`` (l, r or another) and ``features``.

    A class is all rows with the same set, under a number of its own. Rows of other sides or without an id take no
    part. Repeated rows count once. Members: (id, side, class_id).
    """
    rows = rows.filter(F.col(id_col).isNotNull() & F.col(side).isin("l", "r"))
    slim = cut(rows.select(F.col(id_col).alias("id"), F.col(side).alias("side"), "features", F.array_join("features", ",").alias("content")).distinct(), "sets")
    grouped = slim.groupBy("content").agg(F.any_value("features").alias("features"), F.bool_or(F.col("side") == "l").alias("left"), F.bool_or(F.col("side") == "r").alias("right"))
    numbered = cut(grouped.withColumn("class_id", F.monotonically_increasing_id()), "classes")  # written, so a number stays
    members = skew_join(slim.select("id", "side", "content"), numbered.select("content", "class_id"), "content").select("id", "side", "class_id")
    return numbered.drop("content"), members


def _spread(pairs: DataFrame, members: DataFrame, side: str) -> DataFrame:
    """``pairs`` with ``id_side`` instead of ``class_side``: a row for each member of the class on that side.

    The members of a class are parted by a salt into groups of about ``MEMBERS``, and its pairs go to each of these, so a class that
    holds most ids isn't one task.
    """
    key, salts = f"class_{side}", f"n_{side}"
    of_side = members.filter(F.col("side") == side).select(F.col("class_id").alias(key), F.col("id").alias(f"id_{side}"))
    sizes = cut(of_side.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias(salts)), "sizes")
    salted = skew_join(of_side, sizes, key).withColumn("salt", F.pmod(F.xxhash64(f"id_{side}"), F.col(salts)).cast("int")).drop(salts)
    wanted = pairs.join(sizes, key).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col(salts) - 1))).drop(salts)
    return wanted.join(salted, [key, "salt"]).drop(key, "salt")


def cross_split_pairs(rows: DataFrame, id_col: str, side: str, similarity: float = 0.85) -> DataFrame:
    """(id_a, id_b), the smaller first: ids, one on side l and one on side r, whose ``features`` are that similar.

    See ``set_classes`` and ``class_pairs`` for what takes part. An id does not pair with itself. Pairs of classes are
    found once and only then spread to their members, as the result has a row for each pair of ids.
    """
    classes, members = set_classes(rows, id_col, side)
    pairs, members = cut(class_pairs(classes, similarity), "pairs"), cut(members, "members")
    ids = _spread(_spread(pairs, members, "l"), members, "r").filter(F.col("id_l") != F.col("id_r"))
    return ids.select(F.least("id_l", "id_r").alias("id_a"), F.greatest("id_l", "id_r").alias("id_b")).distinct()


def overlapping_ids(rows: DataFrame, id_col: str, side: str, similarity: float = 0.85) -> DataFrame:
    """(id, class_id, n_links): ids of side r whose class is that similar to some class of side l, with the number of those classes."""
    classes, members = set_classes(rows, id_col, side)
    links = class_pairs(classes, similarity).groupBy(F.col("class_r").alias("class_id")).agg(F.count(F.lit(1)).alias("n_links"))
    return skew_join(members.filter(F.col("side") == "r"), links, "class_id").select(F.col("id").alias(id_col), "class_id", "n_links")
