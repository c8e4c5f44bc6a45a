"""Sources mixed to target weights by pivotal dependent rounding.

A source whose share asks for 2.37 copies of its tokens gives each document 2 copies and a third with probability 0.37.
The probabilities are rounded in pairs: mass, in tokens, moves at random from one document to the other until one of
them is 0 or 1, so the tokens of the source stay what they were expected to be. What is left over in each leaf is one
document, and those residuals are paired again, level by level, in a reduction tree.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.operators.skew import skew_join
from loomwork.session import cut, cut_counted

#: Documents of a leaf, about, and residuals that one node of the tree takes in.
LEAF_ROWS, FAN_IN = 20_000, 64


def _draw(seed: int, a: object, b: object) -> float:
    """A number in [0, 1) that depends on the seed and the two documents only, so a repeated task decides alike."""
    return int.from_bytes(hashlib.blake2b(f"{seed}|{a}|{b}".encode(), digest_size=7).digest()) / 2**56


def pivot(rows: Iterator[tuple[object, int, float]], seed: int) -> tuple[list[tuple[object, int]], tuple[object, int, float] | None]:
    """Rounds probabilities; rows are (id, weight, p) with weight > 0 and 0 < p < 1, in a fixed order.

    Returns the decided (id, 0 or 1) and what is left: at most one row with 0 < p < 1. The sum of weight * p of both is
    that of the input, and each row is decided 1 with its probability.
    """
    decided, held = [], None
    for key, w, p in rows:
        if held is None:
            held = (key, w, p)
            continue
        other, v, q = held
        up, down = min(v * (1 - q), w * p), min(v * q, w * (1 - p))  # mass that may move to the held row, or from it
        if _draw(seed, other, key) * (up + down) < down:
            full = v * (1 - q) <= w * p
            held, done = ((key, w, p - up / w), (other, 1)) if full else ((other, v, q + up / v), (key, 0))
        else:
            empty = v * q <= w * (1 - p)
            held, done = ((key, w, p + down / w), (other, 0)) if empty else ((other, v, q - down / v), (key, 1))
        decided.append(done)
        if not 1e-12 < held[2] < 1 - 1e-12:
            decided.append((held[0], round(held[2])))
            held = None
    return decided, held


def source_rates(sizes: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """(source, target_share, max_repeats, n_docs, n_tokens, rate): copies that each document of a source has on average.

    ``sizes``: source, n_docs, n_tokens; ``targets``: source, target_share, max_repeats, a few rows. Without
    ``total_tokens`` the mixture is the largest for which no source with tokens has to pass its most repeats; with it,
    such a source stops there and falls short. A source without tokens has rate 0 and takes no part in the total; the
    shares of the others are relative to each other.
    """
    have = targets.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    have = have.join(sizes, "source", "left").na.fill(0, ["n_docs", "n_tokens"])
    usable = (F.col("n_tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    most = have.filter(usable).agg(F.min(F.col("max_repeats") * F.col("n_tokens") / F.col("target_share"))).scalar()
    whole = have.filter(usable).agg(F.sum("target_share")).scalar()
    total = most if total_tokens is None else F.lit(float(total_tokens)) / whole
    rate = F.least(F.col("max_repeats").cast("double"), F.col("target_share") * total / F.col("n_tokens"))
    return have.withColumn("rate", F.when(usable, rate).otherwise(F.lit(0.0)))


def mixture(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, seed: int = 7, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(doc_id, source, n_tokens, copies): how often each document is used, 0 included; never more than max_repeats.

    ``documents``: doc_id (unique), source, n_tokens. Documents of a null or unlisted source take no part; those
    without tokens, or with null tokens, have 0 copies. The tokens used of a source are off its rate by at most one document.
    """
    slim = cut(documents.select("doc_id", "source", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens")), "sizes")
    sizes = slim.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    rates = cut(source_rates(sizes, targets, total_tokens).select("source", "rate"), "rates")
    whole = F.when(F.col("n_tokens") > 0, F.floor(F.col("rate") + F.lit(1e-12))).otherwise(0).cast("int")
    planned = skew_join(slim, rates, "source").select("doc_id", "source", "n_tokens", whole.alias("whole"), (F.col("rate") - F.floor("rate")).alias("p"))
    planned, n = cut_counted(planned, "planned")
    opened = (F.col("n_tokens") > 0) & (F.col("p") > 1e-9)
    leaves = max(1, math.ceil(n / leaf_rows))
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "source", "n_tokens", "whole", "p", "node", "extra"]
    schema = f"doc_id {kind}, source string, n_tokens bigint, whole int, p double, node bigint, extra int"

    def level(seed_of_level: int, last: bool):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            """The documents of a node, of one source: those decided, and at most one with extra -1 that is not."""
            frame = frame.sort_values("doc_id")
            source, node, copies = frame["source"].iloc[0], int(frame["node"].iloc[0]), int(frame["whole"].iloc[0])
            tokens = dict(zip(frame["doc_id"].tolist(), frame["n_tokens"].tolist()))
            decided, rest = pivot(((k, w, p) for (k, w), p in zip(tokens.items(), frame["p"].tolist())), seed_of_level)
            if rest is not None and last:
                decided.append((rest[0], int(_draw(seed_of_level, rest[0], "last") < rest[2])))
                rest = None
            rows = [(k, source, tokens[k], copies, 0.0, node, x) for k, x in decided] + ([(rest[0], source, rest[1], copies, rest[2], node, -1)] if rest else [])
            return pd.DataFrame(rows, columns=names)

        return run

    rows = planned.filter(opened).withColumn("node", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(leaves))).withColumn("extra", F.lit(-1))
    out, at = planned.filter(~opened).select("doc_id", "source", "n_tokens", F.col("whole").alias("copies")), 0
    while True:
        done = cut(rows.groupBy("source", "node").applyInPandas(level(seed + at, leaves == 1), schema), f"level{at}")
        decided = done.filter(F.col("extra") >= 0).select("doc_id", "source", "n_tokens", (F.col("whole") + F.col("extra")).alias("copies"))
        out = out.unionByName(decided)
        if leaves == 1:
            return out
        leaves, at = math.ceil(leaves / FAN_IN), at + 1
        rows = done.filter(F.col("extra") < 0).withColumn("node", F.floor(F.col("node") / FAN_IN).cast("bigint"))


def mixture_shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source of ``targets``: target share, documents and tokens there are, documents, copies and tokens used, share reached."""
    used = mixed.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_tokens").alias("n_tokens"),
        F.count_if(F.col("copies") > 0).alias("used_docs"),
        F.sum("copies").alias("used_copies"),
        F.sum(F.col("copies") * F.col("n_tokens")).alias("used_tokens"),
        F.max("copies").alias("most_copies"),
    )
    wanted = targets.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    out = wanted.join(used, "source", "left").na.fill(0)
    total = mixed.agg(F.sum(F.col("copies") * F.col("n_tokens"))).scalar()
    return out.withColumn("actual_share", F.coalesce(F.try_divide("used_tokens", total), F.lit(0.0)))
