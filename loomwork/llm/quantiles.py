"""Percentiles per group with a stated error, from dyadic Count-sketches that add up and take deletions.

A value is encoded as an unsigned integer of ``BITS`` bits in the order of the values. At every binary resolution the
encoded values fall into intervals; a sketch keeps the number of values in each interval: exactly at the finest resolution
that has at most ``EXACT`` intervals in use, from which those of all coarser ones follow, and in a signed Count-sketch for
each resolution beyond. All counts are sums, so sketches of other days, files or tasks are merged by addition, and deleted
rows are taken off with weight -1. A rank is inverted by descending the resolutions.

Sketches are made where the rows are read; only they are shuffled. A sketch has at most ``EXACT`` exact counts and some
``WIDTH * ROWS`` counters for each finer resolution, however many values the group has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.session import wide

#: Bits of an encoded value: sign, 11 of exponent, 16 of fraction, so a value is off by at most 2^-16 of itself.
BITS = 28
VALUE_ERROR = 2.0**-16
#: Counters in a row of a Count-sketch, and rows; intervals that are counted exactly.
WIDTH, ROWS, EXACT = 384, 5, 512
#: Rows of a task that are counted together before its sketches are made, and distinct (group, code) that it holds.
TOGETHER, HELD = 1 << 20, 1 << 21
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def encode(values: np.ndarray) -> np.ndarray:
    """Finite doubles as integers of ``BITS`` bits in the same order; both zeros are one value."""
    raw = (np.asarray(values, np.float64) + 0.0).view(np.uint64)
    ordered = np.where(raw >> np.uint64(63) == 1, ~raw, raw | np.uint64(1 << 63))
    return ordered >> np.uint64(64 - BITS)


def decode(codes: np.ndarray) -> np.ndarray:
    """The middle of the values with each code; numbers too small for full precision come out as 0."""
    shift = np.uint64(64 - BITS)
    ordered = (codes.astype(np.uint64) << shift) | np.uint64(1 << (63 - BITS))
    raw = np.where(ordered >> np.uint64(63) == 1, ordered & np.uint64(2**63 - 1), ~ordered)
    values = raw.view(np.float64)
    return np.where(np.abs(values) < np.finfo(np.float64).tiny, 0.0, values)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


def _slots(level: int, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counters and signs, one row of the Count-sketch after the other, of intervals ``items`` at ``level``."""
    with np.errstate(over="ignore"):
        x = _mix((items + np.uint64(level << 40))[None] + _SEEDS[:, None])
    column = ((x >> np.uint64(1)) % np.uint64(WIDTH)).astype(np.int64)
    return column + np.arange(ROWS)[:, None] * WIDTH, np.where(x & np.uint64(1), 1, -1)


def _sums(items: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted items, each once, with the sum of its counts; those that come to 0 are left out."""
    order = np.argsort(items, kind="stable")
    items, counts = items[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]])) if len(items) else np.array([], int)
    items, counts = items[starts], np.add.reduceat(counts, starts) if len(starts) else counts[:0]
    return items[counts != 0], counts[counts != 0]


class Sketch:
    """Exact counts (items, counts) of the intervals at ``level``, and for each level beyond a Count-sketch of ROWS * WIDTH counters."""

    def __init__(self, codes: np.ndarray | None = None, weights: np.ndarray | None = None):
        self.level, self.finer = BITS, {}
        self.items, self.counts = (np.array([], np.uint64), np.array([], np.int64)) if codes is None else _sums(codes, weights)
        self._fit(EXACT)

    @property
    def total(self) -> int:
        return int(self.counts.sum())

    def _coarsen(self) -> None:
        """Puts the counts of the exact level into a Count-sketch and goes on to the level above it."""
        counters = np.zeros(ROWS * WIDTH, np.int64)
        slots, signs = _slots(self.level, self.items)
        np.add.at(counters, slots.ravel(), (signs * self.counts).ravel())
        self.finer[self.level] = counters
        self.items, self.counts = _sums(self.items >> np.uint64(1), self.counts)
        self.level -= 1

    def _fit(self, most: int) -> None:
        while len(self.items) > most:
            self._coarsen()

    def add(self, other: Sketch) -> None:
        """Adds the counts of ``other``; the finest exact level is that which the sum has room for."""
        while self.level > other.level:
            self._coarsen()
        while other.level > self.level:
            other._coarsen()
        for level, counters in other.finer.items():
            self.finer[level] = self.finer[level] + counters
        self.items, self.counts = _sums(np.concatenate([self.items, other.items]), np.concatenate([self.counts, other.counts]))
        self._fit(EXACT)

    def descend(self, shares: Sequence[float]) -> tuple[np.ndarray, float]:
        """The codes at the given shares of the ranks, and the bound on how far their ranks may be off, in rows.

        At the exact level the interval is known. The bound adds over the levels beyond four standard deviations of the median of
        the rows' estimates. They come from the sketch's own second moment there without its WIDTH / 32 largest counters: so few
        intervals meet another one in most rows only once in some thousand cases. Without such levels the ranks are exact.
        """
        upto = np.cumsum(self.counts)
        target = np.ceil(np.asarray(shares) * upto[-1]).clip(1, upto[-1])
        index = np.searchsorted(upto, target)
        at, before = self.items[index], (upto - self.counts)[index]
        moments = 0.0
        for level in range(self.level + 1, BITS + 1):
            counters, left = self.finer[level], at << np.uint64(1)
            slots, signs = _slots(level, left)
            estimate = np.sort(counters[slots] * signs, axis=0)[ROWS // 2].clip(0, None)
            right = target > before + estimate
            before = np.where(right, before + estimate, before)
            at = left | right.astype(np.uint64)
            squares, rest = counters.reshape(ROWS, WIDTH).astype(float) ** 2, WIDTH - WIDTH // 32
            moments += np.sort(np.partition(squares, rest - 1, axis=1)[:, :rest].sum(axis=1))[ROWS // 2]
        error = moments / WIDTH
        return at, min(float(upto[-1]), np.ceil(4 * 1.2533 * np.sqrt(error / ROWS)) + (error > 0))

    def pack(self) -> bytes:
        """The counts and the counters that aren't zero, as gaps and numbers of the fewest bytes, compressed."""
        counters = np.concatenate([self.finer[n] for n in range(self.level + 1, BITS + 1)]) if self.finer else np.array([], np.int64)
        used = np.flatnonzero(counters)
        numbers = np.concatenate([self.counts, counters[used]])
        most = int(np.abs(numbers).max(initial=0))
        code = next(i for i, t in enumerate(_SIZES) if most <= np.iinfo(t).max)
        raw = np.diff(self.items, prepend=np.uint64(0)).astype("<u4").tobytes() + np.diff(used, prepend=0).astype("<u2").tobytes() + numbers.astype(_SIZES[code]).tobytes()
        head = bytes([code, self.level]) + len(self.items).to_bytes(4, "little") + len(used).to_bytes(4, "little")
        return head + (pa.compress(raw, codec="zstd", asbytes=True) if len(raw) > 64 else raw)

    @classmethod
    def unpack(cls, packed: bytes) -> Sketch:
        kind, n, m = _SIZES[packed[0]], int.from_bytes(packed[2:6], "little"), int.from_bytes(packed[6:10], "little")
        size = 4 * n + 2 * m + kind.itemsize * (n + m)
        raw = pa.decompress(packed[10:], decompressed_size=size, codec="zstd", asbytes=True) if size > 64 else packed[10:]
        out = cls()
        out.level = packed[1]
        numbers = np.frombuffer(raw, kind, n + m, 4 * n + 2 * m).astype(np.int64)
        out.items, out.counts = np.cumsum(np.frombuffer(raw, "<u4", n), dtype=np.uint64), numbers[:n]
        counters = np.zeros((BITS - out.level) * ROWS * WIDTH, np.int64)
        counters[np.cumsum(np.frombuffer(raw, "<u2", m, 4 * n), dtype=np.int64)] = numbers[n:]
        out.finer = {out.level + 1 + i: c for i, c in enumerate(counters.reshape(-1, ROWS * WIDTH))}
        return out


_SIZES = tuple(np.dtype(t).newbyteorder("<") for t in (np.int8, np.int16, np.int32, np.int64))


def _names(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def build(values: DataFrame, group: str | Sequence[str], value: str, weight: Column | None = None) -> DataFrame:
    """Sketches (group columns, n_values, sketch) of the finite values of each group, several for a group: they add up.

    Each task counts the codes of the rows it reads and makes one sketch for each group it saw, so raw values aren't shuffled
    and a group with most rows is no more work for a task than any other. Null, NaN and infinite values and null groups take no
    part. ``weight`` is 1 for a row, -1 for its deletion. An empty table gives no sketches.
    """
    names = _names(group)
    v = F.col(value).cast("double")
    w = (F.lit(1) if weight is None else weight).cast("long").alias("__w")
    rows = values.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    for n in names:
        rows = rows.filter(F.col(n).isNotNull())
    rows = rows.select(*names, v.alias("__v"), w)
    schema = _schema(rows, names)
    return rows.mapInArrow(_sketches(names), schema)


def _schema(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names) + ", n_values bigint, sketch binary"


def _sketches(names: list[str]):
    def summed(table: pa.Table) -> pa.Table:
        return table.group_by([*names, "__c"], use_threads=False).aggregate([("__w", "sum")]).rename_columns([*names, "__c", "__w"])

    def made(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.sort_by([(n, "ascending") for n in names]).combine_chunks()
        codes, weights = table["__c"].to_numpy().astype(np.uint64), table["__w"].to_numpy()
        changed = np.zeros(len(table), bool)
        changed[:1] = True
        for n in names:
            ids = table[n].combine_chunks().dictionary_encode().indices.to_numpy()
            changed[1:] |= ids[1:] != ids[:-1]
        starts = np.flatnonzero(changed)
        sketches = [Sketch(codes[a:b], weights[a:b]) for a, b in zip(starts, [*starts[1:], len(table)])]
        keys = [table[n].combine_chunks().take(pa.array(starts)) for n in names]
        yield from _batches(keys, sketches, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n, held = [], 0, None
        for batch in batches:
            codes = pa.array(encode(batch.column(len(names)).to_numpy()).astype(np.int64))
            waiting.append(pa.table([*batch.columns[: len(names)], codes, batch.column(len(names) + 1)], [*names, "__c", "__w"]))
            n += len(batch)
            if n >= TOGETHER:
                held = summed(pa.concat_tables([*([held] if held else []), *waiting]))
                waiting, n = [], 0
                if len(held) >= HELD:
                    yield from made(held)
                    held = None
        if waiting or held:
            yield from made(summed(pa.concat_tables([*([held] if held else []), *waiting])))

    return run


def _batches(keys: list[pa.Array], sketches: list[Sketch], names: list[str], step: int = 256) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(sketches), step):
        part = sketches[a : a + step]
        columns = [*(k.slice(a, step) for k in keys), pa.array([x.total for x in part], pa.int64()), pa.array([x.pack() for x in part], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [*names, "n_values", "sketch"])


def _added(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[list[pa.Array], Sketch]]:
    """The sum of the sketches of each group, as its rows come one after the other, with its key as arrays of one."""
    now, key, held = None, None, None
    for batch in batches:
        for i, values in enumerate(zip(*(c.to_pylist() for c in batch.columns[:n_keys]))):
            sketch = Sketch.unpack(batch.column(n_keys)[i].as_py())
            if values == now:
                held.add(sketch)
                continue
            if now is not None:
                yield key, held
            now, key, held = values, [c.slice(i, 1) for c in batch.columns[:n_keys]], sketch
    if now is not None:
        yield key, held


def _by_group(sketches: DataFrame, names: list[str]) -> DataFrame:
    return wide(sketches.select(*names, "sketch"), *names).sortWithinPartitions(*names)


def merge(sketches: DataFrame, group: str | Sequence[str]) -> DataFrame:
    """The sum of sketches given as one table, such as the union of those of several days: one row per group.

    The sketches of a group are streamed and added up, so however many there are, a task holds one.
    """
    names = _names(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, sketch in _added(batches, len(names)):
            yield from _batches(key, [sketch], names)

    return _by_group(sketches, names).mapInArrow(run, _schema(sketches, names))


def percentiles(sketches: DataFrame, group: str | Sequence[str], shares: Sequence[float]) -> DataFrame:
    """(group columns, share, n_values, value, rank_error) from sketches, merged or not.

    ``value`` is off by at most ``VALUE_ERROR`` of itself from a value whose rank is off by at most ``rank_error`` rows,
    but for one case in some thousands, from the rank ceil(share * n). It is 0 where at most ``EXACT`` codes occur. A group whose
    values were all deleted has no rows.
    """
    names, wanted = _names(group), sorted(shares)
    n = len(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, sketch in _added(batches, len(names)):
            if sketch.total > 0:
                codes, error = sketch.descend(wanted)
                columns = [*(k.take(pa.array([0] * n)) for k in key), pa.array(wanted), pa.array([sketch.total] * n), pa.array(decode(codes)), pa.array([error] * n)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "share", "n_values", "value", "rank_error"])

    schema = _schema(sketches, names).removesuffix(", n_values bigint, sketch binary") + ", share double, n_values bigint, value double, rank_error double"
    return _by_group(sketches, names).mapInArrow(run, schema)


def rank_errors(estimates: DataFrame, values: DataFrame, group: str, value: str) -> DataFrame:
    """``estimates`` with ``off_by``: how many ranks the wanted one lies outside those of the estimated value.

    The exact ranks come from one pass over all values, counted per interval between a group's estimates, so nothing
    is compared in pairs and the partial counts are made before the shuffle.
    """
    v = F.col(value).cast("double")
    lo, hi = (lambda e: e - F.abs(e) * VALUE_ERROR), (lambda e: e + F.abs(e) * VALUE_ERROR)
    cuts = estimates.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("share", "value", "n_values", "rank_error"))).alias("est"))
    rows = values.filter(F.col(group).isNotNull() & v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))).select(group, v.alias("v"))
    counts = rows.groupBy(group, "v").agg(F.count(F.lit(1)).alias("n"))
    each = counts.join(cuts, group).select(group, "v", "n", F.explode("est").alias("e"))
    e = F.col("e.value")
    sums = each.groupBy(group, "e").agg(F.sum(F.when(F.col("v") < lo(e), F.col("n")).otherwise(0)).alias("below"), F.sum(F.when(F.col("v") <= hi(e), F.col("n")).otherwise(0)).alias("upto"))
    rank = F.ceil(F.col("e.share") * F.col("e.n_values"))
    off = F.greatest(F.lit(0), F.col("below") + 1 - rank, rank - F.col("upto"))
    return sums.select(group, "e.share", "e.n_values", e.alias("value"), "e.rank_error", off.cast("bigint").alias("off_by"))
