"""Several values packed in one text field, taken apart by the dialect with the shortest description.

A dialect is a set of delimiters and a set of quotes. What a field costs under a dialect is the number of bits that
describe the dialect, the delimiters used, and each value: the code length of the value's form, learned from the whole
table, and the bits of its digits. Text that is no value costs a byte's bits for each character, so a dialect that
cuts a number in two, or leaves two in one piece, loses.

Code lengths come in two rounds, as the dialects depend on them: all fields are parsed by their cheapest dialect under
prior lengths, the forms of their values are counted over the whole table, and all fields are parsed again.

Not every set of delimiters has to be tried. Let the full set be the least that parts the field at each of its separators and leaves
none of its marks in a piece. A set that does so too has the same pieces and is longer. Of all others a bound is known: each
value costs its price or that of its characters at least, and so does what is left of separators. Only sets below it are parsed.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.session import cut

# What may part two values, what may quote one, what may enclose a list. White space is one delimiter.
DELIMITERS = ",;|/、，；•"
BLANK = " "
QUOTES = "\"'"
BRACKETS = "[](){}<>"

#: Bits for naming one delimiter or quote of a dialect, and for one character of a piece that is no value.
NAME_BITS, BAD_CHAR_BITS = 4.0, 8.0
DIGIT_BITS = math.log2(10)
#: Forms are told apart up to this many digits, more than any bigint has; their table is thus bounded. Each digit has its price.
MOST_DIGITS = 20
#: Bits of a piece that is no value, in the first round.
PRIOR_BAD_BITS = 16.0
KINDS = "idq"

_plain = re.compile(r"(\d+)(\.0*)?")
_grouped = re.compile(r"\d+(?:,\d+)*(?:\.0*)?")
_separator = re.compile(rf"([{DELIMITERS}\s]+)")
_between = re.compile(rf"\d+([{DELIMITERS}\s]+)\d")
_mask = "\x01"


@lru_cache(1 << 18)
def piece_value(piece: str) -> tuple[str, int | None, int]:
    """The form of an unquoted piece, its value, and its digits; the form is ``x`` and the value None if it is no integer."""
    m = _plain.fullmatch(piece)
    if m is None:
        return "x", None, 0
    return ("d" if m[2] else "i") + str(min(len(m[1]), MOST_DIGITS)), int(m[1]), len(m[1])


@lru_cache(1 << 18)
def quoted_value(inside: str) -> tuple[str, int | None, int]:
    """The same for what stands between quotes; there, commas and blanks group digits."""
    text = re.sub(r"\s+", "", inside)
    if _grouped.fullmatch(text) is None:
        return "x", None, 0
    digits = text.split(".")[0].replace(",", "")
    return "q" + str(min(len(digits), MOST_DIGITS)), int(digits), len(digits)


class Prices:
    """Bits of the form of a value, besides its digits, and which integers can't be cheaper as anything else."""

    def __init__(self, bits: dict[str, float] | None = None):
        self.bits = bits
        forms = [f"{kind}{n}" for kind in KINDS for n in range(MOST_DIGITS + 1)]
        if bits is None:
            self.of = dict.fromkeys(forms, math.log2(len(forms))) | {"x": PRIOR_BAD_BITS}
        else:
            unseen = max(bits.values(), default=0.0) + 1.0
            self.of = {form: bits.get(form, unseen) for form in (*forms, "x")}
        self.piece, self.quoted = (lru_cache(1 << 17)(lambda text, read=read: self._priced(*read(text), len(text))) for read in (piece_value, quoted_value))
        # Where all values of a field are integers between equal separators, other dialects have pieces that are no values.
        # None of them is cheaper if each value has fewer bits than its characters and one separator, and a piece 8 bits of its own.
        fits = lambda n: self.of[f"i{n}"] + DIGIT_BITS * n <= BAD_CHAR_BITS * (n + 1)
        self.plain = frozenset(n for n in range(1, MOST_DIGITS) if fits(n)) if self.of["x"] >= BAD_CHAR_BITS else frozenset()


    def __reduce__(self) -> tuple:
        return Prices, (self.bits,)  # caches stay behind

    def _priced(self, form: str, value: int | None, digits: int, size: int) -> tuple[str, int | None, int, float, float]:
        """(form, value, digits, bits, the least bits that its characters have in any dialect)."""
        if form == "x":
            return self.bad(size)
        cost = self.of[form] + DIGIT_BITS * digits
        return form, value, digits, cost, min(cost, BAD_CHAR_BITS * size)

    def bad(self, size: int) -> tuple[str, None, int, float, float]:
        return "x", None, 0, self.of["x"] + BAD_CHAR_BITS * size, BAD_CHAR_BITS * size


@lru_cache(4096)
def _pattern(chosen: str) -> re.Pattern:
    return re.compile("[" + "".join(re.escape(c) for c in chosen if c != BLANK) + (r"\s" if BLANK in chosen else "") + "]")


@lru_cache(4096)
def _subsets(marks: str) -> tuple[str, ...]:
    return tuple("".join(c) for n in range(len(marks) + 1) for c in combinations(marks, n))


@lru_cache(16)
def _quoted(quotes: str) -> re.Pattern:
    return re.compile("|".join(f"{q}([^{q}]*){q}" for q in quotes))


def _pieces(parts: list[str], insides: list[str], prices: Prices) -> Iterator[tuple]:
    """What ``Prices.piece`` tells of each part, of which masks stand for the quoted ``insides``."""
    at = 0
    for p in parts:
        if _mask not in p:
            yield prices.piece(p)
        elif p == _mask:
            yield prices.quoted(insides[at])
            at += 1
        else:
            n = p.count(_mask)
            yield prices.bad(len(p) + sum(2 + len(x) for x in insides[at : at + n]))
            at += n


def _integers(body: str) -> list[str] | None:
    """The values of a field of integers between equal separators with one kind of mark; None if it is none."""
    m = _between.match(body)
    if m is None:
        return None
    separator = m[1]
    if len(set("".join(separator.split()))) > 1:
        return None
    parts = body.split(separator)
    return parts if "".join(parts).isdecimal() and "" not in parts else None


def _structure(chosen: str, quotes: str, parts: int) -> float:
    return NAME_BITS * (len(chosen) + len(quotes)) + (math.log2(len(chosen)) * parts if len(chosen) > 1 else 0.0)


def parsed(body: str, prices: Prices) -> list[tuple]:
    """The pieces of a field, without its brackets, under its cheapest dialect; of equal ones the first tried."""
    best: list = []
    least = math.inf
    present = "".join(q for q in QUOTES if q in body)

    def attempt(chosen: str, quotes: str, masked: str, insides: list[str]) -> list | None:
        nonlocal best, least
        parts = [p for x in (_pattern(chosen).split(masked) if chosen else [masked]) if (p := x.strip())]
        cost, found = _structure(chosen, quotes, len(parts)), []
        for piece in _pieces(parts, insides, prices):
            cost += piece[3]
            if cost >= least:
                return None
            found.append(piece)
        best, least = found, cost
        return found

    for quotes in dict.fromkeys((present, "")):
        if best and BAD_CHAR_BITS * sum(map(body.count, present)) + prices.of["x"] + DIGIT_BITS * sum(p[2] for p in best) >= least:
            break  # each quote is a bad character then, and each digit costs its bits at least
        insides = ["".join(m) if isinstance(m, tuple) else m for m in _quoted(quotes).findall(body)] if quotes else []
        masked = (_quoted(quotes).sub(_mask, body) if quotes else body).strip()
        split = _separator.split(masked)
        separators = Counter(split[1::2])
        marks = {c for s in separators for c in s if c in DELIMITERS}
        blank = any(s.isspace() for s in separators)
        full = "".join(c for c in DELIMITERS if c in marks) + BLANK * blank
        found = attempt(full, quotes, masked, insides)
        every = full if blank or not any(c.isspace() for s in separators for c in s) else full + BLANK
        bound = sum(p[4] for p in found or _pieces([a for a in split[::2] if a], insides, prices)) + prices.of["x"]
        for chosen in _subsets(every):
            if _structure(chosen, quotes, 0) + bound < least:
                left = sum(n * (sum(c in DELIMITERS and c not in chosen for c in s) or (s.isspace() and BLANK not in chosen)) for s, n in separators.items())
                if left and _structure(chosen, quotes, 0) + bound + BAD_CHAR_BITS * left < least:
                    attempt(chosen, quotes, masked, insides)
    return best


def _body(text: str) -> str:
    return text.strip().strip(BRACKETS).replace(_mask, "?")


def cheapest(text: str | None, prices: Prices) -> list[int | None]:
    """The values of a field under its cheapest dialect; [] for a null or blank field or one of empty places only."""
    if text is None:
        return []
    body = _body(text)
    plain = _integers(body)
    if plain is not None and prices.plain.issuperset(map(len, plain)):
        values = list(map(int, plain))
    else:
        values = [piece[1] for piece in parsed(body, prices)]
    most = 2**63
    return values if all(v is not None and v < most for v in values) else [v if v is not None and v < most else None for v in values]


def count_forms(text: str, prices: Prices, seen: Counter) -> None:
    """Adds the forms of the values of a field, under its cheapest dialect."""
    body = _body(text)
    plain = _integers(body)
    if plain is not None and prices.plain.issuperset(lengths := list(map(len, plain))):
        for n, times in Counter(lengths).items():
            seen[f"i{n}"] += times
    else:
        seen.update(piece[0] for piece in parsed(body, prices))


def code_lengths(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Bits for each form of value, from its frequency over all fields, each parsed by its cheapest dialect under prior lengths.

    The result has at most 3 * (MOST_DIGITS + 1) + 1 entries, whatever the data; the counting is Spark's.
    """
    prior = Prices()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for column in batch.columns:
                for text in column.to_pylist():
                    if text is not None:
                        count_forms(text, prior, seen)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["form", "n"])

    rows = df.select(*columns).mapInArrow(count, "form string, n bigint").groupBy("form").agg(F.sum("n").alias("n")).collect()
    total = sum(r.n for r in rows)
    return {r.form: -math.log2(r.n / total) for r in rows}


def _lists(values: list[list[int | None]]) -> pa.ListArray:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(chain.from_iterable(values), pa.int64(), size=int(offsets[-1])))


def unpack(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``df`` with each of the packed ``columns`` as an array of bigint; of the others only ``keep`` remain.

    A null, empty or blank field is an empty array. Empty places take no position. A piece that is no non-negative
    integer keeps its position with a null value, as does one beyond bigint. No row is lost; repeated rows stay.
    """
    prices = Prices(code_lengths(df, columns))
    slim = df.select(*keep, *columns)
    names = [*keep, *columns]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [batch.column(i) for i in range(len(keep))]
            for i in range(len(keep), len(names)):
                texts = batch.column(i).to_pylist()
                arrays.append(_lists([cheapest(t, prices) for t in texts]))
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name in keep] + [f"`{c}` array<bigint>" for c in columns])
    return slim.mapInArrow(parse, schema)


def value_sets(df: DataFrame, key: str, feats: str, vals: str) -> tuple[DataFrame, DataFrame]:
    """(once, several): rows (key, feats array, vals array) of keys with one row, and of keys with more; null keys take no part.

    All rows are parsed where they are read. Only keys are shuffled to be counted. The keys with several rows are written, so
    that the joins that part the rows broadcast them only while their size is known to allow it.
    """
    sets = cut(unpack(df.filter(F.col(key).isNotNull()), [key], [feats, vals]), "unpacked")
    several = cut(sets.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1).select(key), "several")
    return sets.join(several, key, "left_anti"), sets.join(several, key, "left_semi")


def _exploded(sets: DataFrame, key: str, feats: str, vals: str) -> DataFrame:
    return sets.select(key, vals, F.posexplode(feats).alias("pos", "feat")).select(key, "pos", "feat", F.get(vals, F.col("pos")).alias("val"))


def distinct_values(several: DataFrame, key: str, feats: str, vals: str) -> DataFrame:
    """(key, pos, feat, val) of keys with several rows, each once, whatever the notation."""
    return _exploded(several, key, feats, vals).distinct()


def value_rows(df: DataFrame, key: str, feats: str, vals: str) -> DataFrame:
    """(key, pos, feat, val): one row per value packed in ``feats``; ``val`` is the value of ``vals`` at that place.

    Positions count from 0. Where ``vals`` is shorter, ``val`` is null; values beyond the end of ``feats`` are left
    out. A key that comes with several texts yields each distinct row once, whatever the notation.
    """
    once, several = value_sets(df, key, feats, vals)
    return _exploded(once, key, feats, vals).unionByName(distinct_values(several, key, feats, vals))
