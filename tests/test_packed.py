import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomwork.operators import packed

BITS = {"i1": 1.6, "i2": 10.0, "i3": 6.3, "i4": 3.5, "i5": 2.2, "q1": 6.2, "q4": 7.8, "q5": 6.6, "d1": 6.8, "d5": 7.3, "x": 18.0}
PRICES = packed.Prices(BITS)

CASES = {
    None: [],
    "": [],
    "  \n": [],
    "[]": [],
    ",,;": [],
    "[1, 2]": [1, 2],
    "24252": [24252],
    "(7;8)": [7, 8],
    "{7 8}": [7, 8],
    "<12, 13>": [12, 13],
    "1|1| 1||1|": [1, 1, 1, 1],
    "1||2||3": [1, 2, 3],
    "[19545;'22836';\"7023\";\" 14822 \"]": [19545, 22836, 7023, 14822],
    '"22,085" "31,745" 167': [22085, 31745, 167],
    '"22,085","31,745",167': [22085, 31745, 167],
    "5672 ,6517;16513, 26485 ,20952;29723": [5672, 6517, 16513, 26485, 20952, 29723],
    "1\t1 / 1;3 / 1\t1": [1, 1, 1, 3, 1, 1],
    "[14204.0, 26014.0]": [14204, 26014],
    "\r\n12\r\n13": [12, 13],
    "7023 10499": [7023, 10499],
    "7，8、9；10 • 11": [7, 8, 9, 10, 11],
    "12345, x, 12346": [12345, None, 12346],
    "9" * 30: [None],
    "1\t1 / 1\t1\t1 1 / 1\t1 1 2\t1 1\t1\t1\t2\t2 1\t1\t2 1 1 1 2 2\t1 1 / 2": [1, 1, 1, 1, 1, 1, 1, 1, 1, 2, 1, 1, 1, 1, 2, 2, 1, 1, 2, 1, 1, 1, 2, 2, 1, 1, 2],
    "1, 1;1, 1/1;6, 2;2, 1": [1, 1, 1, 1, 1, 6, 2, 2, 1],
    "1,2;3|4/5、6，7；8•9 10": list(range(1, 11)),
    "['1', '2', \"3,000\"]": [1, 2, 3000],
    "1,,2": [1, 2],
}


@pytest.mark.parametrize("text,want", CASES.items())
def test_cheapest_dialect(text, want):
    assert packed.cheapest(text, PRICES) == want


def every_dialect(text, prices):
    """The cost of the cheapest dialect of all."""
    body, least = packed._body(text), math.inf
    for quotes in {"".join(q for q in packed.QUOTES if q in body), ""}:
        insides = ["".join(m) if isinstance(m, tuple) else m for m in packed._quoted(quotes).findall(body)] if quotes else []
        masked = (packed._quoted(quotes).sub(packed._mask, body) if quotes else body).strip()
        for chosen in packed._subsets(packed.DELIMITERS + packed.BLANK):
            if all(c in masked or c == packed.BLANK for c in chosen):
                parts = [p for x in (packed._pattern(chosen).split(masked) if chosen else [masked]) if (p := x.strip())]
                least = min(least, packed._structure(chosen, quotes, len(parts)) + bits(packed._pieces(parts, insides, prices)))
    return least


def bits(pieces):
    return sum(p[3] for p in pieces)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["1", "22", "333", "1.0", "x", "'4'", '"5,5"', ",", ";", " ", "/", "|", ", ", " ; "]), max_size=14), st.sampled_from([1.0, 9.0, 18.0]))
def test_no_dialect_is_cheaper(parts, bad):
    prices = packed.Prices(BITS | {"x": bad})
    body = packed._body("".join(parts))
    if not body.strip():
        return
    least = every_dialect("".join(parts), prices)
    found = packed.parsed(body, prices)
    masked_names = [packed._structure(c, q, len(found)) for q in {"".join(q for q in packed.QUOTES if q in body), ""} for c in packed._subsets(packed.DELIMITERS + packed.BLANK)]
    assert min(abs(least - bits(found) - m) for m in masked_names) < 1e-6
    plain = packed._integers(body)
    if plain is not None and prices.plain.issuperset(map(len, plain)):
        assert [p[1] for p in found] == list(map(int, plain))


def test_very_long_field():
    assert packed.cheapest("; ".join(str(i) for i in range(10000, 40000)), PRICES) == list(range(10000, 40000))


def test_value_rows(spark):
    data = [
        (1, "[5, 6, 5]", "1|2|3", "x"),
        (1, "5;6;5", "1, 2, 3", "y"),  # the same in another notation
        (2, "7", "", "x"),
        (3, None, None, "x"),
        (None, "8", "1", "x"),
        (4, "[9, 9]", "[1, 1]", "x"),
        (4, "[9, 8]", "[1, 1]", "x"),  # other contents under one id
    ]
    df = spark.createDataFrame(data, "id bigint, f string, v string, pos string")  # a column that clashes
    got = sorted(map(tuple, packed.value_rows(df, "id", "f", "v").collect()), key=str)
    want = [(1, 0, 5, 1), (1, 1, 6, 2), (1, 2, 5, 3), (2, 0, 7, None), (4, 0, 9, 1), (4, 1, 8, 1), (4, 1, 9, 1)]
    assert got == sorted(want, key=str)
    assert packed.value_rows(df.filter("false"), "id", "f", "v").count() == 0


def test_code_lengths_are_those_of_the_frequencies(spark):
    df = spark.createDataFrame([("1",), ("2",), ("33",), (None,)], "f string")
    assert packed.code_lengths(df, ["f"]) == pytest.approx({"i1": math.log2(1.5), "i2": math.log2(3)})
