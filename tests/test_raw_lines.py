import pytest

from loomwork.sources import raw_lines

A, B = "test_standardizer", "sn_fold_output"
CASES = [
    (A, "CMP1,CCO", None),
    (A, ' CMP1 ,"CCO"', None),
    (A, '"CMP1","C[N+](C)C"', None),
    (A, '"CMP1,CCO', "quoting"),
    (A, 'CMP1,C"CO', "quoting"),
    (A, ' "CMP1",CCO', "quoting"),
    (A, '"CMP1" ,CCO', "quoting"),
    (A, '"CMP1,CCO""', "quoting"),
    (A, 'CMP1,"C""O"', "value"),
    (A, "CMP1", "columns"),
    (A, "", "columns"),
    (A, None, "columns"),
    (A, "CMP1,CCO,", "columns"),
    (A, "CMP,CCO", "value"),
    (A, "cmp1,CCO", "value"),
    (A, "CMP1,", "value"),
    (A, "CMP1,=CCO", "value"),
    (A, "CMP1,C1CC", "value"),
    (A, "CMP1,C1CC1", None),
    (A, "CMP1,C%12CC%12", None),
    (A, "CMP1,C%12CC", "value"),
    (A, "CMP1,C(C", "value"),
    (A, "CMP1,CC)C(", "value"),
    (A, "CMP1,C[N H]", "value"),
    (A, "CMP1,C[NH3+", "value"),
    (A, "CMP1,C[13C]1CC1/C=C\\Cl", None),
    (A, "CMP1,C C", "value"),
    (A, "CMP1," + "C(C)" * 30000, None),
    (A, "CMP1," + '"' + "C" * 200000 + '"', None),
    (B, "1,CMP1,CCO,CCO,True,", None),
    (B, '1,CMP1,CCO,CCO,TRUE,""', None),
    (B, "x,CMP1,CCO,CCO,True,", "value"),
    (B, "1,CMP1,CCO,CCO,1.0,", "value"),
    (B, "1,CMP1,CCO,,True,", "value"),
    (B, "1,CMP1,CCO,CCO,True,why", "value"),
    (B, "1,CMP1,!!,,False,why", None),
    (B, "1,CMP1,CCO,CCO,False,why", "value"),
    (B, "1,CMP1,CCO,,False,", "value"),
    (B, '1,CMP1,CCO,,False,"a, b"', None),
    (B, "1,CMP1,CCO,,False,a, b", "columns"),
    (B, "-1,CMP1,CCO,CCO,True,", "value"),
    (B, "+1,CMP1,CCO,CCO,True,", "value"),
    (B, "١٢,CMP1,CCO,CCO,True,", "value"),
    (B, "\u00a012 ,CMP1,CCO,CCO,True,", None),
    (B, "99999999999999999999,CMP1,CCO,CCO,True,", None),
    (B, "1,CMP1,CCO,CCO,yes,", "value"),
    (B, '1,CMP1,CCO,CCO," true ",', None),
    (B, "1,CMP1,CCO,CCO,True,\nx", "value"),
    (A, "CMP1,CCO\nCMP2,CCO", "columns"),
    (A, '"', "quoting"),
    ("other", "1,2", "columns"),
    ("other", '1,"2', "columns"),
    (None, "1,2", "columns"),
]


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(i, k, "f", i, t, "x") for i, (k, t, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "line_id bigint, file_kind string, file_name string, line_no bigint, line string, reason string")


def test_reasons(lines):
    got = {r.line_id: r.reason for r in raw_lines.classify(lines).collect()}
    assert [(CASES[i], got[i]) for i in got if got[i] != CASES[i][2]] == []


def test_loaded_and_rejected_are_all(lines):
    n = sum(raw_lines.loaded(lines, k).count() for k in (A, B)) + raw_lines.rejected(lines).count()
    assert n == len(CASES)


def test_typed_rows(lines):
    row = next(r for r in raw_lines.loaded(lines, B).collect() if r.error_message == "a, b")
    assert (row.idx, row.success, row.canonical_smiles) == (1, False, None)


def test_empty_table(lines):
    assert raw_lines.classify(lines.filter("false")).count() == 0
