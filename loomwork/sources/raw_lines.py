"""Text lines of structure files, taken apart into loaded rows and rejected lines with the reason.

Each line is read permissively under the explicit, typed schema of its file's kind, and the parser retains the raw text of
each line that it calls corrupt. These lines, and those where the parser is known to be lenient (blank lines, quotes, line breaks, an index
that isn't digits only), are then classed again: by quoting, by the number of fields, and by casts of the fields of the raw text.
The rules on values that are no matter of types hold for the columns of all lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns and types of each kind of file.
SCHEMAS = {
    "test_standardizer": {"input_compound_id": "string", "smiles": "string"},
    "sn_fold_output": {"idx": "bigint", "input_compound_id": "string", "smiles": "string", "canonical_smiles": "string", "success": "boolean", "error_message": "string"},
}
CORRUPT = "__corrupt"
OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"', "quote": '"', "maxCharsPerColumn": "-1", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
# What the typed parser lets pass: blank lines, quotes in odd places, text after a line break, an index with a sign or digits of other scripts.
LENIENT, NO_DIGITS = r"[\"\r\n]|\A\s*+\z", r"\A[0-9 ]*+[^0-9 ,]"

# A field is quoted, with doubled quotes inside, or holds no quote at all. Possessive, so that no long field is too deep.
FIELD = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
WELL_QUOTED = rf"\A{FIELD}(?:,{FIELD})*+\z"

# The tokens of a structure text.
ATOM = r"(?:Cl|Br|[BCNOPSFIbcnosp]|\[[^\[\]\s]+\])"
TOKENS = rf"\A{ATOM}(?:{ATOM}|[-=#:/\\.()]|%[0-9]{{2}}|[0-9])*+\z"


def trimmed(c: Column) -> Column:
    """Without white space of any script at either end; null stays null."""
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def is_missing(c: Column) -> Column:
    return c.isNull() | (c == "")


def well_formed(smiles: Column) -> Column:
    """Whether a trimmed text is a structure: known tokens only, ring numbers in pairs, parentheses that balance."""
    bare = F.regexp_replace(smiles, r"\[[^\[\]\s]+\]", "")
    rings = F.transform(F.regexp_extract_all(bare, F.lit(r"%([0-9]{2})|[0-9]"), F.lit(0)), lambda r: F.try_to_number(F.ltrim(r, F.lit("%")), F.lit("99")))
    odd = F.exists(F.array_distinct(rings), lambda r: F.size(F.filter(rings, lambda x: x == r)) % 2 == 1)
    marks = F.split(F.regexp_replace(bare, r"[^()]", ""), "")
    depth = F.aggregate(
        marks,
        F.lit(0),
        lambda at, c: F.when(at < 0, at).when(c == "(", at + 1).when(c == ")", at - 1).otherwise(at),
    )
    return F.coalesce(smiles.rlike(TOKENS) & ~odd & (depth == 0), F.lit(False))


def _once(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` computed once for each row, however often they are used later on."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def classify(lines: DataFrame, keep: tuple[str, ...] = ("line_id", "file_name", "line_no")) -> DataFrame:
    """``lines`` (file_kind, line and ``keep``) with all fields in typed columns, and ``reason``, null for a valid line.

    ``reason`` is the first that holds of ``quoting``, ``columns`` and ``value``. A null line has no fields and is
    rejected for ``columns``, as is a line of an unknown kind. Repeated lines stay; each line is judged on its own. Texts
    are trimmed, and empty ones null; an index of digits beyond bigint is valid and null.
    """
    line, kind = F.col("line"), F.col("file_kind")
    keep = (*keep, "file_kind", "line")
    of = lambda name, schema: F.when(kind == name, F.from_csv(line, f"{schema}, {CORRUPT} string", OPTIONS))
    read = _once(lines, *keep, **{f"__{n}": of(n, ", ".join(f"{c} {t}" for c, t in columns.items())) for n, columns in SCHEMAS.items()})

    # Classed again: what the parser called corrupt, and where it is lenient. Their fields are taken from the raw text.
    raw = F.coalesce(*[F.col(f"__{n}.{CORRUPT}") for n in SCHEMAS], F.when(line.rlike(LENIENT) | (kind == "sn_fold_output") & line.rlike(NO_DIGITS), line))
    typed = {n: f"__{n}" for n in SCHEMAS}
    read = _once(read, *keep, *typed.values(), __raw=raw)
    texts = {f"__{n}_text": F.when(kind == n, F.from_csv("__raw", ", ".join(f"{c} string" for c in columns), OPTIONS)) for n, columns in SCHEMAS.items()}
    read = _once(read, *keep, "__raw", *typed.values(), **texts)
    again = F.col("__raw").isNotNull()
    commas = F.length(F.regexp_replace("__raw", r'"(?:[^"]++|"")*+"|[^,"]++', ""))
    wanted = F.coalesce(*[F.when(kind == n, F.lit(len(columns))) for n, columns in SCHEMAS.items()], F.lit(-1))
    known = kind.isin(*SCHEMAS) & line.isNotNull()

    every = {c: t for columns in SCHEMAS.values() for c, t in columns.items()}
    text, value = {}, {}
    for c, t in every.items():
        held = [n for n, columns in SCHEMAS.items() if c in columns]
        text[c] = trimmed(F.coalesce(*[F.col(f"__{n}_text.{c}") for n in held]))
        plain = F.coalesce(*[F.col(f"__{n}.{c}") for n in held])
        value[c] = F.when(again, text[c] if t == "string" else text[c].try_cast(t)).otherwise(trimmed(plain) if t == "string" else plain)
    # Casts: all digits are an index, whatever their number; of texts that cast to a boolean only two count.
    value["__idx_ok"] = F.when(again, text["idx"].rlike(r"\A[0-9]+\z")).otherwise(value["idx"].isNotNull())
    value["success"] = F.when(~again | F.lower(text["success"]).isin("true", "false"), value["success"])
    value["__form"] = F.when(~F.coalesce(known, F.lit(False)), "columns").when(again & ~F.col("__raw").rlike(WELL_QUOTED), F.when(line.isNotNull(), "quoting")).when(again & (commas + 1 != wanted), "columns")
    rows = _once(read, *keep, **value)

    done = F.col("success")
    bad_id = ~F.coalesce(F.col("input_compound_id").rlike(r"\ACMP[0-9]+\z"), F.lit(False))
    bad_structure = ~well_formed(F.col("smiles"))
    bad_fold = (
        ~F.coalesce(F.col("__idx_ok"), F.lit(False))
        | done.isNull()
        | (done & (bad_structure | ~well_formed(F.col("canonical_smiles")) | ~is_missing(F.col("error_message"))))
        | (~done & (is_missing(F.col("error_message")) | ~is_missing(F.col("canonical_smiles"))))
    )
    bad_value = bad_id | F.when(kind == "test_standardizer", bad_structure).otherwise(F.coalesce(bad_fold, F.lit(True)))
    reason = F.coalesce("__form", F.when(bad_value, "value"))
    present = {c: F.when(F.col(c) != "", F.col(c)) if t == "string" else F.col(c) for c, t in every.items()}
    return _once(rows, *keep, **present, reason=reason)


def rejected(lines: DataFrame, keep: tuple[str, ...] = ("line_id", "file_name", "line_no")) -> DataFrame:
    """The lines that can't be loaded, with their raw text and the reason."""
    return classify(lines, keep).filter(F.col("reason").isNotNull()).select(*keep, "file_kind", "line", "reason")


def loaded(lines: DataFrame, kind: str, keep: tuple[str, ...] = ("line_id", "file_name", "line_no")) -> DataFrame:
    """The valid rows of one kind of file in typed columns; empty text is null. An index beyond bigint is null."""
    return classify(lines.filter(F.col("file_kind") == kind), keep).filter(F.col("reason").isNull()).select(*keep, *SCHEMAS[kind])
