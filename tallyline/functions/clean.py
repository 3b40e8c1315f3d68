"""Column cleaners for messy text columns (null tokens, unit numbers, id lists).

All helpers return ``Column`` expressions built from Spark built-ins, so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for "no value" in the source tables.
NULL_TOKENS = ("null",)
CANCELLATION_NULL_TOKENS = ("null", "nan", "")
# Unit suffixes and the character sets trimmed for them.
DISTANCE_UNITS = ("km",)
DURATION_UNITS = ("mins", "minute", "minutes")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def norm_text(col: str | Column) -> Column:
    """Case- and blank-insensitive form used for token comparisons."""
    return F.lower(F.trim(_c(col)))


def null_if_token(col: str | Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """NULL when the value is NULL or one of ``tokens`` (case-insensitive)."""
    c = _c(col)
    return F.when(c.isNull() | norm_text(c).isin(list(tokens)), F.lit(None)).otherwise(c)


def blank_if_token(col: str | Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """'' when the value is NULL or a null token, else the value."""
    c = _c(col)
    return F.when(c.isNull() | norm_text(c).isin(list(tokens)), F.lit("")).otherwise(c)


def strip_unit(col: str | Column, units: Iterable[str]) -> Column:
    """Remove a trailing unit: the first unit the text ends with has its
    characters trimmed from both ends (character-set trim, like SQL TRIM)."""
    c = F.lower(_c(col))
    expr = c
    for u in reversed(list(units)):
        expr = F.when(c.endswith(u), F.btrim(c, F.lit(u))).otherwise(expr)
    return expr


def parse_number(col: str | Column, units: Iterable[str] = (), as_type: str = "double",
                 tokens: Iterable[str] = ("null", "nan", "")) -> Column:
    """Numeric value of a text with an optional unit suffix.

    Null tokens (and 'NaN', which Spark would otherwise turn into a NaN double)
    become NULL; text that is not a number after the unit is stripped becomes
    NULL instead of failing the job.
    """
    c = _c(col)
    stripped = strip_unit(c, units) if units else c
    return F.when(c.isNull() | norm_text(c).isin(list(tokens)), F.lit(None).cast(as_type)) \
        .otherwise(F.trim(stripped).try_cast(as_type))


def parse_timestamp(col: str | Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    c = _c(col)
    return F.when(c.isNull() | norm_text(c).isin(list(tokens)), F.lit(None).cast("timestamp_ntz")) \
        .otherwise(F.trim(c).try_cast("timestamp_ntz"))


def to_int(text: str | Column) -> Column:
    """BIGINT value of an integer text, NULL for anything else (blank, words,
    beyond BIGINT).  The digits are checked before casting: a failing ANSI
    ``try_cast`` raises and catches an exception per row, which is slow when
    most tokens are blank; only 19-digit numbers, which may overflow, take it."""
    t = F.trim(_c(text))
    return F.when(t.rlike(r"^[+-]?0*[0-9]{1,18}$"), t.cast("bigint")).when(t.rlike(r"^[+-]?0*[0-9]{19}$"), t.try_cast("bigint"))


def split_tokens(col: str | Column, sep: str = ",") -> Column:
    """Trimmed text elements of a separated list; '' gives one blank element."""
    return F.transform(F.split(_c(col), sep), lambda x: F.trim(x))


def parse_id_list(col: str | Column, sep: str = ",") -> Column:
    """ARRAY<BIGINT> of the ids in a separated list; blanks and non-numbers dropped,
    NULL / '' give an empty array."""
    c = _c(col)
    ids = F.filter(F.transform(F.split(c, sep), to_int), lambda x: x.isNotNull())
    # a text without a digit holds no id: skip the (interpreted) lambdas for it
    return F.when(c.rlike("[0-9]"), ids).otherwise(F.array().cast("array<bigint>"))


def signed_amount(txn_type: str | Column, amount: str | Column,
                  debit_types: Iterable[str] = ("withdrawal", "purchase")) -> Column:
    """Amount with debits negated; every other type (unknown ones too) is a credit."""
    return F.when(norm_text(txn_type).isin(list(debit_types)), -_c(amount)).otherwise(_c(amount))
