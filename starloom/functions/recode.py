"""Column expressions: recodes, labels, encodings and null-safe predicates.

All are built-in Catalyst expressions (CASE WHEN / IN / CAST), so they stay
inside whole-stage codegen; no Python UDF is involved anywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom import spec as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# SQL text of the same expressions.  A predicate over a named column is handed
# to Spark's parser as one expression string: Catalyst gets the identical
# IN / CASE tree, but the driver sends one call instead of one per literal
# (building the cleaning plan otherwise costs thousands of py4j round trips).
def quote(name: str) -> str:
    """Column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_literal(v) -> str:
    """A Python int / float / str / bool as the SQL literal ``F.lit`` would make."""
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        if v != v or v in (float("inf"), float("-inf")):
            raise TypeError(f"no SQL literal for {v!r}")
        return f"{v!r}D"                      # D: a DOUBLE literal, not a DECIMAL
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"no SQL literal for {v!r}")


def _renderable(values) -> bool:
    try:
        [sql_literal(v) for v in values]
    except TypeError:
        return False
    return True


def sql_in(expr: str, values: Iterable) -> str:
    return f"{expr} IN ({', '.join(sql_literal(v) for v in values)})"


def sql_case(expr: str, mapping: Mapping, otherwise: str | None = None) -> str:
    """CASE WHEN expr = k1 THEN v1 ... [ELSE otherwise] END (null when unmatched)."""
    arms = " ".join(f"WHEN {expr} = {sql_literal(k)} THEN {sql_literal(v)}"
                    for k, v in mapping.items())
    tail = f" ELSE {otherwise}" if otherwise is not None else ""
    return f"CASE {arms}{tail} END"


def sql_in_domain(expr: str, values: Iterable) -> str:
    return f"coalesce({sql_in(expr, values)}, false)"


def in_domain(c: str | Column, values: Iterable) -> Column:
    """True when the value is in ``values``; False (never null) for null.

    pandas ``isin`` is False for a missing value and ``~isin`` is True, while
    Spark's IN yields null on null input; coalescing keeps the pandas meaning
    under negation (decision D6).
    """
    values = list(values)
    if isinstance(c, str) and values and _renderable(values):
        return F.expr(sql_in_domain(quote(c), values))
    return F.coalesce(col(c).isin(values), F.lit(False))


def keep_in(c: str | Column, values: Iterable) -> Column:
    """Filter form of ``in_domain``: a plain IN, which parquet can push down.

    Inside a filter a null result already drops the row, so no coalesce is
    needed; use ``in_domain`` wherever the predicate is negated or kept.
    """
    values = list(values)
    if isinstance(c, str) and values and _renderable(values):
        return F.expr(sql_in(quote(c), values))
    return col(c).isin(values)


def not_in_domain(c: str | Column, values: Iterable) -> Column:
    return ~in_domain(c, values)


def lookup(c: str | Column, mapping: Mapping, otherwise=None) -> Column:
    """CASE c WHEN k1 THEN v1 ... [ELSE otherwise] END (null when unmatched)."""
    plain = otherwise is None or not isinstance(otherwise, Column)
    if isinstance(c, str) and mapping and plain and \
            _renderable(list(mapping) + list(mapping.values()) +
                        ([] if otherwise is None else [otherwise])):
        return F.expr(sql_case(quote(c), mapping,
                               None if otherwise is None else sql_literal(otherwise)))
    expr = None
    for k, v in mapping.items():
        cond = col(c) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if otherwise is not None:
        expr = expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return expr


# C1 -------------------------------------------------------------------------
def recode_target(c: str | Column, labels: Mapping = S.TARGET_LABELS) -> Column:
    return lookup(c, labels)


# C2 -------------------------------------------------------------------------
def binary_codes(encoding: str) -> list[int]:
    """Valid raw codes for a declared binary encoding."""
    return [0, 1] if encoding == "01" else [1, 2]


def recode_binary(c: str | Column, encoding: str) -> Column:
    """Yes/No label.  "01": 0->No, 1->Yes.  "12": 1->Yes, 2->No (2 becomes 0).

    Applied after the rows outside the encoding's codes were filtered, so the
    ``otherwise`` branch only ever sees the "No" code.
    """
    yes_code = 1
    if isinstance(c, str):
        return F.expr(recode_binary_sql(quote(c)))
    return F.when(col(c) == F.lit(yes_code), F.lit(S.YES)).otherwise(F.lit(S.NO))


def recode_binary_sql(expr: str) -> str:
    return sql_case(expr, {1: S.YES}, sql_literal(S.NO))


def recode_binary_lenient(c: str | Column, encoding: str) -> Column:
    """Yes/No label without prior filtering: codes outside the encoding -> null."""
    if isinstance(c, str):
        return F.expr(recode_binary_lenient_sql(quote(c), encoding))
    no_code = 0 if encoding == "01" else 2
    return F.when(col(c) == 1, F.lit(S.YES)).when(col(c) == no_code, F.lit(S.NO))


def recode_binary_lenient_sql(expr: str, encoding: str) -> str:
    no_code = 0 if encoding == "01" else 2
    return sql_case(expr, {1: S.YES, no_code: S.NO})


# C3 -------------------------------------------------------------------------
def recode_sex(c: str | Column, labels: Mapping = S.SEX_LABELS) -> Column:
    """1->Male, 2->Female; anything else becomes null (counted as unmapped)."""
    return lookup(c, labels)


# C4 / C5 --------------------------------------------------------------------
def case_label(c: str | Column, labels: Mapping) -> Column:
    """CASE c WHEN .. THEN .. END with no ELSE: unmatched and null -> null."""
    return lookup(c, labels)


def case_else_label(c: str | Column, when_zero: str, otherwise: str) -> Column:
    """CASE c WHEN 0 THEN a ELSE b END: null falls into the ELSE branch."""
    return lookup(c, {0: when_zero}, otherwise)


# C6 -------------------------------------------------------------------------
def size_mb(bytes_col: str | Column) -> Column:
    return F.round(col(bytes_col) / 1024 / 1024, 2)


# C7 -------------------------------------------------------------------------
def encode_status(c: str | Column) -> Column:
    """Healthy->0, Prediabetic->1, Diabetic->2 (other labels -> null)."""
    return lookup(c, S.STATUS_CODES).cast("int")


def decode_status(c: str | Column) -> Column:
    return lookup(c, {v: k for k, v in S.STATUS_CODES.items()})


def encode_flag(c: str | Column) -> Column:
    """Yes->1, No->0 (other labels -> null)."""
    return lookup(c, S.FLAG_CODES).cast("int")


def decode_flag(c: str | Column) -> Column:
    return lookup(c, {v: k for k, v in S.FLAG_CODES.items()})


# P6 -------------------------------------------------------------------------
def scale_bmi(c: str | Column) -> Column:
    return col(c) / F.lit(S.BMI_SCALE)


# D4 -------------------------------------------------------------------------
NULL_TOKENS = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "#N/A", "-NaN", "-nan",
               "<NA>", "n/a", "NAN"]


def parse_number(c: str | Column) -> Column:
    """String cell -> double: trim, null out missing-value tokens, try_cast."""
    if isinstance(c, str):
        t = f"trim({quote(c)})"
        return F.expr(f"CASE WHEN {sql_in(t, NULL_TOKENS)} THEN CAST(NULL AS DOUBLE) "
                      f"ELSE try_cast({t} AS DOUBLE) END")
    trimmed = F.trim(col(c))
    return F.when(trimmed.isin(NULL_TOKENS), F.lit(None).cast("double")) \
        .otherwise(trimmed.try_cast("double"))
