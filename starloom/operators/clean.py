"""Cleaning and recoding (E1): F1 -> F2/C1 -> F3/C2 -> P6 -> F4 -> C3 -> P3 -> F5.

Each step is a narrow DataFrame transformation; chained, Catalyst collapses the
filters into one predicate and the recodes into one projection, so the whole
clean step is a single map-only stage (no shuffle).  Steps tolerate missing
columns the way the spec says: a step whose column is absent is skipped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import spec as S
from starloom.functions import recode as R


def _and(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


# F1 -------------------------------------------------------------------------
def drop_any_null(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column (pandas ``dropna()``).

    Written as AND of IS NOT NULL (same rows as ``na.drop``) so each test is
    pushed into the parquet scan.
    """
    return df.filter(not_null_predicate(df))


def not_null_predicate(df: DataFrame) -> Column:
    cols = df.columns
    if not cols:
        return F.lit(True)
    return F.expr(" AND ".join(f"{R.quote(c)} IS NOT NULL" for c in cols))


# F2 + C1 --------------------------------------------------------------------
def target_predicate(spec: S.SurveySpec) -> Column:
    return R.in_domain(spec.target, list(spec.target_labels))


def valid_target(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """Keep valid target codes and turn them into labels; skipped if absent."""
    if not spec.target or spec.target not in df.columns:
        return df
    return (df.filter(R.keep_in(spec.target, list(spec.target_labels)))
              .withColumn(spec.target, R.recode_target(spec.target, spec.target_labels)))


# F3 + C2 --------------------------------------------------------------------
def binary_predicate(column: str, mode: str | None) -> Column:
    if mode is None:
        return F.lit(True)
    return R.in_domain(column, R.binary_codes(mode))


def apply_binary_modes(df: DataFrame, modes: dict) -> DataFrame:
    """Filter each binary column to its mode's codes and label it Yes/No.

    ``modes[c]`` is "01", "12" or None (no binary pattern: rows untouched, the
    value kept as text so the schema stays stable; validation then rejects it).
    """
    have = set(df.columns)
    present = [c for c in modes if c in have]
    if not present:
        return df
    df = df.filter(_and([R.keep_in(c, R.binary_codes(modes[c]))
                         for c in present if modes[c] is not None]))
    return df.withColumns({
        c: (R.recode_binary(c, modes[c]) if modes[c] is not None
            else F.col(c).cast("string"))
        for c in present})


def binary_declared(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """F3 with the encodings declared in the spec: one pass, stream-safe."""
    return apply_binary_modes(df, {c: spec.binary_encoding[c] for c in spec.binaries})


def binary_inferred(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """F3 with each column's encoding inferred from the data, exactly."""
    from starloom.operators.binary import infer_binary_modes

    have = set(df.columns)
    modes = infer_binary_modes(df, [c for c in spec.binaries if c in have])
    return apply_binary_modes(df, modes)


# P6 -------------------------------------------------------------------------
def scale_bmi(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    if not spec.bmi_column or spec.bmi_column not in df.columns:
        return df
    return df.withColumn(spec.bmi_column, R.scale_bmi(spec.bmi_column))


# F4 -------------------------------------------------------------------------
def ordinal_domain(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """Keep rows whose ordinal codes are all valid (order-free result)."""
    have = set(df.columns)
    return df.filter(_and([R.keep_in(c, dom) for c, dom in spec.ordinals.items()
                           if c in have]))


# C3 -------------------------------------------------------------------------
def recode_sex(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """1->Male, 2->Female; other codes become null (see ``unmapped_count``)."""
    if not spec.sex_column or spec.sex_column not in df.columns:
        return df
    return df.withColumn(spec.sex_column, R.recode_sex(spec.sex_column, spec.sex_labels))


# P3 -------------------------------------------------------------------------
def rename_clean(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """Raw names -> clean names; unknown names untouched."""
    have = set(df.columns)
    return df.withColumnsRenamed({k: v for k, v in spec.rename.items() if k in have})


# F5 -------------------------------------------------------------------------
def validation_rules(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> list[tuple[str, list]]:
    """(clean column, allowed values) for the columns present, in check order."""
    have = set(df.columns)
    return [(c, vals) for c, vals in spec.validation.items() if c in have]


def validation_predicate(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> Column:
    return _and([R.in_domain(c, vals) for c, vals in validation_rules(df, spec)])


def validate_domain(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """Drop rows with any value outside its closed domain; null is invalid.

    The sequential per-column loop and this single AND keep the same rows; the
    per-rule report (who removed what) is ``profile.invalid_report``.
    """
    return df.filter(_and([R.keep_in(c, vals) for c, vals in validation_rules(df, spec)]))


# E1 / F6 --------------------------------------------------------------------
def is_final_format(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> bool:
    return spec.target is not None and spec.clean_name(spec.target) in df.columns


def clean_survey(df: DataFrame, spec: S.SurveySpec = S.SURVEY, binary_mode: str = "declared",
                 ordinal_filter: bool = True, validate: bool = True) -> DataFrame:
    """The full cleaning chain (E1); a table already in final form is only validated.

    ``binary_mode``: "declared" (spec encodings, one pass) or "inferred" (exact
    data-driven inference, one aggregation job plus one tiny job per column).
    ``ordinal_filter`` / ``validate`` can be switched off to build a deliberately
    uncleaned star for the constraint checks.
    """
    if is_final_format(df, spec):
        return validate_domain(df, spec) if validate else df
    df = drop_any_null(df)
    df = valid_target(df, spec)
    df = binary_inferred(df, spec) if binary_mode == "inferred" else binary_declared(df, spec)
    df = scale_bmi(df, spec)
    if ordinal_filter:
        df = ordinal_domain(df, spec)
    df = recode_sex(df, spec)
    df = rename_clean(df, spec)
    if validate:
        df = validate_domain(df, spec)
    return df


def recoded(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """The recodes of the cleaning chain alone, for rows that pass all its filters."""
    have = set(df.columns)
    if is_final_format(df, spec):
        return df
    cols = {}
    if spec.target and spec.target in have:
        cols[spec.target] = R.recode_target(spec.target, spec.target_labels)
    for c in spec.binaries:
        if c in have:
            mode = spec.binary_encoding[c]
            cols[c] = R.recode_binary(c, mode) if mode is not None else F.col(c).cast("string")
    if spec.bmi_column and spec.bmi_column in have:
        cols[spec.bmi_column] = R.scale_bmi(spec.bmi_column)
    if spec.sex_column and spec.sex_column in have:
        cols[spec.sex_column] = R.recode_sex(spec.sex_column, spec.sex_labels)
    return rename_clean(df.withColumns(cols), spec)


def lenient_recode(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """Raw codes -> final-format labels without filtering anything.

    Unmapped codes become null (pandas ``map`` semantics).  Produces a table in
    final format with bad values left in, the input of the validation-only path.
    """
    cols = {}
    have = set(df.columns)
    if spec.target and spec.target in have:
        cols[spec.target] = R.recode_target(spec.target, spec.target_labels)
    for c in spec.binaries:
        if c in have:
            cols[c] = R.recode_binary_lenient(c, spec.binary_encoding[c])
    if spec.sex_column and spec.sex_column in have:
        cols[spec.sex_column] = R.recode_sex(spec.sex_column, spec.sex_labels)
    if spec.bmi_column and spec.bmi_column in have:
        cols[spec.bmi_column] = R.scale_bmi(spec.bmi_column)
    return rename_clean(df.withColumns(cols), spec)
