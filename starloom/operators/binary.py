"""Exact binary-encoding inference (F3 inferred mode, decision D1).

The binary step visits its columns in order; for each it looks at the distinct
values still present (after the earlier columns' filters) and picks a mode:

* values within {0,1}          -> "01"
* else values within {1,2}     -> "12"
* else {0,1} among the values  -> "01" (rows with other codes dropped)
* else {1,2} among the values  -> "12"
* else                         -> None (no pattern; column and rows untouched)

Because each choice filters rows and so changes what later columns see, the
answer depends on the joint distribution.  We compute it exactly without
pulling rows to the driver: every column is mapped to a 5-state code (null, 0,
1, 2, other) and the distinct code tuples are aggregated with a map-side
combine.  That table is bounded by 5^k tuples and in practice tiny; it is
materialised and size-checked: when small it is decided locally in one pass,
otherwise the k sequential decisions each run a one-row aggregate over it (only
k single rows of four booleans reach the driver).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.skew import fits_broadcast
from starloom.session import reliable_checkpoint

OTHER = 3


def _code(c: str):
    x = F.col(c)
    return (F.when(x.isNull(), F.lit(None).cast("tinyint"))
             .when(x == 0, F.lit(0).cast("tinyint"))
             .when(x == 1, F.lit(1).cast("tinyint"))
             .when(x == 2, F.lit(2).cast("tinyint"))
             .otherwise(F.lit(OTHER).cast("tinyint")))


def resolve_mode(has0: bool, has1: bool, has2: bool, has_other: bool) -> str | None:
    """Mode for one column from the set of (non-null) values present."""
    if not has2 and not has_other:
        return "01"
    if not has0 and not has_other:
        return "12"
    if has0 and has1:
        return "01"
    if has1 and has2:
        return "12"
    return None


def _resolve_local(rows, columns: list[str]) -> dict:
    """The sequential decisions over the (small) collected code-tuple rows."""
    modes: dict = {}
    alive = list(rows)
    for c in columns:
        present = {r[c] for r in alive if r[c] is not None}
        mode = resolve_mode(0 in present, 1 in present, 2 in present, OTHER in present)
        modes[c] = mode
        if mode is not None:
            keep = {0, 1} if mode == "01" else {1, 2}
            alive = [r for r in alive if r[c] in keep]
    return modes


def infer_binary_modes(df: DataFrame, columns: list[str]) -> dict:
    if not columns:
        return {}
    tuples = (df.select([_code(c).alias(c) for c in columns])
                .groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")))
    tuples = reliable_checkpoint(tuples, "binary-codes")
    if fits_broadcast(tuples):
        # size-checked: few distinct code tuples, decide in one pass locally
        return _resolve_local(tuples.collect(), columns)
    modes: dict = {}
    alive = F.lit(True)
    for c in columns:
        x = F.col(c)
        row = tuples.filter(alive).agg(
            F.coalesce(F.max(x == 0), F.lit(False)).alias("h0"),
            F.coalesce(F.max(x == 1), F.lit(False)).alias("h1"),
            F.coalesce(F.max(x == 2), F.lit(False)).alias("h2"),
            F.coalesce(F.max(x == OTHER), F.lit(False)).alias("ho"),
        ).first()
        mode = resolve_mode(row["h0"], row["h1"], row["h2"], row["ho"])
        modes[c] = mode
        if mode is not None:
            codes = [0, 1] if mode == "01" else [1, 2]
            alive = alive & F.coalesce(x.isin(codes), F.lit(False))
    return modes
