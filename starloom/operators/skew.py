"""Salted equi-joins for joins whose smaller side has no proven size bound.

When the small side cannot be broadcast, the join shuffles both sides on the
key, and one hot key (say a third of all fact rows on one dimension tuple)
lands in a single reducer.  Salting splits it: every big-side row gets a
salt in [0, S) from its position in its partition, and the small side
is replicated once per salt, so a hot key's rows spread over S reducers while
each still meets every matching small-side row exactly once.  Results are the
same as the plain join; only the small side is shuffled S times.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_SALTS = 32
SALT = "_salt"
# Rows and bytes up to which a side without a proven bound may be broadcast
# (or collected), once measured.
CHECKED_BROADCAST_ROWS = 200_000
CHECKED_BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame):
    """Bytes of a row: fixed width of each field (plus its 8-byte slot) and the
    actual length of every string / binary value."""
    from pyspark.sql import types as T

    widths = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4,
              T.FloatType: 4, T.DateType: 4, T.LongType: 8, T.DoubleType: 8,
              T.TimestampType: 8, T.TimestampNTZType: 8}
    fixed, var = 0, []
    for f in df.schema.fields:
        fixed += 8
        t = f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            var.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        elif isinstance(t, T.DecimalType):
            fixed += 8 if t.precision <= 18 else 16
        else:
            fixed += widths.get(type(t), 16)
    return reduce(lambda a, b: a + b, var, F.lit(fixed).cast("long"))


def fits_broadcast(df: DataFrame, max_rows: int = CHECKED_BROADCAST_ROWS,
                   max_bytes: int = CHECKED_BROADCAST_BYTES) -> bool:
    """Size check before a broadcast: one job over at most ``max_rows + 1`` rows
    that measures both the row count and the bytes."""
    r = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"),
                                   F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()
    return r["n"] <= max_rows and r["b"] <= max_bytes


def salt_big(df: DataFrame, salts: int) -> DataFrame:
    """A salt per row from its position in its partition, so equal rows spread as well."""
    return df.withColumn(SALT, F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))


def replicate_small(df: DataFrame, salts: int) -> DataFrame:
    return df.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salted_join(big: DataFrame, small: DataFrame, pairs: list[tuple[str, str]], how: str,
                null_safe: bool = False, salts: int = DEFAULT_SALTS) -> DataFrame:
    """``big JOIN small ON big.a = small.b ...`` with the hot-key work split S ways.

    ``pairs``: (big column, small column); names must not collide.  ``how``:
    inner, left or left_anti (joins where each big row's result depends only on
    its own matches).
    """
    b = salt_big(big, salts)
    s = replicate_small(small, salts).withColumnRenamed(SALT, "_salt_r")
    conds = [(b[x].eqNullSafe(s[y]) if null_safe else b[x] == s[y]) for x, y in pairs]
    conds.append(b[SALT] == s["_salt_r"])
    out = b.join(s, reduce(lambda p, q: p & q, conds), how)
    return out.drop(SALT, "_salt_r")
