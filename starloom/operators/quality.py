"""Constraint checks re-aimed from DDL.

Every check returns violations as rows
``(constraint, table_name, column_name, row_key, value)``; an empty result
means the constraint holds.  Row-local checks of one table (NOT NULL, CHECK
ranges, fits-the-type) run in ONE scan: each row yields an array of optional
violation structs that is filtered and exploded.  Uniqueness is a grouped
count (one shuffle of the key column only), or for generated ids a proof by
runs that shuffles none; foreign keys are anti-joins.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom import spec as S
from starloom.functions import recode as R
from starloom.operators.skew import fits_broadcast, salted_join
from starloom.session import reliable_checkpoint

VIOLATION_SCHEMA = ("constraint string, table_name string, column_name string, "
                    "row_key bigint, value string")


def _violation(constraint: str, column: str, value: Column) -> Column:
    return F.struct(F.lit(constraint).alias("constraint"), F.lit(column).alias("column_name"),
                    value.cast("string").alias("value"))


def _fits_type(c: str, sql_type: str) -> Column | None:
    """Condition that the non-null value does NOT fit ``sql_type`` (strict mode)."""
    m = re.fullmatch(r"varchar\((\d+)\)", sql_type)
    if m:
        return F.length(F.col(c).cast("string")) > int(m.group(1))
    if sql_type.startswith("decimal") or sql_type in ("int", "bigint"):
        return F.col(c).isNotNull() & F.col(c).try_cast(sql_type).isNull()
    return None


def _range_violation(c: str, lo, lo_inc: bool, hi, hi_inc: bool) -> Column:
    x = F.col(c)
    ok = (x >= lo if lo_inc else x > lo) & (x <= hi if hi_inc else x < hi)
    return x.isNotNull() & ~ok        # a null passes a CHECK


def named_row_checks(df: DataFrame, types: dict[str, str] | None = None, ranges: dict | None = None,
                     status_column: str | None = None) -> dict[tuple[str, str], Column]:
    """K1 not-null, K4 ranges and K5 fits-type: (constraint, column) -> optional violation."""
    checks: dict[tuple[str, str], Column] = {}
    have = df.columns

    def add(constraint: str, c: str, bad: Column) -> None:
        checks[constraint, c] = F.when(bad, _violation(constraint, c, F.col(c)))

    for c in have:
        add("not_null", c, F.col(c).isNull())
        fit = _fits_type(c, (types or {}).get(c, "")) if types else None
        if fit is not None:
            add("fits_type", c, fit)
    for c, (lo, lo_inc, hi, hi_inc) in (ranges or {}).items():
        if c in have:
            add("check_range", c, _range_violation(c, lo, lo_inc, hi, hi_inc))
    if status_column and status_column in have:
        code = R.encode_status(status_column)
        add("check_range", status_column, code.isNotNull() & ~code.isin(S.STATUS_CHECK_VALUES))
    return checks


def row_check_columns(df: DataFrame, types: dict[str, str] | None = None,
                      ranges: dict | None = None,
                      status_column: str | None = None) -> list[Column]:
    """K1 not-null, K4 ranges and K5 fits-type: one optional violation per check."""
    return list(named_row_checks(df, types, ranges, status_column).values())


def _violations(df: DataFrame, table: str, key: str, checks: list[Column]) -> DataFrame:
    """The non-null violations of each row, one output row each."""
    found = F.filter(F.array(*checks), lambda v: v.isNotNull())
    return (df.select(F.col(key).cast("long").alias("row_key"), F.explode(found).alias("v"))
              .select(F.col("v.constraint"), F.lit(table).alias("table_name"),
                      F.col("v.column_name"), "row_key", F.col("v.value")))


def row_checks(df: DataFrame, table: str, key: str, types: dict[str, str] | None = None,
               ranges: dict | None = None, status_column: str | None = None) -> DataFrame:
    """K1 not-null, K4 ranges and K5 fits-type for one table, in one pass."""
    return _violations(df, table, key, row_check_columns(df, types, ranges, status_column))


def unique_key(df: DataFrame, table: str, key: str) -> DataFrame:
    """K2: key values that occur more than once (value = occurrences)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
              .select(F.lit("unique_key").alias("constraint"), F.lit(table).alias("table_name"),
                      F.lit(key).alias("column_name"), F.col(key).cast("long").alias("row_key"),
                      F.col("_n").cast("string").alias("value")))


#: Runs of ids beyond which ``unique_in_runs`` gives up (generated ids have one per piece of a file block).
MOST_RUNS = 2_000_000


def id_runs(df: DataFrame, key: str) -> DataFrame:
    """(lo, hi, n): runs of consecutive ids in the rows of a task.

    Rows of a task are numbered as they come; ids that keep their distance from that
    number are distinct, so a run holds no id twice.  Grouped in the
    task, a run leaves it as one row: no id is shuffled.
    """
    placed = df.select(F.col(key).cast("long").alias("k"), F.spark_partition_id().alias("p"),
                       F.monotonically_increasing_id().alias("m"))
    return (placed.where("k IS NOT NULL").groupBy("p", (F.col("k") - F.col("m")).alias("d"))
            .agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count(F.lit(1)).alias("n")).select("lo", "hi", "n"))


def unique_in_runs(df: DataFrame, key: str) -> bool:
    """K2 for generated ids: True if runs of ids prove that none occurs twice.

    Inside a run ids are distinct; two runs share none if their intervals do
    not overlap.  False proves nothing (foreign ids, or an interleaved order):
    ``unique_key`` then decides by a grouped count.
    """
    runs = reliable_checkpoint(id_runs(df, key), "id-runs")
    if runs.count() > MOST_RUNS:
        return False
    before = Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    return runs.select("lo", F.max("hi").over(before).alias("b")).where("b >= lo").isEmpty()


def foreign_key(fact: DataFrame, fact_table: str, fact_key: str, fk: str, dim: DataFrame,
                dim_key: str, dim_bounded: bool | None = None) -> DataFrame:
    """Non-null foreign keys with no matching dimension row.

    The dimension's keys are broadcast when their size is proven
    (``dim_bounded``) or checked; otherwise the anti-join is salted.
    """
    keys = dim.select(F.col(dim_key).alias("_k")).distinct()
    live = fact.filter(F.col(fk).isNotNull())
    if dim_bounded is None:
        dim_bounded = fits_broadcast(keys)
    if dim_bounded:
        orphans = live.join(F.broadcast(keys), F.col(fk) == F.col("_k"), "left_anti")
    else:
        # a hot foreign key would land in one reducer: salt the fact side
        orphans = salted_join(live, keys, [(fk, "_k")], "left_anti")
    return orphans.select(F.lit("foreign_key").alias("constraint"),
                          F.lit(fact_table).alias("table_name"), F.lit(fk).alias("column_name"),
                          F.col(fact_key).cast("long").alias("row_key"),
                          F.col(fk).cast("string").alias("value"))


def _key_sets(refs: list[tuple[str, DataFrame, str]],
              dims_bounded: bool | None) -> tuple[list[DataFrame], bool]:
    """Distinct keys of each referenced dimension, and whether all can be broadcast."""
    keysets = [dim.select(F.col(dim_key).alias(f"_k{i}")).distinct()
               for i, (_, dim, dim_key) in enumerate(refs)]
    bounded = dims_bounded if dims_bounded is not None else \
        all(fits_broadcast(k) for k in keysets)
    return keysets, bounded


def _probe_keys(fact: DataFrame, refs: list[tuple[str, DataFrame, str]],
                keysets: list[DataFrame]) -> tuple[DataFrame, list[Column]]:
    """Broadcast left join per key set (keys are distinct, so no row repeats)
    and the optional orphan violation of each foreign key."""
    probed = fact
    for i, ((fk, _, _), keys) in enumerate(zip(refs, keysets)):
        probed = probed.join(F.broadcast(keys.withColumn(f"_m{i}", F.lit(True))),
                             F.col(fk) == F.col(f"_k{i}"), "left")
    checks = [F.when(F.col(fk).isNotNull() & F.col(f"_m{i}").isNull(),
                     _violation("foreign_key", fk, F.col(fk)))
              for i, (fk, _, _) in enumerate(refs)]
    return probed, checks


def probed_foreign_keys(fact: DataFrame, refs: list[tuple[str, DataFrame, str]]) \
        -> tuple[DataFrame, dict[tuple[str, str], Column], list[tuple[str, DataFrame, str]]]:
    """(fact with each key probed, the checks, keys left out): K3 as part of another pass over the fact.

    Only dimensions whose keys are checked to be small are probed; the others
    are left to ``foreign_keys``.
    """
    sets = [(ref, ref[1].select(ref[2]).distinct()) for ref in refs]
    small = [ref for ref, keys in sets if fits_broadcast(keys)]
    keysets = [dim.select(F.col(k).alias(f"_k{i}")).distinct() for i, (_, dim, k) in enumerate(small)]
    probed, checks = _probe_keys(fact, small, keysets)
    return probed, {("foreign_key", fk): c for (fk, _, _), c in zip(small, checks)}, \
        [ref for ref in refs if ref not in small]


def foreign_keys(fact: DataFrame, fact_table: str, fact_key: str,
                 refs: list[tuple[str, DataFrame, str]],
                 dims_bounded: bool | None = None) -> DataFrame:
    """K3 / J4 for several foreign keys ``(fk, dim, dim_key)`` of one fact.

    When every referenced key set is broadcastable (proven by
    ``dims_bounded`` or checked), all keys are probed in ONE scan of the fact
    (see ``_probe_keys``).  Otherwise each key gets its own salted anti-join.
    """
    if not refs:
        return fact.sparkSession.createDataFrame([], VIOLATION_SCHEMA)
    keysets, bounded = _key_sets(refs, dims_bounded)
    if not bounded:
        return reduce(DataFrame.unionByName, [
            foreign_key(fact, fact_table, fact_key, fk, dim, dim_key, False)
            for fk, dim, dim_key in refs])
    probed, checks = _probe_keys(fact.select(fact_key, *[fk for fk, _, _ in refs]),
                                 refs, keysets)
    return _violations(probed, fact_table, fact_key, checks)


def check_star(star: dict[str, DataFrame], layout: S.StarLayout = S.MAIN_STAR,
               types: dict | None = None, dims_bounded: bool | None = None,
               uniqueness: bool = True) -> DataFrame:
    """All constraints of the stored star: K1, K2, K3, K4, K5."""
    types = S.LOAD_TYPES if types is None else types
    parts = []
    for d in layout.dims:
        t = star[d.table]
        parts.append(row_checks(t, d.table, d.key, types.get(d.table)))
        if uniqueness:
            parts.append(unique_key(t, d.table, d.key))
    fact, ft, rk = star[layout.fact_table], layout.fact_table, layout.record_key
    fact_checks = row_check_columns(fact, types.get(ft), S.RANGE_CHECKS, "diabetes_status")
    refs = [(d.key, star[d.table], d.key) for d in layout.dims]
    keysets, bounded = _key_sets(refs, dims_bounded)
    if bounded:
        # row checks and every foreign key in one scan of the fact
        probed, fk_checks = _probe_keys(fact, refs, keysets)
        parts.append(_violations(probed, ft, rk, fact_checks + fk_checks))
    else:
        parts.append(_violations(fact, ft, rk, fact_checks))
        parts.append(foreign_keys(fact, ft, rk, refs, False))
    if uniqueness:
        parts.append(unique_key(fact, ft, rk))
    return reduce(DataFrame.unionByName, parts)


# K6 -------------------------------------------------------------------------
def with_created_at(df: DataFrame, column: str = "created_at") -> DataFrame:
    """Load timestamp default: one value per query (``current_timestamp``)."""
    return df.withColumn(column, F.current_timestamp())


def created_at_report(tables: dict[str, DataFrame], column: str = "created_at") -> DataFrame:
    """K6 over loaded tables: rows, rows without a load stamp, distinct stamps.

    ``current_timestamp`` is fixed per query, so a table written by one load
    carries exactly one stamp; more than one means rows from several loads.
    The distinct count is a partial aggregate (one stamp per task at most).
    """
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
               F.count_if(F.col(column).isNull()).alias("unstamped_rows"),
               F.count_distinct(F.col(column)).alias("load_stamps"))
        for name, df in tables.items()])
