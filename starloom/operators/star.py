"""Star schema construction (E2 main layout, E3 alternate layout).

Plan, for a clean table of any size:

* W2: rows keep the order they have in their files (no shuffle at all), or
  that of a unique key column (range-partitioned and sorted); either way a
  position-tagged copy is written once (``operators/numbering.py``), record
  ids are partition or block offsets plus positions, and every later step reads
  the copy, never the source again.
* A1: all dimensions' distinct tuples come from ONE scan (grouping sets, with
  a map-side partial aggregate, so a hot tuple costs nothing extra), each tuple
  keeping the least record id = where it was first seen.
* W1: dense surrogate keys in first-seen order.  Over closed domains the
  dimension size is proven (product of domain sizes), so the few tuples are
  ranked locally (a window over them would be just as safe); otherwise the
  tuples are materialised and numbered with the distributed ``dense_index``.
* J2/J1: the fact fetches each key by an equi-join on the tuple; proven-small
  dimensions are broadcast (map-only, no shuffle of the fact); a dimension
  without a proven bound is counted first (up to the limit) and broadcast only
  if it fits, otherwise joined with a salted shuffle join
  (``operators/skew.py``) so one hot tuple is split over many reducers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import spec as S
from starloom.operators.numbering import dense_index, has_file_order, numbered_rows, small_index
from starloom.operators.skew import fits_broadcast, salted_join
from starloom.session import local_table, reliable_checkpoint

FIRST = "_first_seen"


def _bound(spec: S.SurveySpec | None, dim: S.DimSpec, validated: bool) -> int | None:
    if not validated or spec is None:
        return None
    return S.dimension_bound(spec, dim)


def _number(tuples: DataFrame, dim: S.DimSpec, order_key: str | None,
            bound: int | None) -> DataFrame:
    order = [FIRST] if order_key else dim.sources
    if bound is not None and bound <= S.BROADCAST_ROW_BOUND:
        numbered = small_index(tuples, order, dim.key)
    else:
        numbered = dense_index(tuples, order, dim.key).withColumn(
            dim.key, F.col(dim.key).cast("int"))
    return numbered.select(F.col(dim.key), *[F.col(s).alias(o) for s, o in dim.columns])


def dimension_tuples(df: DataFrame, dim: S.DimSpec, order_key: str | None) -> DataFrame:
    """Distinct tuples of one dimension (+ first-seen key), materialised.

    A grouped aggregate with a map-side partial step, so a hot tuple is
    combined before the shuffle.
    """
    aggs = [F.min(order_key).alias(FIRST)] if order_key else [F.count(F.lit(1)).alias("_n")]
    return reliable_checkpoint(df.groupBy(*dim.sources).agg(*aggs), "dim-tuples")


def build_dimension(df: DataFrame, dim: S.DimSpec, order_key: str | None = None,
                    bound: int | None = None) -> DataFrame:
    """One dimension: distinct tuples with dense ids (first-seen or value order)."""
    return _number(dimension_tuples(df, dim, order_key), dim, order_key, bound)


def lookup_key(fact: DataFrame, dim_df: DataFrame, dim: S.DimSpec, bound: int | None,
               null_safe: bool = True, strict: bool = True) -> DataFrame:
    """Add ``dim.key`` to ``fact`` by matching the dimension tuple (left join).

    ``strict``: a tuple absent from the dimension fails the job (dictionary
    lookup semantics) instead of leaving a null key.
    """
    alias = {o: f"_d_{i}" for i, o in enumerate(dim.outputs)}
    d = dim_df.select(F.col(dim.key).alias("_k"), *[F.col(o).alias(a) for o, a in alias.items()])
    small = (bound is not None and bound <= S.BROADCAST_ROW_BOUND) or \
        (bound is None and fits_broadcast(d))
    if small:
        d = F.broadcast(d)
        conds = [(fact[s].eqNullSafe(d[alias[o]]) if null_safe else fact[s] == d[alias[o]])
                 for s, o in dim.columns]
        joined = fact.join(d, reduce(lambda a, b: a & b, conds), "left")
    else:
        # too large to broadcast: shuffle join, salted so a hot tuple is split
        joined = salted_join(fact, d, [(s, alias[o]) for s, o in dim.columns], "left", null_safe)
    key = F.col("_k")
    if strict:
        key = F.when(key.isNull(), F.raise_error(
            F.lit(f"tuple missing from {dim.table}"))).otherwise(key)
    return joined.withColumn(dim.key, key.cast("int")).drop("_k", *alias.values())


def _local_dimension(spark, rows, dim: S.DimSpec, gid: int, schema) -> DataFrame:
    """Dense keys in first-seen order over a dimension's (few) tuple rows."""
    from pyspark.sql.types import IntegerType, StructField, StructType

    mine = sorted((r for r in rows if r["_gid"] == gid),
                  key=lambda r: (r[FIRST] is not None, r[FIRST]))      # nulls first
    fields = [StructField(dim.key, IntegerType(), False)] + [
        StructField(o, schema[s].dataType, True) for s, o in dim.columns]
    data = [tuple([i] + [r[s] for s in dim.sources]) for i, r in enumerate(mine, start=1)]
    return local_table(spark, data, StructType(fields))


def resolve_order(df: DataFrame, order_key: str | None = None) -> str | None:
    """The key column rows are numbered by; None: the order of their files (decision D7)."""
    if order_key is not None:
        return order_key
    if "row_key" in df.columns:
        return "row_key"
    if has_file_order(df):
        return None
    raise ValueError("rows have no order: give a key column or scan with file_order=True")


def star_grouping(rows: DataFrame, layout: S.StarLayout) -> tuple[DataFrame, list[str]]:
    """The single pass over the numbered table: every dimension's tuples with
    the record that shows them first, as grouping sets.  The minimum of a number
    is a hash aggregate with a map-side partial step."""
    group_cols: list[str] = []
    for d in layout.dims:
        group_cols += [c for c in d.sources if c not in group_cols]
    sets = [[F.col(c) for c in d.sources] for d in layout.dims]
    grouped = (rows.groupingSets(sets, *[F.col(c) for c in group_cols])
                   .agg(F.min(layout.record_key).alias(FIRST), F.grouping_id().alias("_gid")))
    return grouped, group_cols


def build_star(clean: DataFrame, layout: S.StarLayout = S.MAIN_STAR,
               spec: S.SurveySpec | None = S.SURVEY, order_key: str | None = None,
               validated: bool = True, num_partitions: int | None = None) -> dict[str, DataFrame]:
    """Dimensions (first-seen dense keys) and fact (record ids in row order).

    ``order_key``: a column with a unique value per row; by default
    ``row_key``, or the file order of a scan that carries it.  ``validated`` says
    the input passed domain validation, which proves every dimension's size
    bound; pass False for an arbitrary table.

    Passes over the data: the one that writes the tagged copy, a count per
    block over its tags, one grouping-sets pass that yields every dimension's
    tuples, and the fact pass.  When all dimensions are proven small, their
    tuples (and nothing else) are ranked locally; otherwise they are written to
    the checkpoint folder and ranked with distributed numbering.
    """
    spark = clean.sparkSession
    fact = numbered_rows(clean, layout.record_key, resolve_order(clean, order_key), num_partitions)
    dims_spec = list(layout.dims)
    grouped, group_cols = star_grouping(fact, layout)
    bounds = [_bound(spec, d, validated) for d in dims_spec]
    small = all(b is not None and b <= S.BROADCAST_ROW_BOUND for b in bounds)

    def gid(members: list[str]) -> int:
        width = len(group_cols)
        return sum(1 << (width - 1 - i) for i, c in enumerate(group_cols) if c not in members)

    dims = {}
    if small:
        rows = grouped.collect()  # at most 1,348 tuples
        dims = {d.table: _local_dimension(spark, rows, d, gid(d.sources), clean.schema)
                for d in dims_spec}
    else:
        grouped = reliable_checkpoint(grouped, "dim-tuples")
        for d, b in zip(dims_spec, bounds):
            tuples = grouped.filter(F.col("_gid") == gid(d.sources)).select(*d.sources, FIRST)
            dims[d.table] = _number(tuples, d, FIRST, b)
    for d, b in zip(dims_spec, bounds):
        fact = lookup_key(fact, dims[d.table], d, b, layout.null_safe_lookup, layout.strict_lookup)
    measures = []
    for src, out, cast in layout.measures:
        c = F.col(src)
        measures.append((c.cast(cast) if cast else c).alias(out))
    fact = fact.select(F.col(layout.record_key), *measures, *[F.col(d.key) for d in layout.dims])
    return {**dims, layout.fact_table: fact}


def build_one_dimension(clean: DataFrame, dim: S.DimSpec, spec: S.SurveySpec = S.SURVEY,
                        order_key: str = "row_key") -> DataFrame:
    """One dimension of a validated table with a key column: a single map-side aggregate,
    without the tagged copy that only the fact's record ids need."""
    return build_dimension(clean, dim, order_key, _bound(spec, dim, True))


def star_round_trip(star: dict[str, DataFrame], layout: S.StarLayout = S.MAIN_STAR) -> DataFrame:
    """Fact joined back to its dimensions, columns under their clean names."""
    fact = star[layout.fact_table]
    for d in layout.dims:
        dim = star[d.table].select(F.col(d.key), *[F.col(o).alias(s) for s, o in d.columns])
        if fits_broadcast(dim):
            fact = fact.join(F.broadcast(dim), d.key, "left")
        else:
            key = f"_r_{d.key}"
            fact = salted_join(fact, dim.withColumnRenamed(d.key, key), [(d.key, key)], "left").drop(key)
    return fact
