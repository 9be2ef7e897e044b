"""Reports: class distribution, value profiles, step deltas, invalid values.

Each report is one aggregation job whose output is small and bounded by a
closed domain (classes, rules, steps) or is itself a distributed grouping
(value profiles).  Nothing collects an unbounded group: distinct invalid
values come back as rows of a ``groupBy``, not as one collected set.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from starloom import spec as S
from starloom.functions import recode as R
from starloom.operators import clean as C
from starloom.operators.binary import infer_binary_modes
from starloom.session import local_table


# A2 -------------------------------------------------------------------------
def class_distribution(df: DataFrame, column: str = "diabetes_status") -> DataFrame:
    """Count per label with ``n / total * 100`` percent, largest first.

    The total comes from a window over the aggregated result, whose size is
    the number of labels (a closed domain), never over the raw rows.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    total = F.sum("n_records").over(Window.partitionBy())
    return (counts.withColumn("percent", F.col("n_records") / total * F.lit(100.0))
                  .orderBy(F.desc("n_records"), F.asc_nulls_first(column)))


# A3 -------------------------------------------------------------------------
def value_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, value, n) for every distinct non-null value of every column.

    One unpivot + one grouped count: the map-side partial aggregate reduces
    each partition to its distinct (column, value) pairs before the shuffle,
    so a hot value costs nothing extra.  Values share one type: double when all
    columns are numeric, otherwise text.
    """
    columns = [c for c in (columns or df.columns)]
    numeric = all(t in ("double", "float", "int", "bigint", "smallint", "tinyint")
                  or t.startswith("decimal") for c, t in df.select(*columns).dtypes)
    vtype = "double" if numeric else "string"
    long = df.select([F.col(c).cast(vtype).alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value")
    return (long.filter(F.col("value").isNotNull())
                .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))


def inferred_spec(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> S.SurveySpec:
    """``spec`` with the binary encodings that an inferred run finds in ``df``.

    Pass it to the step reports to see what such a run really filtered.
    """
    ready = C.valid_target(C.drop_any_null(df), spec)
    modes = infer_binary_modes(ready, [c for c in spec.binaries if c in set(df.columns)])
    return replace(spec, binary_encoding={**spec.binary_encoding, **modes})


# A4 -------------------------------------------------------------------------
def cleaning_steps(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> list[tuple[str, Column]]:
    """(step name, predicate on raw columns) in the order the cleaning applies them."""
    steps = [("drop_any_null", C.not_null_predicate(df))]
    have = set(df.columns)
    if spec.target and spec.target in have:
        steps.append(("valid_target", C.target_predicate(spec)))
    for c in spec.binaries:
        if c in have:
            steps.append((f"binary:{c}", C.binary_predicate(c, spec.binary_encoding[c])))
    for c, dom in spec.ordinals.items():
        if c in have:
            steps.append((f"ordinal:{c}", R.in_domain(c, dom)))
    return steps


def _all_steps(df: DataFrame, spec: S.SurveySpec) -> list[tuple[str, Column]]:
    steps = cleaning_steps(df, spec)
    rules = [R.sql_in_domain(_recoded_sql(c, spec), vals)
             for c, vals in _validation_on_raw(df, spec)]
    steps.append(("validate", F.expr(" AND ".join(rules)) if rules else F.lit(True)))
    return steps


def removing_step(df: DataFrame, spec: S.SurveySpec = S.SURVEY,
                  steps: list[tuple[str, Column]] | None = None) -> Column:
    """Index of the first cleaning step that removes the row (null: it survives)."""
    steps = steps if steps is not None else _all_steps(df, spec)
    return F.coalesce(*[F.when(~pred, F.lit(i)) for i, (_, pred) in enumerate(steps, start=1)],
                      F.lit(None).cast("int"))


def step_deltas(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """Rows before / after / removed for every cleaning step, in one pass.

    Each row is charged to the FIRST step that removes it (a CASE over the
    step predicates, linear in the number of steps); one aggregate then counts
    rows per step, and the before/after columns are running sums over that
    single result row.  The last step, validation, is evaluated on the
    recoded values.
    """
    steps = _all_steps(df, spec)
    tagged = df.select(removing_step(df, spec, steps).alias("_step"))
    counts = tagged.agg(F.count(F.lit(1)).alias("total"),
                        *[F.count_if(F.col("_step") == i).alias(f"r{i}")
                          for i in range(1, len(steps) + 1)])
    rows, removed_before = [], F.lit(0).cast("long")
    for i, (name, _) in enumerate(steps, start=1):
        before = F.col("total") - removed_before
        after = before - F.col(f"r{i}")
        rows.append(F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"),
                             before.alias("rows_before"), after.alias("rows_after"),
                             F.col(f"r{i}").alias("removed")))
        removed_before = removed_before + F.col(f"r{i}")
    return counts.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def stage_with_deltas(df: DataFrame, path: str, spec: S.SurveySpec = S.SURVEY) -> tuple[DataFrame, DataFrame]:
    """The clean stage written to ``path``, and its ``step_deltas`` counted during that write.

    Each row is charged to the first step that removes it while it passes
    (``observe``); those that no step removes are recoded and written.  No
    scan is made for the report.  For an inferred run pass ``inferred_spec``.
    """
    steps = _all_steps(df, spec)
    seen = Observation("steps")
    at = "_step"
    tagged = df.withColumn(at, removing_step(df, spec, steps)).observe(
        seen, F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(at) == i).alias(f"r{i}") for i in range(1, len(steps) + 1)])
    clean = C.recoded(tagged.where(F.col(at).isNull()).drop(at), spec)
    clean.write.mode("overwrite").parquet(path)
    rows, before = [], seen.get["total"]
    for i, (name, _) in enumerate(steps, start=1):
        removed = seen.get[f"r{i}"]
        rows.append((i, name, before, before - removed, removed))
        before -= removed
    schema = "step_no int, step string, rows_before long, rows_after long, removed long"
    spark = df.sparkSession
    return spark.read.schema(clean.schema).parquet(path), local_table(spark, rows, schema)


def value_profile_by_step(df: DataFrame, spec: S.SurveySpec = S.SURVEY,
                          columns: list[str] | None = None) -> DataFrame:
    """(column_name, value, removed_at_step, n): each raw value's count, split by
    the cleaning step that removes its row (null = the row survives).

    The distinct values present after step k are those with a row whose
    ``removed_at_step`` is null or greater than k, so every before/after view
    of every step comes from this one table, built in one scan with a map-side
    partial aggregate.
    """
    have = set(df.columns)
    columns = [c for c in (columns or spec.selected) if c in have]
    tagged = df.select(removing_step(df, spec).alias("removed_at_step"),
                       *[F.col(c).cast("double").alias(c) for c in columns])
    long = tagged.unpivot(["removed_at_step"], columns, "column_name", "value")
    return (long.filter(F.col("value").isNotNull())
                .groupBy("column_name", "value", "removed_at_step")
                .agg(F.count(F.lit(1)).alias("n")))


def _validation_on_raw(df: DataFrame, spec: S.SurveySpec) -> list[tuple[str, list]]:
    """Validation rules mapped back to the raw columns they are computed from."""
    back = {v: k for k, v in spec.rename.items()}
    have = set(df.columns)
    return [(back.get(c, c), vals) for c, vals in spec.validation.items()
            if back.get(c, c) in have]


def _recoded_sql(raw_col: str, spec: S.SurveySpec) -> str:
    """The clean value of a raw column, as the cleaning chain would compute it (SQL)."""
    q = R.quote(raw_col)
    if raw_col == spec.target:
        return R.sql_case(q, spec.target_labels)
    if raw_col in spec.binaries and spec.binary_encoding[raw_col] is None:
        return f"CAST({q} AS STRING)"     # no binary pattern: the value stays, as text
    if raw_col in spec.binaries:
        return R.recode_binary_lenient_sql(q, spec.binary_encoding[raw_col])
    if raw_col == spec.sex_column:
        return R.sql_case(q, spec.sex_labels)
    if raw_col == spec.bmi_column:
        return f"({q} / {R.sql_literal(S.BMI_SCALE)})"
    return q


# A5 -------------------------------------------------------------------------
def _first_failure(df: DataFrame, spec: S.SurveySpec):
    rules = C.validation_rules(df, spec)
    first = F.coalesce(*[F.when(R.not_in_domain(c, vals), F.lit(i))
                         for i, (c, vals) in enumerate(rules, start=1)], F.lit(None).cast("int"))
    name = R.lookup("rule_no", {i: c for i, (c, _) in enumerate(rules, start=1)})
    offending = F.expr("CASE " + " ".join(
        f"WHEN rule_no = {i} THEN CAST({R.quote(c)} AS STRING)"
        for i, (c, _) in enumerate(rules, start=1)) + " END") if rules else None
    return rules, first, name, offending


def invalid_report(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """Per validation rule: rows it removes, how many were null, distinct bad values.

    A row is charged to the FIRST rule it breaks, which gives exactly the
    counts of checking column by column and dropping as you go, in one pass.
    """
    rules, first, name, offending = _first_failure(df, spec)
    if not rules:
        return df.sparkSession.createDataFrame(
            [], "rule_no int, column_name string, invalid_rows bigint, null_rows bigint, "
                "distinct_invalid bigint")
    charged = df.select(first.alias("rule_no"), *[F.col(c) for c, _ in rules]) \
        .filter(F.col("rule_no").isNotNull()) \
        .select("rule_no", offending.alias("_bad"))
    return (charged.groupBy("rule_no")
                   .agg(F.count(F.lit(1)).alias("invalid_rows"),
                        F.count_if(F.col("_bad").isNull()).alias("null_rows"),
                        F.countDistinct("_bad").alias("distinct_invalid"))
                   .withColumn("column_name", name)
                   .select("rule_no", "column_name", "invalid_rows", "null_rows",
                           "distinct_invalid"))


def invalid_values(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """(rule_no, column_name, value, n): each distinct offending value of each rule."""
    rules, first, name, offending = _first_failure(df, spec)
    charged = df.select(first.alias("rule_no"), *[F.col(c) for c, _ in rules]) \
        .filter(F.col("rule_no").isNotNull()) \
        .select("rule_no", offending.alias("value"))
    return (charged.groupBy("rule_no", "value").agg(F.count(F.lit(1)).alias("n"))
                   .withColumn("column_name", name)
                   .select("rule_no", "column_name", "value", "n"))


# A8 -------------------------------------------------------------------------
def years_included(df: DataFrame, year_col: str = S.YEAR_COLUMN) -> DataFrame:
    """Rows per year, plus the total (``is_total``), from one rollup aggregate."""
    return (df.rollup(year_col)
              .agg(F.count(F.lit(1)).alias("n_records"),
                   (F.grouping(year_col) == 1).alias("is_total"))
              .orderBy("is_total", year_col))


# A9 -------------------------------------------------------------------------
def unmapped_count(df: DataFrame, column: str = "Sex") -> DataFrame:
    """Rows whose recoded value is null (unmapped codes), with the total."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("unmapped_rows"),
                  F.count(F.lit(1)).alias("total_rows"))


# A10 ------------------------------------------------------------------------
def run_summary(raw: DataFrame, clean: DataFrame, tables: dict[str, DataFrame] | None = None,
                target: str = "diabetes_status") -> DataFrame:
    """(metric, item, value) rows: raw/clean/removed rows, classes, table rows."""
    classes = clean.groupBy(F.col(target).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    counted = [raw.agg(F.lit("raw_rows").alias("metric"), F.lit("").alias("item"),
                       F.count(F.lit(1)).alias("value")),
               classes.select(F.lit("class_count").alias("metric"), "item", F.col("n").alias("value"))]
    for name, t in (tables or {}).items():
        counted.append(t.agg(F.lit("table_rows").alias("metric"), F.lit(name).alias("item"),
                             F.count(F.lit(1)).alias("value")))
    # one row per class and table: the totals are sums over these few rows, so
    # the raw and the clean table are each scanned once
    out = reduce(DataFrame.unionByName, counted).withColumn(
        "each", F.when(F.col("metric") == "raw_rows", F.array(F.lit("raw_rows"), F.lit("rows_removed")))
        .when(F.col("metric") == "class_count", F.array(F.lit("class_count"), F.lit("clean_rows"), F.lit("rows_removed")))
        .otherwise(F.array("metric"))).withColumn("of", F.explode("each"))
    sign = F.when((F.col("of") == "rows_removed") & (F.col("metric") == "class_count"), -F.col("value")) \
        .otherwise(F.col("value"))
    item = F.when(F.col("of").isin("clean_rows", "rows_removed"), "").otherwise(F.col("item"))
    out = out.groupBy(F.col("of").alias("metric"), item.alias("item")).agg(F.sum(sign).cast("long").alias("value"))
    # an empty clean table has no class row, and still 0 clean rows
    none = raw.sparkSession.sql("SELECT 'clean_rows' AS metric, '' AS item, CAST(0 AS BIGINT) AS value")
    return out.unionByName(none).groupBy("metric", "item").agg(F.sum("value").alias("value"))


# X2 -------------------------------------------------------------------------
def encoded_columns(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> dict[str, Column]:
    """Every clean column as a number: status and flag codes, Male 0 / Female 1, numbers as they are."""
    sexes = list(spec.sex_labels.values())
    sex = spec.clean_name(spec.sex_column) if spec.sex_column else None
    flags = {spec.clean_name(c) for c in spec.binaries}
    status = spec.clean_name(spec.target) if spec.target else None
    out = {}
    for c in (spec.clean_name(x) for x in spec.selected):
        if c not in df.columns:
            continue
        if c == status:
            out[c] = R.encode_status(c)
        elif c == sex:
            out[c] = F.when(F.col(c) == sexes[0], 0).when(F.col(c) == sexes[1], 1)
        else:
            out[c] = R.encode_flag(c) if c in flags else F.col(c)
    return {c: x.cast("double") for c, x in out.items()}


def correlations(df: DataFrame, spec: S.SurveySpec = S.SURVEY) -> DataFrame:
    """(column_a, column_b, n, r): Pearson correlation of every pair of encoded columns (a before b).

    One aggregate of co-moments: the sums of the columns, their squares and
    their products, each taken from the middle of the column's domain, so
    little is lost where they cancel.  Partial sums leave a task as one row.  Rows
    with a null are left out of every pair; ``r`` is null where a column has
    one value only.
    """
    columns = encoded_columns(df, spec)
    names = list(columns)
    middle = {c: sum(v) / len(v) for c, v in spec.validation.items() if v and not isinstance(next(iter(v)), str)}
    ready = df.select(*[(x - F.lit(float(middle.get(c, 0.0)))).alias(c) for c, x in columns.items()])
    ready = ready.where(C.not_null_predicate(ready))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = ready.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s_{c}") for c in names],
                     *[F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a, b in pairs])

    def moment(a: str, b: str) -> Column:
        return F.col(f"p_{a}_{b}") - F.col(f"s_{a}") * F.col(f"s_{b}") / F.col("n")
    rows = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col("n").alias("n"),
                     F.when((moment(a, a) > 0) & (moment(b, b) > 0),
                            moment(a, b) / F.sqrt(moment(a, a) * moment(b, b))).alias("r"))
            for a, b in pairs if a != b]
    return sums.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


# A6, approximate ---------------------------------------------------------------
def distinct_sketches(df: DataFrame, columns: list[str], load: Column, bits: int = 14) -> DataFrame:
    """(load_id, column_name, sketch): one mergeable distinct-count sketch per load and column."""
    kinds = dict(df.dtypes)
    value = {c: F.col(c) if kinds[c] in ("int", "bigint", "string", "binary") else F.col(c).cast("string") for c in columns}
    each = df.groupBy(load.alias("load_id")).agg(*[F.hll_sketch_agg(value[c], bits).alias(c) for c in columns])
    return each.unpivot(["load_id"], columns, "column_name", "sketch")


def sketched_counts(sketches: DataFrame, loads: list | None = None) -> DataFrame:
    """(column_name, n_distinct): approximate distinct counts of all or some loads, from their stored sketches.

    No row of the loads themselves is read; with 14 bits the relative
    standard error is below 1 %.
    """
    some = sketches if loads is None else sketches.where(F.col("load_id").isin(loads))
    return some.groupBy("column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
