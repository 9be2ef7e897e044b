"""Registered queries: one Spark callable per operator, plus its SQL oracle.

Every callable takes ``(spark, sf_dir)``, reads the given tables (through the
fixture survey derived from ``orders``, or ``labels`` / ``lineitem``) over
their whole extent and returns a DataFrame.  Queries that write (CSV, parquet,
published star) use fresh paths under the shared checkpoint folder.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starloom import spec as S
from starloom.operators import clean as C
from starloom.operators import profile as P
from starloom.operators import quality as Q
from starloom.operators import star as ST
from starloom.operators import views as V
from starloom.plans import oracle as O
from starloom.plans import runs
from starloom.session import reliable_checkpoint, scratch_path
from starloom.sources import files as FS
from starloom.sources import sinks as SK
from starloom.sources import warehouse as WH
from starloom.sources.survey import derived_survey, read_table

Query = Callable[[SparkSession, str], DataFrame]


# --- shared Spark building blocks -------------------------------------------

def _raw(spark, d, year=False):
    return derived_survey(spark, d, with_year=year)


def _clean(spark, d, **kw):
    return C.clean_survey(_raw(spark, d), **kw)


def _star(spark, d, layout=S.MAIN_STAR):
    return ST.build_star(_clean(spark, d), layout)


def _year_dir(spark, d):
    """Lay the multi-year survey out as yearly CSV folders, plus a stray file."""
    path = scratch_path(spark, "years")
    FS.write_year_files(_raw(spark, d, year=True), path)
    # a non-year CSV in the same folder must be ignored by discovery
    spark.range(1).select(F.lit("x").alias("note")).write.option("header", True).csv(
        f"{path}/notes.csv")
    return path


# --- queries ----------------------------------------------------------------

def q_e1_clean(spark, d):
    return _clean(spark, d)


def q_e1_clean_inferred(spark, d):
    return _clean(spark, d, binary_mode="inferred")


def q_a2_class_distribution(spark, d):
    return P.class_distribution(_clean(spark, d))


def q_a3_value_profile_raw(spark, d):
    return P.value_profile(_raw(spark, d), list(S.SELECTED_COLUMNS))


def q_a3_value_profile_clean(spark, d):
    c = _clean(spark, d)
    return P.value_profile(c, [x for x in c.columns if x != "row_key"])


def q_a3_value_profile_steps(spark, d):
    return P.value_profile_by_step(_raw(spark, d))


def q_a4_step_deltas(spark, d):
    return P.step_deltas(_raw(spark, d))


def _lenient(spark, d):
    return C.lenient_recode(_raw(spark, d))


def q_a5_invalid_report(spark, d):
    return P.invalid_report(_lenient(spark, d))


def q_a5_invalid_values(spark, d):
    return P.invalid_values(_lenient(spark, d))


def q_f6_validate_only(spark, d):
    return C.clean_survey(_lenient(spark, d))


def q_p7_fill_zero(spark, d):
    return SK.fill_zero(_lenient(spark, d))


def q_a9_unmapped_sex(spark, d):
    return P.unmapped_count(_clean(spark, d, ordinal_filter=False, validate=False))


def q_f3_binary_infer_labels(spark, d):
    labels = read_table(spark, d, "labels", ["doc_id", "quality", "toxic"])
    recoded = C.binary_inferred(labels, S.LABELS_SPEC)
    return recoded.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n_docs"))


def q_u1_union_years(spark, d):
    return FS.union_years(spark, _year_dir(spark, d))


def q_a8_years_included(spark, d):
    return P.years_included(FS.union_years(spark, _year_dir(spark, d)))


def q_s1_csv_scan(spark, d):
    path = scratch_path(spark, "raw-csv")
    _raw(spark, d).write.option("header", True).csv(path)
    return FS.csv_scan(spark, path)


def q_s3_bounded_scan(spark, d):
    return FS.bounded_scan(_raw(spark, d), 1000)


def q_s4_single_year(spark, d):
    return FS.single_year(spark, _year_dir(spark, d), 1998)


def q_s5_dataset_scan(spark, d):
    path = scratch_path(spark, "clean-csv")
    _clean(spark, d).write.option("header", True).csv(path)
    return FS.dataset_scan(spark, path)


def q_s6_parquet_stage(spark, d):
    return SK.write_stage(_clean(spark, d), scratch_path(spark, "clean-stage"))


def _star_table(table, layout=S.MAIN_STAR):
    def q(spark, d):
        dims = {x.table: x for x in layout.dims}
        if table in dims:  # a dimension alone needs no record ids
            return ST.build_one_dimension(_clean(spark, d), dims[table])
        return _star(spark, d, layout)[table]
    q.__name__ = f"q_{layout.name}_{table}"
    return q


def q_s7_csv_sink(spark, d):
    star = _star(spark, d, S.ALT_STAR)
    paths = SK.write_csv_tables(star, scratch_path(spark, "alt-star-csv"))
    schema = ("record_id bigint, diabetes_status string, bmi_value double, "
              "mental_health_days double, physical_health_days double, "
              "general_health_score double, difficulty_walking string, demographic_id int, "
              "lifestyle_id int, medical_conditions_id int, healthcare_access_id int")
    return spark.read.schema(schema).option("header", True).csv(paths["fact_health_records"])


def q_s7_csv_dimensions(spark, d):
    """The four dimension files, read back as they stand (every cell as text)."""
    star = _star(spark, d, S.ALT_STAR)
    paths = SK.write_csv_tables({x.table: star[x.table] for x in S.ALT_STAR.dims}, scratch_path(spark, "alt-dims-csv"))
    parts = []
    for dim in S.ALT_STAR.dims:
        text = StructType([StructField(c, StringType()) for c in [dim.key, *dim.outputs]])
        rows = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(paths[dim.table])
        parts.append(rows.select(F.lit(dim.table).alias("table_name"), F.col(dim.key).cast("int").alias("key_id"),
                                 F.concat_ws("|", *[F.coalesce(c, F.lit("NULL")) for c in dim.outputs]).alias("row_text")))
    return reduce(DataFrame.unionByName, parts)


def _stored_star(spark, d):
    """The main star, published and read back: its readers scan files, not its plan."""
    root = scratch_path(spark, "published")
    SK.publish_star(_star(spark, d), root)
    return SK.read_published(spark, root)


def q_v1_analysis_view(spark, d):
    return V.analysis_view(V.encode_star(_stored_star(spark, d)), dims_bounded=True)


def q_a6_table_counts(spark, d):
    return V.table_counts(_star(spark, d))


def q_a7_compression_ratio(spark, d):
    return V.compression_ratio(_star(spark, d))


def q_l1_head_sample(spark, d):
    return V.head_sample(_star(spark, d))


def q_k_star_checks(spark, d):
    rough = _clean(spark, d, ordinal_filter=False, validate=False)
    return Q.check_star(ST.build_star(rough, S.MAIN_STAR, validated=False))


def q_p8_load_casts(spark, d):
    return SK.cast_star(_star(spark, d))["fact_health_records"]


def q_a1_lineitem_dimension(spark, d):
    li = read_table(spark, d, "lineitem", ["l_returnflag", "l_linestatus", "l_linenumber"])
    dim = S.DimSpec("dim_line_status", "line_status_id",
                    (("l_returnflag", "l_returnflag"), ("l_linestatus", "l_linestatus"),
                     ("l_linenumber", "l_linenumber")))
    dims = ST.build_dimension(li, dim)
    keyed = ST.lookup_key(li, dims, dim, bound=None)
    counts = keyed.groupBy("line_status_id").agg(F.count(F.lit(1)).alias("n_lines"))
    return dims.join(counts, "line_status_id")


def q_s11_verify_counts(spark, d):
    root = scratch_path(spark, "published")
    SK.publish_star(_star(spark, d), root)
    return SK.verify_counts(SK.read_published(spark, root))


def _database(spark):
    """A database of its own for each run, in the shared checkpoint folder."""
    location = scratch_path(spark, "warehouse")
    return "starloom_" + location[-12:], location


def q_s10_recreate_tables(spark, d):
    """Tables that hold the alternate layout's rows are re-created for the main one and loaded."""
    db, location = _database(spark)
    alt = _star(spark, d, S.ALT_STAR)
    types = WH.types_of(alt)
    WH.recreate_tables(spark, db, S.ALT_STAR, types, location)
    WH.load_star(alt, db, "old", S.ALT_STAR, types)
    WH.recreate_tables(spark, db)
    WH.load_star(_star(spark, d), db, "survey")
    tables = S.MAIN_STAR.tables
    counts = SK.verify_counts({t: WH.loaded(spark, db, t) for t in tables})
    return WH.table_columns(spark, db, tables).join(counts, "table_name")


def _loads(spark, d):
    """The main star in four loads: its dimensions, then the fact by class, one of the loads run twice."""
    db, location = _database(spark)
    star = {t: reliable_checkpoint(df, t) for t, df in _star(spark, d).items()}
    fact = star.pop("fact_health_records")
    WH.recreate_tables(spark, db, location=location)
    WH.load_star(star, db, "dimensions")
    classes = list(S.TARGET_LABELS.values())
    for label in [*classes, classes[0]]:
        WH.load_star({"fact_health_records": fact.where(F.col("diabetes_status") == label)}, db, label.lower())
    return db


def q_s8_append_loads(spark, d):
    return WH.loaded(spark, _loads(spark, d), "fact_health_records", with_load=True)


def q_s11_verify_loads(spark, d):
    return WH.verify_loads(spark, _loads(spark, d))


def q_k6_created_at(spark, d):
    root = scratch_path(spark, "k6-published")
    SK.publish_star(_star(spark, d), root, created_at=True)
    return Q.created_at_report(SK.read_published(spark, root))


def q_e4_end_to_end(spark, d):
    res = runs.end_to_end(_raw(spark, d), scratch_path(spark, "e4-published"))
    return SK.read_published(spark, res.published_root)["fact_health_records"]


def q_e5_staged_run(spark, d):
    res = runs.staged_run(spark, _raw(spark, d), scratch_path(spark, "e5-stages"),
                          scratch_path(spark, "e5-published"))
    return res.summary


def q_a10_run_summary(spark, d):
    raw = _raw(spark, d)
    clean = C.clean_survey(raw)
    return P.run_summary(raw, clean, ST.build_star(clean))


def q_v3_db_stats(spark, d):
    root = scratch_path(spark, "stats")
    paths = SK.publish_star(_star(spark, d), root)
    return V.db_stats_report(paths, spark)


def _e6(table, layout=S.MAIN_STAR):
    def q(spark, d):
        from starloom.streaming.incremental import incremental_demo
        return incremental_demo(spark, d, layout)[table]
    return q


#: A layout with a dimension that no closed domain bounds (body mass has none).
OPEN_STAR = S.StarLayout(
    name="open",
    dims=(S.DimSpec("dim_condition", "condition_id", (("BMI", "bmi_value"), ("GenHlth", "general_health_score"))),
          S.MAIN_STAR.dims[1]),
    fact_table="fact_health_records",
    record_key="record_id",
    measures=(("diabetes_status", "diabetes_status", "string"), ("MentHlth", "mental_health_days", "double")),
)


def _keyless_csv(spark, d):
    """The raw survey as several CSV files without a key, ordered by customer and order."""
    path = scratch_path(spark, "keyless-csv")
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    raw = _raw(spark, d).join(orders, F.col("row_key") == F.col("o_orderkey"))
    (raw.repartitionByRange(8, "o_custkey", "row_key").sortWithinPartitions("o_custkey", "row_key")
        .select(*S.SELECTED_COLUMNS).write.option("header", True).csv(path))
    return path


def _file_order_star(table):
    def q(spark, d):
        raw = FS.csv_scan(spark, _keyless_csv(spark, d), file_order=True)
        return ST.build_star(C.clean_survey(raw))[table]
    return q


def _plain_year_dir(spark, d):
    """Yearly files named ``<year>.csv``, without a key column, rows in key order."""
    root = scratch_path(spark, "plain-years")
    raw = SK.write_stage(_raw(spark, d, year=True), scratch_path(spark, "by-year"), partition_by=["DATA_YEAR"])
    for year in sorted(r[0] for r in raw.select("DATA_YEAR").distinct().collect()):  # calendar years
        (raw.where(F.col("DATA_YEAR") == year).repartitionByRange(3, "row_key").sortWithinPartitions("row_key")
            .select(*S.SELECTED_COLUMNS).write.option("header", True).csv(f"{root}/{year}.csv"))
    return root


def q_e4_run_files(spark, d):
    root = scratch_path(spark, "run-files")
    runs.run_files(spark, _plain_year_dir(spark, d), root)
    return SK.read_published(spark, root)["fact_health_records"]


def q_e4_run_one_year(spark, d):
    root = scratch_path(spark, "run-year")
    runs.run_files(spark, _plain_year_dir(spark, d), root, years=1998)
    return SK.read_published(spark, root)["dim_demographics"]


def q_e3_alternate_run(spark, d):
    path = scratch_path(spark, "processed-csv")
    (_clean(spark, d).repartitionByRange(4, "row_key").sortWithinPartitions("row_key").drop("row_key")
        .write.option("header", True).csv(path))
    _, samples, ratio = runs.run_alternate(spark, path, scratch_path(spark, "alternate"))
    return samples.unionByName(ratio.select(
        F.lit("ratio").alias("table_name"), F.col("fact_rows").alias("key_id"),
        F.col("dimension_rows").cast("string").alias("row_text")))


def broken_star_sql(star_table: Callable[[str], str]) -> dict[str, str]:
    """Each star table with faults of every kind, as SQL that both engines run."""
    out = {}
    for dim in S.MAIN_STAR.dims:
        first, *rest = dim.outputs
        key = dim.key
        text = f"CAST({first} AS {{text}})"
        out[dim.table] = (
            f"SELECT {key}, CASE WHEN {key} % 5 = 0 THEN NULL WHEN {key} % 3 = 0 THEN "
            f"concat({text}, ' and much more') ELSE {text} END AS {first}, {', '.join(rest)} "
            f"FROM {star_table(dim.table)} WHERE {key} % 7 <> 6 "
            f"UNION ALL SELECT {key}, {text}, {', '.join(rest)} FROM {star_table(dim.table)} WHERE {key} % 4 = 1")
    keys = ", ".join(f"CASE WHEN record_id % {11 + i} = 0 THEN NULL ELSE {d.key} END AS {d.key}"
                     for i, d in enumerate(S.MAIN_STAR.dims))
    fact = star_table("fact_health_records")
    out["fact_health_records"] = (
        "SELECT record_id, CASE WHEN record_id % 13 = 0 THEN 'far too long for the column' "
        "WHEN record_id % 17 = 0 THEN NULL ELSE diabetes_status END AS diabetes_status, "
        "CASE WHEN record_id % 19 = 0 THEN 12345.0 WHEN record_id % 23 = 0 THEN 0.0 ELSE bmi_value END AS bmi_value, "
        "CASE WHEN record_id % 29 = 0 THEN 31.0 ELSE mental_health_days END AS mental_health_days, "
        "CASE WHEN record_id % 31 = 0 THEN -1.0 ELSE physical_health_days END AS physical_health_days, "
        "CASE WHEN record_id % 37 = 0 THEN 999.0 ELSE general_health_score END AS general_health_score, "
        f"{keys} FROM {fact} UNION ALL SELECT * FROM {fact} WHERE record_id % 41 = 0")
    return out


def q_k_broken_star(spark, d):
    star = {t: SK.write_stage(df, scratch_path(spark, "sound")) for t, df in _star(spark, d).items()}
    broken = {t: spark.sql(sql.replace("{text}", "STRING"), **{f"t_{t}": star[t]})
              for t, sql in broken_star_sql(lambda t: "{t_" + t + "}").items()}
    return Q.check_star(broken)


#: F3 fixture: one column coded 0/1, one without a binary pattern, and one whose
#: zeros stand only in rows that the column before it removes.
INFER_RECODES = {
    "_RFHYPE5": "CASE WHEN _RFHYPE5 = 2 THEN 0 ELSE _RFHYPE5 END",
    "TOLDHI2": "CASE WHEN _RFHYPE5 = 9 THEN 0 ELSE TOLDHI2 END",
    "_CHOLCHK": "CASE WHEN _CHOLCHK = 2 THEN 7 ELSE _CHOLCHK END",
}
INFER_MODES = {"_RFHYPE5": (0, 1), "TOLDHI2": (1, 2), "_CHOLCHK": None}


def _mixed_codes(spark, d):
    raw = _raw(spark, d)
    return raw.selectExpr(*[f"CAST({INFER_RECODES[c]} AS DOUBLE) AS {c}" if c in INFER_RECODES else c
                            for c in raw.columns])


def q_a4_step_deltas_inferred(spark, d):
    raw = _mixed_codes(spark, d)
    return P.step_deltas(raw, P.inferred_spec(raw))


def q_e1_clean_mixed(spark, d):
    return C.clean_survey(_mixed_codes(spark, d), binary_mode="inferred", validate=False)


#: Fixture of malformed rows: every so-manieth row of this year has a cell too many.
RAGGED_YEAR, RAGGED_EVERY = 1998, 50


def _lines(df, columns, path, longer=None):
    """Rows as plain text lines under a header, written as they stand (a line may have a cell too many)."""
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    if longer is not None:
        line = F.when(longer, F.concat(line, F.lit(","))).otherwise(line)
    (df.select(line.alias(",".join(columns))).write.mode("append")
        .option("header", True).option("sep", "\u0001").csv(path))


def _ragged_year_dir(spark, d):
    """Yearly folders whose part files have different headers: columns turned round, one more in front."""
    root = scratch_path(spark, "ragged-years")
    raw = SK.write_stage(_raw(spark, d, year=True).withColumn("STATE", F.lit(7)),
                         scratch_path(spark, "by-year"), partition_by=["DATA_YEAR"])
    cols = ["row_key", *S.SELECTED_COLUMNS]
    for year in sorted(r[0] for r in raw.select("DATA_YEAR").distinct().collect()):  # calendar years
        rows = raw.where(F.col("DATA_YEAR") == year)
        long = (F.col("row_key") % RAGGED_EVERY == 0) if year == RAGGED_YEAR else None
        half = F.col("row_key") % 2 == 0
        _lines(rows.where(half), cols, f"{root}/{year}.csv", long)
        _lines(rows.where(~half), ["STATE", *cols[::-1]], f"{root}/{year}.csv", long)
    return root


def q_u1_ragged_years(spark, d):
    return FS.union_years(spark, _ragged_year_dir(spark, d))


def q_s1_rejected_rows(spark, d):
    taken = FS.take_in_years(spark, _ragged_year_dir(spark, d))
    cells = F.split("line", ",")
    key = F.when(F.size(cells) == len(S.SELECTED_COLUMNS) + 2, cells[0]).otherwise(F.element_at(cells, -2))
    return taken.rejected.select("DATA_YEAR", key.cast("long").alias("row_key"))


def _year_stream(spark, d):
    """Plain keyless yearly CSVs, odd years with other columns and another order, arriving a year at a time."""
    from starloom.streaming.incremental import year_stream_demo

    src = scratch_path(spark, "e6-year-files")
    raw = SK.write_stage(_raw(spark, d, year=True).withColumn("STATE", F.lit(7)),
                         scratch_path(spark, "by-year"), partition_by=["DATA_YEAR"])
    years = sorted(r[0] for r in raw.select("DATA_YEAR").distinct().collect())  # calendar years

    def arrive(year):
        cols = list(S.SELECTED_COLUMNS)
        rows = raw.where(F.col("DATA_YEAR") == year).repartitionByRange(3, "row_key").sortWithinPartitions("row_key")
        rows.select(*(["STATE", *cols[::-1]] if year % 2 else cols)).write.option("header", True).csv(f"{src}/{year}.csv")
    return year_stream_demo(spark, src, years, arrive)


def q_e6_year_files(spark, d):
    return _year_stream(spark, d)[0]["fact_health_records"]


def q_e6_year_files_dim_lifestyle(spark, d):
    return _year_stream(spark, d)[0]["dim_lifestyle"]


def q_a4_observed_deltas(spark, d):
    return P.stage_with_deltas(_raw(spark, d), scratch_path(spark, "observed-clean"))[1]


def q_e1_observed_clean(spark, d):
    return P.stage_with_deltas(_raw(spark, d), scratch_path(spark, "observed-clean"))[0]


def q_x2_correlations(spark, d):
    return P.correlations(_clean(spark, d)).withColumn("r", F.round("r", 7))


#: Columns of the approximate distinct counts, and how far an estimate may be off (as a share).
SKETCHED, SKETCH_BOUND = ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"), 0.04


def q_a6_sketched_counts(spark, d):
    lines = read_table(spark, d, "lineitem", list(SKETCHED))
    path = scratch_path(spark, "sketches")
    P.distinct_sketches(lines, list(SKETCHED), F.year("l_shipdate")).write.parquet(path)
    merged = P.sketched_counts(spark.read.parquet(path))
    exact = lines.agg(*[F.count_distinct(c).alias(c) for c in SKETCHED]).unpivot([], list(SKETCHED), "column_name", "n_exact")
    off = F.abs(F.col("n_distinct") - F.col("n_exact")) <= SKETCH_BOUND * F.col("n_exact")
    return merged.join(F.broadcast(exact), "column_name").select("column_name", "n_exact", off.alias("within_bound"))


QUERIES: dict[str, Query] = {
    "e1_clean": q_e1_clean,
    "e1_clean_inferred": q_e1_clean_inferred,
    "a2_class_distribution": q_a2_class_distribution,
    "a3_value_profile_raw": q_a3_value_profile_raw,
    "a3_value_profile_clean": q_a3_value_profile_clean,
    "a3_value_profile_steps": q_a3_value_profile_steps,
    "a4_step_deltas": q_a4_step_deltas,
    "a5_invalid_report": q_a5_invalid_report,
    "a5_invalid_values": q_a5_invalid_values,
    "f6_validate_only": q_f6_validate_only,
    "p7_fill_zero": q_p7_fill_zero,
    "a9_unmapped_sex": q_a9_unmapped_sex,
    "f3_binary_infer_labels": q_f3_binary_infer_labels,
    "u1_union_years": q_u1_union_years,
    "a8_years_included": q_a8_years_included,
    "s1_csv_scan": q_s1_csv_scan,
    "s3_bounded_scan": q_s3_bounded_scan,
    "s4_single_year": q_s4_single_year,
    "s5_dataset_scan": q_s5_dataset_scan,
    "s6_parquet_stage": q_s6_parquet_stage,
    "e2_dim_demographics": _star_table("dim_demographics"),
    "e2_dim_lifestyle": _star_table("dim_lifestyle"),
    "e2_dim_medical_conditions": _star_table("dim_medical_conditions"),
    "e2_dim_healthcare_access": _star_table("dim_healthcare_access"),
    "e2_fact_health_records": _star_table("fact_health_records"),
    "e3_alt_dim_medical_conditions": _star_table("dim_medical_conditions", S.ALT_STAR),
    "e3_alt_dim_healthcare_access": _star_table("dim_healthcare_access", S.ALT_STAR),
    "e3_alt_fact_health_records": _star_table("fact_health_records", S.ALT_STAR),
    "s7_csv_sink": q_s7_csv_sink,
    "s7_csv_dimensions": q_s7_csv_dimensions,
    "v1_analysis_view": q_v1_analysis_view,
    "a6_table_counts": q_a6_table_counts,
    "a7_compression_ratio": q_a7_compression_ratio,
    "l1_head_sample": q_l1_head_sample,
    "k_star_checks": q_k_star_checks,
    "p8_load_casts": q_p8_load_casts,
    "a1_lineitem_dimension": q_a1_lineitem_dimension,
    "s11_verify_counts": q_s11_verify_counts,
    "s10_recreate_tables": q_s10_recreate_tables,
    "s8_append_loads": q_s8_append_loads,
    "s11_verify_loads": q_s11_verify_loads,
    "k6_created_at": q_k6_created_at,
    "e4_end_to_end": q_e4_end_to_end,
    "e5_staged_run": q_e5_staged_run,
    "a10_run_summary": q_a10_run_summary,
    "v3_db_stats": q_v3_db_stats,
    "e6_incremental": _e6("fact_health_records"),
    "e6_dim_demographics": _e6("dim_demographics"),
    "e6_open_fact": _e6("fact_health_records", OPEN_STAR),
    "e6_open_dimension": _e6("dim_condition", OPEN_STAR),
    "w2_file_order_fact": _file_order_star("fact_health_records"),
    "w1_file_order_dim_medical_conditions": _file_order_star("dim_medical_conditions"),
    "e4_run_files": q_e4_run_files,
    "e4_run_one_year": q_e4_run_one_year,
    "e3_alternate_run": q_e3_alternate_run,
    "k_broken_star": q_k_broken_star,
    "a4_step_deltas_inferred": q_a4_step_deltas_inferred,
    "e1_clean_mixed": q_e1_clean_mixed,
    "u1_ragged_years": q_u1_ragged_years,
    "s1_rejected_rows": q_s1_rejected_rows,
    "e6_year_files": q_e6_year_files,
    "e6_year_files_dim_lifestyle": q_e6_year_files_dim_lifestyle,
    "a4_observed_deltas": q_a4_observed_deltas,
    "e1_observed_clean": q_e1_observed_clean,
    "x2_correlations": q_x2_correlations,
    "a6_sketched_counts": q_a6_sketched_counts,
}


# --- oracle SQL ---------------------------------------------------------------

def _oracle() -> dict[str, str]:
    base = O.base_ctes()
    star = base + O.star_ctes()
    alt = base + O.star_ctes(S.ALT_STAR, prefix="alt_")
    clean_cols = [S.RENAME[c] for c in S.SELECTED_COLUMNS]
    sql: dict[str, str] = {}
    sql["e1_clean"] = O.with_ctes(base, "SELECT * FROM clean")
    sql["e1_clean_inferred"] = sql["e1_clean"]
    sql["a2_class_distribution"] = O.with_ctes(base, (
        "SELECT diabetes_status, n_records, "
        "CAST(n_records AS DOUBLE) / CAST(sum(n_records) OVER () AS DOUBLE) * 100.0 AS percent "
        "FROM (SELECT diabetes_status, count(*) AS n_records FROM clean GROUP BY diabetes_status) t"))
    sql["a3_value_profile_raw"] = O.with_ctes([("raw", O.RAW)], (
        "SELECT column_name, value, count(*) AS n FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM raw"
            for c in S.SELECTED_COLUMNS) + ") u WHERE value IS NOT NULL GROUP BY column_name, value"))
    sql["a3_value_profile_clean"] = O.with_ctes(base, (
        "SELECT column_name, value, count(*) AS n FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM clean"
            for c in clean_cols) + ") u WHERE value IS NOT NULL GROUP BY column_name, value"))
    sql["a3_value_profile_steps"] = O.value_profile_by_step_sql()
    sql["a4_step_deltas"] = O.step_deltas_sql()
    ff = O.first_failure_ctes()
    sql["a5_invalid_report"] = O.with_ctes(ff, (
        "SELECT CAST(rule_no AS INTEGER) AS rule_no, column_name, count(*) AS invalid_rows, "
        "count(*) FILTER (WHERE bad IS NULL) AS null_rows, count(DISTINCT bad) AS distinct_invalid "
        "FROM charged GROUP BY rule_no, column_name"))
    sql["a5_invalid_values"] = O.with_ctes(ff, (
        "SELECT CAST(rule_no AS INTEGER) AS rule_no, column_name, bad AS value, count(*) AS n "
        "FROM charged GROUP BY rule_no, column_name, bad"))
    sql["f6_validate_only"] = O.with_ctes(
        [("raw", O.RAW), ("lenient", O.lenient_sql("raw"))],
        f"SELECT * FROM lenient WHERE {O.validation_predicate()}")
    fill = ", ".join(
        (f"COALESCE({c}, '0') AS {c}" if c in S.VALIDATION_DOMAINS and
         isinstance(S.VALIDATION_DOMAINS[c][0], str) else f"COALESCE({c}, 0) AS {c}")
        for c in clean_cols)
    sql["p7_fill_zero"] = O.with_ctes(
        [("raw", O.RAW), ("lenient", O.lenient_sql("raw"))],
        f"SELECT COALESCE(row_key, 0) AS row_key, {fill} FROM lenient")
    sql["a9_unmapped_sex"] = O.with_ctes(
        O.base_ctes(ordinal=False, validate=False),
        "SELECT count(*) FILTER (WHERE Sex IS NULL) AS unmapped_rows, count(*) AS total_rows FROM clean")
    sql["f3_binary_infer_labels"] = (
        "SELECT CASE WHEN quality = 1 THEN 'Yes' ELSE 'No' END AS quality, "
        "CASE WHEN toxic = 1 THEN 'Yes' ELSE 'No' END AS toxic, count(*) AS n_docs "
        "FROM labels WHERE quality IN (0, 1) AND toxic IN (0, 1) GROUP BY 1, 2")
    sql["u1_union_years"] = f"SELECT * FROM ({O.RAW_YEAR}) y"
    sql["a8_years_included"] = (f"SELECT DATA_YEAR, count(*) AS n_records, "
                                f"GROUPING(DATA_YEAR) = 1 AS is_total FROM ({O.RAW_YEAR}) y "
                                "GROUP BY ROLLUP (DATA_YEAR)")
    sql["s1_csv_scan"] = f"SELECT * FROM ({O.RAW}) r"
    sql["s3_bounded_scan"] = f"SELECT * FROM ({O.RAW}) r ORDER BY row_key LIMIT 1000"
    sql["s4_single_year"] = (f"SELECT * EXCLUDE (DATA_YEAR) FROM ({O.RAW_YEAR}) y "
                             "WHERE DATA_YEAR = 1998")
    sql["s5_dataset_scan"] = sql["e1_clean"]
    sql["s6_parquet_stage"] = sql["e1_clean"]
    for t in S.MAIN_STAR.tables:
        sql[f"e2_{t}"] = O.with_ctes(star, f"SELECT * FROM {t}")
    for t in ("dim_medical_conditions", "dim_healthcare_access", "fact_health_records"):
        sql[f"e3_alt_{t}"] = O.with_ctes(alt, f"SELECT * FROM alt_{t}")
    sql["s7_csv_sink"] = sql["e3_alt_fact_health_records"]
    sql["s7_csv_dimensions"] = O.with_ctes(alt, " UNION ALL ".join(
        f"SELECT '{d.table}' AS table_name, {d.key} AS key_id, concat_ws('|', "
        + ", ".join(f"COALESCE(CAST({o} AS VARCHAR), 'NULL')" for o in d.outputs)
        + f") AS row_text FROM alt_{d.table}" for d in S.ALT_STAR.dims))
    view = star + O.encoded_ctes()
    sql["v1_analysis_view"] = O.with_ctes(view, O.view_select())
    sql["a6_table_counts"] = O.with_ctes(star, O.table_counts_select())
    sql["a7_compression_ratio"] = O.with_ctes(star + [
        ("c", "SELECT (SELECT count(*) FROM fact_health_records) AS fact_rows, "
              "(SELECT count(*) FROM dim_demographics) + (SELECT count(*) FROM dim_lifestyle) + "
              "(SELECT count(*) FROM dim_medical_conditions) + "
              "(SELECT count(*) FROM dim_healthcare_access) AS dimension_rows")],
        "SELECT CAST(fact_rows AS BIGINT) AS fact_rows, CAST(dimension_rows AS BIGINT) AS dimension_rows, "
        "CAST(fact_rows AS DOUBLE) / CAST(fact_rows + dimension_rows AS DOUBLE) AS fact_share FROM c")
    sql["l1_head_sample"] = O.with_ctes(star, " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{d.table}' AS table_name, CAST({d.key} AS BIGINT) AS key_id, "
        "concat_ws('|', " + ", ".join(f"COALESCE(CAST({o} AS VARCHAR), 'NULL')" for o in d.outputs)
        + f") AS row_text FROM {d.table} ORDER BY {d.key} LIMIT 3)" for d in S.MAIN_STAR.dims))
    sql["k_star_checks"] = O.with_ctes(
        O.base_ctes(ordinal=False, validate=False) + O.star_ctes(), _checks_sql())
    fact_types = S.LOAD_TYPES["fact_health_records"]
    sql["p8_load_casts"] = O.with_ctes(star, "SELECT " + ", ".join(
        f"CAST({c} AS {('VARCHAR' if t.startswith('varchar') else t.upper())}) AS {c}"
        for c, t in fact_types.items()) + " FROM fact_health_records")
    sql["a1_lineitem_dimension"] = (
        "SELECT CAST(row_number() OVER (ORDER BY l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, "
        "l_linenumber NULLS FIRST) AS INTEGER) AS line_status_id, l_returnflag, l_linestatus, "
        "l_linenumber, n_lines FROM (SELECT l_returnflag, l_linestatus, l_linenumber, "
        "count(*) AS n_lines FROM lineitem GROUP BY ALL) t")
    counts = O.table_counts_select(distinct_dims=False, col="row_count")
    sql["s11_verify_counts"] = O.with_ctes(star, counts)
    sql["k6_created_at"] = O.with_ctes(star, (
        "SELECT table_name, row_count, CAST(0 AS BIGINT) AS unstamped_rows, "
        f"CAST(1 AS BIGINT) AS load_stamps FROM ({counts}) t"))
    dim_of = {x.key: x.table for x in S.MAIN_STAR.dims}
    keys = dim_of | {S.MAIN_STAR.record_key: S.MAIN_STAR.fact_table}
    sql["s10_recreate_tables"] = O.with_ctes(star + [("sizes", counts)], " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {i} AS position, '{c}' AS column_name, '{kind}' AS data_type, "
        + ("'primary key'" if keys.get(c) == t else f"'references {dim_of[c]}.{c}'" if c in dim_of else "''")
        + f" AS key_role, (SELECT row_count FROM sizes WHERE table_name = '{t}') AS row_count"
        for t in S.MAIN_STAR.tables for i, (c, kind) in enumerate(S.LOAD_TYPES[t].items(), 1)))
    sql["s8_append_loads"] = f"SELECT *, lower(diabetes_status) AS load_id FROM ({sql['p8_load_casts']}) f"
    per_class = " UNION ALL ".join(
        f"SELECT 'fact_health_records' AS table_name, '{label.lower()}' AS load_id, count(*) AS row_count "
        f"FROM fact_health_records WHERE diabetes_status = '{label}'" for label in S.TARGET_LABELS.values())
    sql["s11_verify_loads"] = O.with_ctes(star, (
        "SELECT table_name, load_id, row_count, row_count AS ledger_count FROM ("
        f"SELECT table_name, 'dimensions' AS load_id, row_count FROM ({counts}) t WHERE table_name LIKE 'dim%' "
        f"UNION ALL {per_class}) a"))
    sql["e4_end_to_end"] = sql["p8_load_casts"]
    summary = (
        "SELECT 'raw_rows' AS metric, '' AS item, (SELECT count(*) FROM raw) AS value "
        "UNION ALL SELECT 'clean_rows', '', (SELECT count(*) FROM clean) "
        "UNION ALL SELECT 'rows_removed', '', (SELECT count(*) FROM raw) - (SELECT count(*) FROM clean) "
        "UNION ALL SELECT 'class_count', diabetes_status, count(*) FROM clean GROUP BY diabetes_status "
        f"UNION ALL SELECT 'table_rows', table_name, row_count FROM ({counts}) t")
    sql["e5_staged_run"] = O.with_ctes(star, summary)
    sql["a10_run_summary"] = sql["e5_staged_run"]
    sql["e6_incremental"] = O.with_ctes(O.incremental_star_ctes(), "SELECT * FROM fact_health_records")
    sql["e6_dim_demographics"] = O.with_ctes(O.incremental_star_ctes(), "SELECT * FROM dim_demographics")
    open_star = O.incremental_star_ctes(OPEN_STAR)
    sql["e6_open_fact"] = O.with_ctes(open_star, "SELECT * FROM fact_health_records")
    sql["e6_open_dimension"] = O.with_ctes(open_star, "SELECT * FROM dim_condition")
    sql["v3_db_stats"] = O.with_ctes(star, (
        "SELECT table_name, row_count, CAST(row_number() OVER (ORDER BY row_count DESC, table_name) AS INTEGER) "
        f"AS position, TRUE AS size_as_listed FROM ({counts}) t"))
    # rows numbered by where they stand in the files
    by_file = [("raw", f"SELECT r.* REPLACE (row_number() OVER (ORDER BY o.o_custkey, r.row_key) AS row_key) "
                       f"FROM ({O.RAW}) r JOIN orders o ON r.row_key = o.o_orderkey"),
               ("clean", O.clean_sql("raw"))] + O.star_ctes()
    sql["w2_file_order_fact"] = O.with_ctes(by_file, "SELECT * FROM fact_health_records")
    sql["w1_file_order_dim_medical_conditions"] = O.with_ctes(by_file, "SELECT * FROM dim_medical_conditions")

    def by_year(where):
        return [("raw", "SELECT * EXCLUDE (DATA_YEAR) REPLACE (row_number() OVER (ORDER BY DATA_YEAR, row_key) "
                        f"AS row_key) FROM ({O.RAW_YEAR}) y {where}"),
                ("clean", O.clean_sql("raw"))] + O.star_ctes()

    def stored(table):
        return "SELECT " + ", ".join(
            f"CAST({c} AS {('VARCHAR' if t.startswith('varchar') else t.upper())}) AS {c}"
            for c, t in S.LOAD_TYPES[table].items()) + f" FROM {table}"
    sql["e4_run_files"] = O.with_ctes(by_year(""), stored("fact_health_records"))
    sql["e4_run_one_year"] = O.with_ctes(by_year("WHERE DATA_YEAR = 1998"), stored("dim_demographics"))
    sql["e6_year_files"] = O.with_ctes(by_year(""), "SELECT * FROM fact_health_records")
    sql["e6_year_files_dim_lifestyle"] = O.with_ctes(by_year(""), "SELECT * FROM dim_lifestyle")
    sql["u1_ragged_years"] = f"SELECT * FROM ({O.RAW_YEAR}) y WHERE DATA_YEAR <> {RAGGED_YEAR}"
    sql["s1_rejected_rows"] = (f"SELECT DATA_YEAR, row_key FROM ({O.RAW_YEAR}) y "
                               f"WHERE DATA_YEAR = {RAGGED_YEAR} AND row_key % {RAGGED_EVERY} = 0")
    sql["a4_observed_deltas"] = sql["a4_step_deltas"]
    sql["e1_observed_clean"] = sql["e1_clean"]
    sql["x2_correlations"] = O.with_ctes(base, O.correlation_select())
    sql["a6_sketched_counts"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_exact, TRUE AS within_bound FROM lineitem" for c in SKETCHED)
    alt_dims = [d for d in S.ALT_STAR.dims]
    sql["e3_alternate_run"] = O.with_ctes(alt, " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{d.table}' AS table_name, CAST({d.key} AS BIGINT) AS key_id, "
        "concat_ws('|', " + ", ".join(f"COALESCE(CAST({o} AS VARCHAR), 'NULL')" for o in d.outputs)
        + f") AS row_text FROM alt_{d.table} ORDER BY {d.key} LIMIT 3)" for d in alt_dims)
        + " UNION ALL SELECT 'ratio', (SELECT count(*) FROM alt_fact_health_records), CAST("
        + " + ".join(f"(SELECT count(*) FROM alt_{d.table})" for d in alt_dims) + " AS VARCHAR)")
    broken = [(f"b_{t}", q.replace("{text}", "VARCHAR")) for t, q in broken_star_sql(lambda t: t).items()]
    checks = _checks_sql()
    for t in S.MAIN_STAR.tables:
        checks = re.sub(rf"FROM {t}\b", f"FROM b_{t}", checks)
    sql["k_broken_star"] = O.with_ctes(star + broken, checks)
    sql["a4_step_deltas_inferred"] = O.inferred_step_deltas_sql(INFER_RECODES, INFER_MODES)
    sql["e1_clean_mixed"] = O.inferred_clean_sql(INFER_RECODES, INFER_MODES)
    return sql


def _checks_sql() -> str:
    """K1, K2, K3, K4, K5 over the (uncleaned) star, as union of violation rows."""
    parts = []
    types = S.LOAD_TYPES
    tables = [(d.table, d.key, [d.key] + d.outputs) for d in S.MAIN_STAR.dims]
    fact_cols = ["record_id"] + [o for _, o, _ in S.MAIN_STAR.measures] + \
        [d.key for d in S.MAIN_STAR.dims]
    tables.append(("fact_health_records", "record_id", fact_cols))

    def row(constraint, table, col, key, value, where):
        return (f"SELECT '{constraint}' AS constraint, '{table}' AS table_name, "
                f"'{col}' AS column_name, CAST({key} AS BIGINT) AS row_key, "
                f"CAST({value} AS VARCHAR) AS value FROM {table} WHERE {where}")

    for table, key, cols in tables:
        for c in cols:
            parts.append(row("not_null", table, c, key, c, f"{c} IS NULL"))
            t = types[table].get(c, "")
            if t.startswith("varchar"):
                n = int(t[8:-1])
                parts.append(row("fits_type", table, c, key, c,
                                 f"length(CAST({c} AS VARCHAR)) > {n}"))
            elif t.startswith("decimal") or t in ("int", "bigint"):
                parts.append(row("fits_type", table, c, key, c,
                                 f"{c} IS NOT NULL AND TRY_CAST({c} AS {t.upper()}) IS NULL"))
        parts.append(f"SELECT 'unique_key', '{table}', '{key}', CAST({key} AS BIGINT), "
                     f"CAST(count(*) AS VARCHAR) FROM {table} GROUP BY {key} HAVING count(*) > 1")
    for c, (lo, lo_inc, hi, hi_inc) in S.RANGE_CHECKS.items():
        ok = f"{c} {'>=' if lo_inc else '>'} {lo} AND {c} {'<=' if hi_inc else '<'} {hi}"
        parts.append(row("check_range", "fact_health_records", c, "record_id", c,
                         f"{c} IS NOT NULL AND NOT ({ok})"))
    code = "CASE diabetes_status WHEN 'Healthy' THEN 0 WHEN 'Prediabetic' THEN 1 WHEN 'Diabetic' THEN 2 END"
    parts.append(row("check_range", "fact_health_records", "diabetes_status", "record_id",
                     "diabetes_status", f"{code} IS NOT NULL AND {code} NOT IN (0, 1, 2)"))
    for d in S.MAIN_STAR.dims:
        parts.append(row("foreign_key", "fact_health_records", d.key, "record_id", d.key,
                         f"{d.key} IS NOT NULL AND {d.key} NOT IN (SELECT {d.key} FROM {d.table} "
                         f"WHERE {d.key} IS NOT NULL)"))
    return " UNION ALL ".join(parts)


ORACLE_SQL = _oracle()


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE_SQL.items() if k in QUERIES}
