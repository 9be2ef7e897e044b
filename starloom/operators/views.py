"""Encoded star, labelled analysis view and warehouse statistics.

The loader stores labels ("Yes"/"Diabetic"...), while the SQL schema and its
analysis view use integer codes; ``encode_star`` (C7) bridges the two.  The
view (V1) is a four-way star join: dimensions built from validated data are
bounded by their closed domains (others are size-checked first), so each join
is a broadcast hash join and the fact is never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom import spec as S
from starloom.functions import recode as R
from starloom.operators.skew import fits_broadcast, salted_join
from starloom.session import table_bytes

# C7 -------------------------------------------------------------------------
def encode_star(star: dict[str, DataFrame], layout: S.StarLayout = S.MAIN_STAR) -> dict[str, DataFrame]:
    """Labels -> integer codes, measures -> the SQL schema's numeric types."""
    out = {}
    for d in layout.dims:
        t = star[d.table]
        cols = [F.col(d.key)]
        for _, o in d.columns:
            if o == "sex":
                cols.append(F.col(o))
            elif o in ("age_group", "education_level", "income_bracket"):
                cols.append(F.col(o).cast("int").alias(o))
            else:
                cols.append(R.encode_flag(o).alias(o))
        out[d.table] = t.select(*cols)
    fact = star[layout.fact_table]
    out[layout.fact_table] = fact.select(
        F.col(layout.record_key),
        R.encode_status("diabetes_status").alias("diabetes_status"),
        F.col("bmi_value").cast("decimal(5,2)").alias("bmi_value"),
        F.col("mental_health_days").cast("int").alias("mental_health_days"),
        F.col("physical_health_days").cast("int").alias("physical_health_days"),
        F.col("general_health_score").cast("int").alias("general_health_score"),
        *[F.col(d.key) for d in layout.dims])
    return out


def decode_star(encoded: dict[str, DataFrame], layout: S.StarLayout = S.MAIN_STAR) -> dict[str, DataFrame]:
    """Inverse of ``encode_star`` (codes -> labels, numbers -> double)."""
    out = {}
    for d in layout.dims:
        cols = [F.col(d.key)]
        for _, o in d.columns:
            if o == "sex":
                cols.append(F.col(o))
            elif o in ("age_group", "education_level", "income_bracket"):
                cols.append(F.col(o).cast("double").alias(o))
            else:
                cols.append(R.decode_flag(o).alias(o))
        out[d.table] = encoded[d.table].select(*cols)
    out[layout.fact_table] = encoded[layout.fact_table].select(
        F.col(layout.record_key),
        R.decode_status("diabetes_status").alias("diabetes_status"),
        *[F.col(c).cast("double").alias(c) for c in
          ("bmi_value", "mental_health_days", "physical_health_days", "general_health_score")],
        *[F.col(d.key) for d in layout.dims])
    return out


# J3 + V1 --------------------------------------------------------------------
def star_join(encoded: dict[str, DataFrame], layout: S.StarLayout = S.MAIN_STAR,
              dims_bounded: bool | None = None) -> DataFrame:
    """Fact INNER JOIN each dimension on its surrogate key.

    ``dims_bounded``: True when the star was built from validated data (the
    dimensions' sizes are proven by their domains); None checks each
    dimension's size before broadcasting it.
    """
    fact = encoded[layout.fact_table]
    for d in layout.dims:
        dim = encoded[d.table]
        small = dims_bounded if dims_bounded is not None else fits_broadcast(dim)
        if small:
            fact = fact.join(F.broadcast(dim), d.key, "inner")
        else:
            key = f"_v_{d.key}"
            fact = salted_join(fact, dim.withColumnRenamed(d.key, key), [(d.key, key)], "inner").drop(key)
    return fact


def analysis_view(encoded: dict[str, DataFrame], view_name: str | None = None,
                  dims_bounded: bool | None = None) -> DataFrame:
    """The labelled analysis view: 22 columns over the encoded star."""
    j = star_join(encoded, dims_bounded=dims_bounded)
    labels = [R.case_else_label(src, zero, other).alias(out)
              for out, (_, src, zero, other) in S.VIEW_FLAG_LABELS.items()]
    view = j.select(
        "record_id", "diabetes_status",
        R.case_label("diabetes_status", S.VIEW_STATUS_LABELS).alias("diabetes_label"),
        "bmi_value", "mental_health_days", "physical_health_days", "general_health_score",
        "sex", "age_group", "education_level", "income_bracket", *labels)
    if view_name:
        view.createOrReplaceTempView(view_name)
    return view


# A6 -------------------------------------------------------------------------
def table_counts(star: dict[str, DataFrame], layout: S.StarLayout = S.MAIN_STAR) -> DataFrame:
    """COUNT(*) of the fact and COUNT(DISTINCT key) of each dimension."""
    parts = [star[layout.fact_table].agg(F.lit(layout.fact_table).alias("table_name"),
                                          F.count(F.lit(1)).alias("n"))]
    for d in layout.dims:
        parts.append(star[d.table].agg(F.lit(d.table).alias("table_name"),
                                       F.countDistinct(d.key).alias("n")))
    return reduce(DataFrame.unionByName, parts)


# A7 -------------------------------------------------------------------------
def compression_ratio(star: dict[str, DataFrame], layout: S.StarLayout = S.MAIN_STAR) -> DataFrame:
    """One row: fact rows, dimension rows, fact / (fact + dimension rows)."""
    counts = reduce(DataFrame.unionByName, [
        star[t].agg(F.lit(t == layout.fact_table).alias("is_fact"), F.count(F.lit(1)).alias("n"))
        for t in layout.tables])
    agg = counts.groupBy().agg(
        F.sum(F.when(F.col("is_fact"), F.col("n")).otherwise(0)).cast("long").alias("fact_rows"),
        F.sum(F.when(~F.col("is_fact"), F.col("n")).otherwise(0)).cast("long").alias("dimension_rows"))
    return agg.withColumn("fact_share", F.col("fact_rows") /
                          (F.col("fact_rows") + F.col("dimension_rows")))


# V3 -------------------------------------------------------------------------
def db_stats(paths: dict[str, str], spark) -> DataFrame:
    """(table_name, row_count, size_mb, size_rank) of published parquet tables, most rows first.

    Rows by ``count``; size from the file-level ``_metadata.file_size`` of each
    distinct data file (no file is read twice, nothing goes through the driver).
    """
    parts = []
    for name, path in paths.items():
        t = spark.read.parquet(path)
        rows = t.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        size = (t.select("_metadata.file_path", "_metadata.file_size").distinct()
                 .agg(F.lit(name).alias("table_name"),
                      F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes")))
        parts.append(rows.join(size, "table_name"))
    stats = reduce(DataFrame.unionByName, parts)
    order = Window.orderBy(F.desc("row_count"), "table_name")  # one row per table
    return (stats.select("table_name", "row_count", R.size_mb("bytes").alias("size_mb"),
                         F.row_number().over(order).alias("position"))
                 .orderBy("position"))


def db_stats_report(paths: dict[str, str], spark) -> DataFrame:
    """``db_stats`` with its size held against the lengths that the file system lists."""
    listed = [(name, table_bytes(spark, path, ".parquet")) for name, path in paths.items()]
    own = spark.createDataFrame(listed, "table_name string, listed bigint")
    return (db_stats(paths, spark).join(own, "table_name")
            .select("table_name", "row_count", "position",
                    (F.col("size_mb") == R.size_mb("listed")).alias("size_as_listed")))


# L1 -------------------------------------------------------------------------
def head_sample(star: dict[str, DataFrame], layout: S.StarLayout = S.MAIN_STAR,
                n: int = 3) -> DataFrame:
    """The first ``n`` rows (by surrogate key) of every dimension, as text."""
    parts = []
    for d in layout.dims:
        t = star[d.table]
        parts.append(t.orderBy(d.key).limit(n).select(
            F.lit(d.table).alias("table_name"), F.col(d.key).cast("long").alias("key_id"),
            F.concat_ws("|", *[F.coalesce(F.col(o).cast("string"), F.lit("NULL"))
                               for o in d.outputs]).alias("row_text")))
    return reduce(DataFrame.unionByName, parts)
