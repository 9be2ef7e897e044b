"""File sources: yearly survey CSVs (S1-S5), feature selection (P1), year tag
and the multi-year union (U1).

CSV cells are read as text and parsed with ``parse_number`` (trim, missing-
value tokens -> null, ``try_cast``), so every numeric column is a double no
matter how a given year's file spells its blanks.  Year discovery lists the
directory through the Hadoop FileSystem of the path (works for HDFS/S3/local)
and only touches file metadata on the driver.
"""

from __future__ import annotations

import logging
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import spec as S
from starloom.functions.recode import parse_number
from starloom.operators.numbering import BLOCK, FILE, POS, has_file_order, with_file_order
from starloom.sources.intake import Intake, part_files, refuse_long_rows, scan_files, take_in

log = logging.getLogger(__name__)

# a yearly file is ``<year>.csv`` (file or Spark-written folder) or a
# ``DATA_YEAR=<year>`` partition folder of one partitioned write
YEAR_FILE = re.compile(r"^(?:([0-9]+)\.csv|DATA_YEAR=([0-9]+))$")
KEY_COLUMNS = ("row_key",)
ORDER_COLUMNS = (FILE, BLOCK, POS)


# P1 -------------------------------------------------------------------------
def select_features(df: DataFrame, spec: S.SurveySpec = S.SURVEY,
                    keep: tuple[str, ...] = KEY_COLUMNS) -> DataFrame:
    """Keep the spec's columns that exist, in spec order (plus key columns).

    Errors when none exists or the target is missing; warns on the others.
    """
    have = set(df.columns)
    available = [c for c in spec.selected if c in have]
    missing = [c for c in spec.selected if c not in have]
    if not available:
        raise ValueError("none of the survey columns is in the table")
    if spec.target and spec.target not in available:
        raise ValueError(f"target column {spec.target!r} is missing")
    if missing:
        log.warning("missing survey columns: %s", missing)
    keys = [k for k in keep if k in have and k not in available]
    return df.select(*keys, *available)


# S1 -------------------------------------------------------------------------
def csv_scan(spark: SparkSession, path: str, spec: S.SurveySpec = S.SURVEY,
             keep: tuple[str, ...] = KEY_COLUMNS, file_order: bool = False) -> DataFrame:
    """Header CSV -> selected survey columns as double (+ key columns).

    Each part file is read under its own header.  ``file_order`` adds each
    row's file and file block, the order in which files without a key column
    are numbered.  A row with more cells than the header fails the read.
    """
    files = part_files(spark, path)
    if not files:
        raise ValueError(f"no data in {path}")
    return refuse_long_rows(scan_files(spark, files, spec, keep, file_order))


# S2 -------------------------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def year_files(spark: SparkSession, data_dir: str) -> dict[int, str]:
    """Yearly entries of a directory: ``<digits>.csv`` files or Spark-written
    folders, and ``DATA_YEAR=<digits>`` partition folders."""
    p, fs = _fs(spark, data_dir)
    if not fs.exists(p):
        raise FileNotFoundError(f"data directory not found: {data_dir}")
    found = {}
    for st in fs.listStatus(p):
        m = YEAR_FILE.match(st.getPath().getName())
        if m:
            found[int(m.group(1) or m.group(2))] = st.getPath().toString()
    if not found:
        raise FileNotFoundError(f"no <year>.csv files in {data_dir}")
    return dict(sorted(found.items()))


# U1 -------------------------------------------------------------------------
YEAR_IN_PATH = r"(?:^|/)(?:([0-9]+)\.csv|DATA_YEAR=([0-9]+))(?:/|$)"


def year_from(path: Column) -> Column:
    """The year that a path column names."""
    return F.coalesce(F.nullif(F.regexp_extract(path, YEAR_IN_PATH, 1), F.lit("")),
                      F.nullif(F.regexp_extract(path, YEAR_IN_PATH, 2), F.lit(""))).cast("int")


def year_of_path(path: str) -> int | None:
    """The year that a path names (``<year>.csv`` or ``DATA_YEAR=<year>``)."""
    m = re.search(YEAR_IN_PATH, path)
    return int(m.group(1) or m.group(2)) if m else None


def take_in_years(spark: SparkSession, data_dir: str, spec: S.SurveySpec = S.SURVEY,
                  years: list[int] | None = None, strict: bool = False) -> Intake:
    """The yearly files of a folder, parsed once: rows, rejected lines, counts by year."""
    files = {y: p for y, p in year_files(spark, data_dir).items() if years is None or y in set(years)}
    return take_in(spark, {y: part_files(spark, p) for y, p in files.items()}, spec, KEY_COLUMNS,
                   year_from(F.col("_metadata.file_path")), strict)


def _without_order(rows: DataFrame, file_order: bool) -> DataFrame:
    return rows if file_order else rows.drop(*ORDER_COLUMNS)


def union_years(spark: SparkSession, data_dir: str, spec: S.SurveySpec = S.SURVEY,
                years: list[int] | None = None, file_order: bool = False,
                check_rows: bool = True) -> DataFrame:
    """All yearly files appended, ``DATA_YEAR`` added, missing columns null.

    Files that share a header are read in ONE scan, with the year taken from
    each row's file path (``_metadata.file_path``).  A year that lacks the
    target or has a row with too many cells is skipped with a warning; when no
    year is left the call raises.  The rows are written once on the way
    (``take_in``), with their rejects counted; ``check_rows=False`` gives the
    plain scans instead, where a row with too many cells fails the read.
    """
    if check_rows:
        return _without_order(take_in_years(spark, data_dir, spec, years).rows, file_order)
    files = {y: p for y, p in year_files(spark, data_dir).items() if years is None or y in set(years)}
    frames = []
    for y, path in files.items():
        try:
            frames.append(scan_files(spark, part_files(spark, path), spec, KEY_COLUMNS, file_order,
                                     year_from(F.col("_metadata.file_path"))))
        except ValueError as e:
            log.warning("year %s skipped: %s", y, e)
    if not frames:
        raise RuntimeError("no yearly dataset could be loaded")
    return refuse_long_rows(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames))


# S3 -------------------------------------------------------------------------
def bounded_scan(df: DataFrame, n: int, order_key: str | None = None) -> DataFrame:
    """The first ``n`` rows (a plain ``limit`` has no order): by key, or in file order.

    Planned as TakeOrderedAndProject: a per-partition top-n, then a merge of
    n rows per partition; the input is never fully sorted.
    """
    if order_key is None and "row_key" not in df.columns and has_file_order(df):
        if POS in df.columns:
            return df.orderBy(FILE, BLOCK, POS).limit(n)
        at = "_at"  # rows of a block keep their order inside the task that reads it
        return (df.withColumn(at, F.monotonically_increasing_id())
                .orderBy(FILE, BLOCK, at).limit(n).drop(at))
    return df.orderBy(F.col(order_key or "row_key").asc_nulls_first()).limit(n)


# S4 -------------------------------------------------------------------------
def single_year(spark: SparkSession, data_dir: str, year: int, spec: S.SurveySpec = S.SURVEY,
                file_order: bool = False, check_rows: bool = True) -> DataFrame:
    """Only ``<year>.csv``; an absent file or a row with too many cells is an error."""
    files = year_files(spark, data_dir)
    if year not in files:
        raise FileNotFoundError(f"{year}.csv not found in {data_dir}")
    if not check_rows:
        return csv_scan(spark, files[year], spec, file_order=file_order)
    rows = take_in_years(spark, data_dir, spec, [year], strict=True).rows
    return _without_order(rows.drop(spec.year_column), file_order)


# S5 -------------------------------------------------------------------------
CLEAN_SCHEMA = ("row_key bigint, diabetes_status string, HighBP string, HighChol string, "
                "CholCheck string, Smoker string, Stroke string, HeartDiseaseorAttack string, "
                "PhysActivity string, Fruits string, Veggies string, HvyAlcoholConsump string, "
                "AnyHealthcare string, NoDocbcCost string, DiffWalk string, BMI double, "
                "GenHlth double, MentHlth double, PhysHlth double, Sex string, Age double, "
                "Education double, Income double")


def dataset_scan(spark: SparkSession, path: str, schema: str = CLEAN_SCHEMA,
                 file_order: bool = False) -> DataFrame:
    """Re-read a processed (clean) CSV: columns matched by header name, typed by ``schema``.

    Key columns may be missing; ``file_order`` then gives the rows their order.

    No type inference pass over the data; numbers go through ``parse_number``
    so blank and missing-value tokens become null.
    """
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema).fields
    text = spark.read.option("header", True).csv(path)
    fields = [f for f in fields if f.name in text.columns or f.name not in KEY_COLUMNS]
    missing = [f.name for f in fields if f.name not in text.columns]
    if missing:
        raise ValueError(f"columns missing from {path}: {missing}")
    cols = []
    for f in fields:
        t = f.dataType.simpleString()
        if t == "string":
            cols.append(F.col(f.name))
        elif t in ("double", "float"):
            cols.append(parse_number(f.name).cast(t).alias(f.name))
        else:
            cols.append(F.trim(F.col(f.name)).try_cast(t).alias(f.name))
    if file_order:
        text = with_file_order(text)
        cols += [F.col(FILE), F.col(BLOCK)]
    return text.select(*cols)


def write_year_files(df: DataFrame, data_dir: str, year_col: str = S.YEAR_COLUMN) -> None:
    """Lay a table carrying a year out as yearly CSV folders (header on).

    One partitioned write (``DATA_YEAR=<year>`` folders, no year column in the
    files), written by all tasks in parallel; ``year_files`` discovers them.
    """
    df.write.mode("overwrite").option("header", True).partitionBy(year_col).csv(data_dir)
