"""Taking in yearly CSV files: one parse, headers per part file, rejected rows kept.

Every part file is read under the names on its own first line: files are
grouped by header, and each group is one scan with positional columns, so a
folder whose parts order their columns differently, or carry more of them, is
read right.  First lines are read through the file system, several at a time.

A row with more cells than its header makes its file malformed.  The scan says so
itself (its corrupt-record column), so the text is parsed once: ``take_in``
writes the selected columns to the checkpoint folder and counts rows and
rejects per year in that same write (``observe``).  A year with a reject is
skipped or raised, and its rejected lines can be queried.
"""

from __future__ import annotations

import csv
import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom import spec as S
from starloom.functions.recode import parse_number
from starloom.operators.numbering import BLOCK, FILE, POS, with_file_order
from starloom.session import reliable_checkpoint

log = logging.getLogger(__name__)

LINE = "_line"
_CORRUPT = "_corrupt_record"
#: First lines read at the same time.
READERS = 16


@dataclass
class Intake:
    """Accepted rows, rejected lines ``(file, block, DATA_YEAR, line)``, and (rows, rejects) by year."""

    rows: DataFrame
    rejected: DataFrame
    years: dict[int, tuple[int, int]]


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a CSV file or folder, by name; hidden and empty ones are left out."""
    p, fs = _path(spark, path)
    found = []
    for st in fs.listStatus(p):  # of a file: the file itself
        name = st.getPath().getName()
        if st.isFile() and st.getLen() > 0 and not name.startswith(("_", ".")):
            found.append(st.getPath().toString())
    return sorted(found)


def _first_line(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        if codec is not None:
            stream = codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip("\ufeff \t"):  # blank lines before the header
            line = reader.readLine()
    finally:
        stream.close()
    return None if line is None else tuple(c.strip() for c in next(csv.reader([line.lstrip("\ufeff")])))


def headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...] | None]:
    """The column names on each file's first line (None: no line)."""
    with ThreadPoolExecutor(READERS) as pool:
        return dict(zip(paths, pool.map(lambda p: _first_line(spark, p), paths)))


def _too_long(line: Column, cells: int) -> Column:
    """Whether a line has more than ``cells`` cells; one is appended, so that an empty last one shows."""
    schema = ", ".join(f"c{i} string" for i in range(cells + 2))
    return F.from_csv(F.concat(line, F.lit(",x")), schema)[f"c{cells + 1}"].isNotNull()


def scan_group(spark: SparkSession, paths: list[str], header: tuple[str, ...], spec: S.SurveySpec,
               keep: tuple[str, ...], file_order: bool = False, year: Column | None = None) -> DataFrame:
    """One scan over files of one header: keys, selected columns as double, and ``_line`` of a row too long."""
    from starloom.sources.files import select_features

    schema = ", ".join([*(f"c{i} string" for i in range(len(header))), f"{_CORRUPT} string"])
    raw = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _CORRUPT)
           .option("columnPruning", False)  # a pruning parser does not see a row's length
           .csv(paths))
    first = {name: i for i, name in reversed(list(enumerate(header)))}
    wanted = [c for c in (*keep, *spec.selected) if c in first]
    # always true; Spark refuses a scan that reads its corrupt-record column alone
    corrupt = F.when(F.col("c0").isNull() | (F.col("c0") >= ""), F.col(_CORRUPT))
    named = raw.select(
        *[F.col(f"c{first[c]}").alias(c) for c in wanted],
        F.when(corrupt.isNotNull() & _too_long(corrupt, len(header)), corrupt).alias(LINE),
        *([year.alias(spec.year_column)] if year is not None else []), F.col("_metadata"))
    extra = (LINE,) + ((spec.year_column,) if year is not None else ())
    if file_order:
        named = with_file_order(named)
        extra += (FILE, BLOCK)
    chosen = select_features(named, spec, keep + extra)
    return chosen.withColumns(
        {c: parse_number(c) for c in chosen.columns if c in spec.selected}
        | {k: F.col(k).cast("bigint") for k in keep if k in chosen.columns})


def scan_files(spark: SparkSession, paths: list[str], spec: S.SurveySpec, keep: tuple[str, ...],
               file_order: bool = False, year: Column | None = None) -> DataFrame:
    """All the files, one scan per distinct header; raises if a file has none or lacks the target."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in headers(spark, paths).items():
        if header is None:
            raise ValueError(f"{path} has no header")
        groups.setdefault(header, []).append(path)
    if not groups:
        raise ValueError("no file with a header")
    frames = [scan_group(spark, members, header, spec, keep, file_order, year) for header, members in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def refuse_long_rows(scan: DataFrame) -> DataFrame:
    """The scan's rows; reading a row with too many cells is an error."""
    fault = F.raise_error(F.concat(F.lit("row with more cells than the header: "), F.col(LINE)))
    return scan.where(F.when(F.col(LINE).isNotNull(), fault.cast("boolean")).otherwise(True)).drop(LINE)


def take_in(spark: SparkSession, years: dict[int, list[str]], spec: S.SurveySpec, keep: tuple[str, ...],
            year: Column, strict: bool = False, strict_header: bool = False, allow_none: bool = False) -> Intake:
    """Read the files of some years once; malformed years are skipped with a warning, or raised (``strict``).

    A year is malformed when one of its files has no header or lacks the
    target (``strict_header`` always raises these), or has a row with more cells
    than its header; missing cells are nulls.  That no year is left raises,
    unless ``allow_none``.
    What is kept lies in the checkpoint folder, every row with its file, file
    block and position, so the order of the files is not lost.
    """
    found = headers(spark, [p for paths in years.values() for p in paths])
    good: dict[int, list[str]] = {}
    for y, paths in years.items():
        try:
            if not paths:
                raise ValueError("no data")
            for header in {found[p] for p in paths}:
                if header is None or (spec.target and spec.target not in header):
                    raise ValueError(f"a file has no target column {spec.target!r}")
            good[y] = paths
        except ValueError as e:
            if strict or strict_header:
                raise ValueError(f"{y}: {e}") from e
            log.warning("year %s skipped: %s", y, e)
    if not good:
        raise RuntimeError("no yearly dataset could be loaded")
    groups: dict[tuple, list[str]] = {}
    for paths in good.values():
        for p in paths:
            groups.setdefault(found[p], []).append(p)
    scans = [scan_group(spark, members, header, spec, keep, True, year) for header, members in groups.items()]
    scan = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    seen = Observation("intake")
    of = {y: F.col(spec.year_column) == y for y in good}
    staged = reliable_checkpoint(
        scan.withColumn(POS, F.monotonically_increasing_id()).observe(
            seen, *[F.count_if(is_y).alias(f"n{y}") for y, is_y in of.items()],
            *[F.count_if(is_y & F.col(LINE).isNotNull()).alias(f"r{y}") for y, is_y in of.items()]), "intake")
    counts = {y: (seen.get[f"n{y}"], seen.get[f"r{y}"]) for y in good}
    bad = [y for y, (_, rejects) in counts.items() if rejects]
    if bad and strict:
        raise ValueError(f"rows with more cells than the header: { {y: counts[y][1] for y in bad} }")
    for y in bad:
        log.warning("year %s skipped: %s rows have too many cells", y, counts[y][1])
    if len(bad) == len(counts) and not allow_none:
        raise RuntimeError("no yearly dataset could be loaded")
    rows = staged.where(~F.col(spec.year_column).isin(bad)) if bad else staged
    rejected = staged.where(F.col(LINE).isNotNull()).select(
        F.col(FILE).alias("file"), F.col(BLOCK).alias("block"), spec.year_column, F.col(LINE).alias("line"))
    return Intake(rows.drop(LINE), rejected, counts)
