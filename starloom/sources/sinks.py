"""Sinks: parquet stages (S6), CSV tables (S7), JDBC (S8, S10), the star
publish (S9) and load verification (S11); load-time casts (P7, P8).

Spark has no multi-table transaction.  ``publish_star`` gives the next best
thing: all tables are written once, under a new version directory, with their
constraints counted during that write, and only then does a small pointer file
make that version current.  Pointers are numbered and never replaced: each is
created exclusively under the next free number, and readers take the highest
complete one.  A failure before that leaves the previous version current, and at
no time is none.
"""

from __future__ import annotations

import logging
import re
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom import spec as S

log = logging.getLogger(__name__)


# S6 -------------------------------------------------------------------------
def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a stage hand-off as parquet and return the re-read table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


# S7 -------------------------------------------------------------------------
def write_csv_tables(tables: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """One header CSV (Spark directory) per table; returns the paths."""
    paths = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}.csv"
        df.write.mode("overwrite").option("header", True).csv(path)
        log.info("saved %s", name)
        paths[name] = path
    return paths


# P7 -------------------------------------------------------------------------
def fill_zero(df: DataFrame) -> DataFrame:
    """Every null -> 0 before insert: numbers get 0, text gets "0"."""
    return df.na.fill(0).na.fill("0")


# P8 -------------------------------------------------------------------------
def spark_type(sql_type: str) -> str:
    return "string" if sql_type.startswith("varchar") else sql_type


def load_casts(df: DataFrame, types: dict[str, str], strict: bool = True) -> DataFrame:
    """Cast to the stored types; what does not fit is an error (decimal overflow
    under ANSI mode), or null without ``strict``."""
    def stored(c: str):
        if c not in types:
            return F.col(c)
        return F.col(c).cast(spark_type(types[c])) if strict else F.col(c).try_cast(spark_type(types[c]))
    return df.select(*[stored(c).alias(c) for c in df.columns])


def cast_star(star: dict[str, DataFrame], types: dict = S.LOAD_TYPES) -> dict[str, DataFrame]:
    return {t: load_casts(df, types.get(t, {})) for t, df in star.items()}


# S8 / S10 -------------------------------------------------------------------
def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, column_types: dict[str, str] | None = None,
               batchsize: int = 10_000, num_partitions: int | None = None,
               fill_nulls: bool = True) -> bool:
    """Insert all rows through JDBC; an empty frame is not appended, with a warning.

    ``mode="overwrite"`` drops and re-creates the table with ``column_types``
    (S10), also for an empty frame, so no old row survives; ``num_partitions``
    caps concurrent connections.
    """
    if mode != "overwrite" and df.isEmpty():
        log.warning("no data to load for table %s", table)
        return False
    out = fill_zero(df) if fill_nulls else df
    w = out.write.mode(mode).option("batchsize", batchsize)
    if num_partitions:
        # the JDBC writer coalesces to this many connections only if above it
        w = w.option("numPartitions", num_partitions)
    if column_types:
        w = w.option("createTableColumnTypes",
                     ", ".join(f"{c} {t.upper()}" for c, t in column_types.items()))
    w.jdbc(url, table, properties=properties or {})
    return True


def _stamped(df: DataFrame, created_at: bool) -> DataFrame:
    if not created_at:
        return df
    from starloom.operators.quality import with_created_at
    return with_created_at(df)


def jdbc_load_star(star: dict[str, DataFrame], url: str, layout: S.StarLayout = S.MAIN_STAR,
                   properties: dict | None = None, recreate: bool = True,
                   types: dict = S.LOAD_TYPES, created_at: bool = False,
                   check: bool = True, num_partitions: int | None = 8) -> None:
    """Load a star with all tables or none; with ``recreate`` the tables are re-made.

    The constraints are checked first (so NOT NULL is judged before the zero
    fill of the insert); ``created_at`` adds the load timestamp column (K6).
    Tasks commit their own rows, so they load side tables; when all are
    complete one transaction on one connection moves them over, and a failure
    before its commit leaves the live tables as they were.
    """
    spark = next(iter(star.values())).sparkSession
    if check:
        from starloom.operators.quality import check_star

        if not check_star(star, layout, types).isEmpty():
            raise ValueError("star failed its constraints; nothing loaded")
    side = {name: f"load_{uuid.uuid4().hex[:8]}_{name}"[:60] for name in layout.tables}
    columns = {}
    try:
        for name in layout.tables:
            rows = _stamped(load_casts(star[name], types.get(name, {})), created_at)
            ddl = {c: t for c, t in types.get(name, {}).items() if c in star[name].columns}
            columns[name] = rows.columns
            if recreate:  # the live table's form, without rows; dropped rows are part of the move
                _ensure_table(spark, rows, url, name, properties, ddl)
            jdbc_write(rows, url, side[name], mode="overwrite", properties=properties,
                       column_types=ddl, num_partitions=num_partitions)
        move = []
        for name in layout.tables:
            cols = ", ".join(f'"{c}"' for c in columns[name])
            if recreate:
                move.append(f"DELETE FROM {name}")
            move.append(f"INSERT INTO {name} ({cols}) SELECT {cols} FROM {side[name]}")
        _transaction(spark, url, properties, move)
    finally:
        _transaction(spark, url, properties, [f"DROP TABLE {t}" for t in side.values()], strict=False)


def _connect(spark: SparkSession, url: str, properties: dict | None):
    jvm = spark.sparkContext._jvm
    own = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        own.setProperty(k, v)
    if "driver" in (properties or {}):
        jvm.java.lang.Class.forName(properties["driver"])
    return jvm.java.sql.DriverManager.getConnection(url, own)


def _transaction(spark: SparkSession, url: str, properties: dict | None, statements: list[str],
                 strict: bool = True) -> None:
    """The statements on one connection: all committed, or (``strict``) none."""
    con = _connect(spark, url, properties)
    try:
        con.setAutoCommit(not strict)
        for sql in statements:
            try:
                con.createStatement().executeUpdate(sql)
            except Exception:
                if strict:
                    con.rollback()
                    raise
        if strict:
            con.commit()
    finally:
        con.close()


def _ensure_table(spark: SparkSession, rows: DataFrame, url: str, name: str,
                  properties: dict | None, ddl: dict[str, str]) -> None:
    """Create the live table, empty, where it is missing."""
    con = _connect(spark, url, properties)
    try:
        meta = con.getMetaData()
        there = any(meta.getTables(None, None, n, None).next() for n in (name, name.upper()))
    finally:
        con.close()
    if not there:
        jdbc_write(rows.limit(0), url, name, mode="overwrite", properties=properties, column_types=ddl)


def jdbc_counts(spark: SparkSession, url: str, tables: list[str],
                properties: dict | None = None) -> DataFrame:
    """S11 over JDBC: each table's row count, counted by the database."""
    parts = [spark.read.jdbc(url, f"(SELECT COUNT(*) AS N FROM {t}) c", properties=properties or {})
             .select(F.lit(t).alias("table_name"), F.col("N").cast("long").alias("row_count"))
             for t in tables]
    return reduce(DataFrame.unionByName, parts)


# S9 -------------------------------------------------------------------------
POINTER = "_CURRENT"
_POINTERS = re.compile(rf"^{POINTER}-([0-9]+)$")


def _files(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, root: str) -> list[int]:
    p, fs = _files(spark, root)
    if not fs.exists(p):
        return []
    found = (_POINTERS.match(st.getPath().getName()) for st in fs.listStatus(p))
    return sorted(int(m.group(1)) for m in found if m)


def _point_to(spark: SparkSession, root: str, version: str, attempts: int = 100) -> None:
    """Make ``version`` current: the next free pointer number, created exclusively."""
    for _ in range(attempts):
        n = max(_pointers(spark, root), default=0) + 1
        target, fs = _files(spark, f"{root}/{POINTER}-{n:012d}")
        try:
            out = fs.create(target, False)
        except Py4JJavaError:
            if not fs.exists(target):
                raise
            continue  # another publisher took this number
        out.write(bytearray((version + "\n").encode("utf-8")))
        out.close()
        return
    raise RuntimeError(f"version {version} could not be made current under {root}")


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _files(spark, path)
    reader = spark.sparkContext._jvm.java.io.BufferedReader(
        spark.sparkContext._jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    line = reader.readLine()
    reader.close()
    return line


def write_checked(df: DataFrame, columns: list[str], path: str, table: str, checks: dict[tuple[str, str], Column],
                   types: dict[str, str], created_at: bool) -> dict[tuple[str, str, str], int]:
    """Write a table in its stored types, once; violations of each check counted in that write."""
    seen = Observation(f"checks of {table}")
    counted = [F.count(c).alias(f"v{i}") for i, c in enumerate(checks.values())] or [F.count(F.lit(1)).alias("n")]
    stored = load_casts(df.observe(seen, *counted).select(*columns), types, strict=not checks)
    _stamped(stored, created_at).write.mode("overwrite").parquet(path)
    return {(k[0], table, k[1]): seen.get[f"v{i}"] for i, k in enumerate(checks) if seen.get[f"v{i}"]}


def publish_star(star: dict[str, DataFrame], root: str, layout: S.StarLayout = S.MAIN_STAR,
                 check: bool = True, types: dict = S.LOAD_TYPES,
                 version: str | None = None, created_at: bool = False) -> dict[str, str]:
    """Write dims then fact under a new version, checking them on the way, and switch the pointer.

    Every table is written once.  NOT NULL, ranges and fits-the-type are
    counted on the rows as built, foreign keys by probing the written
    dimensions' keys, all in the write itself; what does not fit its stored type
    is written as null in a version that is then refused.  Key uniqueness is
    proved from the written keys alone (``quality.unique_in_runs``).  Raises,
    leaving the previous version current and this one removed, if any
    constraint fails.
    """
    from starloom.operators import quality as Q

    spark = next(iter(star.values())).sparkSession
    root = root.rstrip("/")
    version = version or uuid.uuid4().hex[:12]
    if not re.fullmatch(r"[0-9A-Za-z_-]+", version):
        raise ValueError("bad version name")
    paths = {name: f"{root}/v={version}/{name}" for name in layout.tables}
    found: dict[tuple[str, str, str], int] = {}
    keys = {d.table: d.key for d in layout.dims} | {layout.fact_table: layout.record_key}
    written: dict[str, DataFrame] = {}
    for name in layout.tables:  # dims first
        df, checks = star[name], {}
        if check:
            checks = Q.named_row_checks(df, types.get(name, {}), *(
                (S.RANGE_CHECKS, "diabetes_status") if name == layout.fact_table else ()))
        columns = df.columns
        if check and name == layout.fact_table:
            df, more, late = Q.probed_foreign_keys(df, [(d.key, written[d.table], d.key) for d in layout.dims])
            checks |= more
        found |= write_checked(df, columns, paths[name], name, checks, types.get(name, {}), created_at)
        written[name] = spark.read.parquet(paths[name])
        if check and not Q.unique_in_runs(written[name].select(keys[name]), keys[name]):
            found["unique_key", name, keys[name]] = Q.unique_key(written[name], name, keys[name]).count()
        if check and name == layout.fact_table and late:
            for r in Q.foreign_keys(written[name], name, layout.record_key, late, False) \
                    .groupBy("column_name").count().collect():
                found["foreign_key", name, r["column_name"]] = r["count"]
    if found:
        p, fs = _files(spark, f"{root}/v={version}")
        fs.delete(p, True)
        raise ValueError(f"star failed its constraints; version {version} not published: "
                         + ", ".join(f"{c} {t}.{col}: {n}" for (c, t, col), n in sorted(found.items())))
    _point_to(spark, root, version)
    return paths


def published_paths(spark: SparkSession, root: str, layout: S.StarLayout = S.MAIN_STAR) -> dict[str, str]:
    root = root.rstrip("/")
    for n in reversed(_pointers(spark, root)):
        version = _read_text(spark, f"{root}/{POINTER}-{n:012d}")
        if version:  # a pointer whose publisher died before writing it names none
            return {t: f"{root}/v={version}/{t}" for t in layout.tables}
    raise FileNotFoundError(f"nothing published under {root}")


def read_published(spark: SparkSession, root: str, layout: S.StarLayout = S.MAIN_STAR) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(p) for n, p in published_paths(spark, root, layout).items()}


# S11 ------------------------------------------------------------------------
def verify_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every stored table, one small job each."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()])
