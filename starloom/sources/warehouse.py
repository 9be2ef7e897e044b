"""The star as tables of Spark's own catalog: re-created by DDL (S10), loaded in
repeatable appends (S8, S9).

``recreate_tables`` drops the fact first and creates the dimensions first, in
their stored types; keys and references are table properties, since file tables
enforce none, and every load checks them.  Tables are partitioned by load.

``load_star`` adds one load to all tables or to none.  Files are written once,
into folders that no table knows yet, with their constraints counted in that
write; then the folders become partitions; the load's partition in the ledger,
added last by one catalog call, is its commit.  ``loaded`` reads the committed
loads alone.  So a load that died half-way shows in no table, running it again
replaces its folders, and running a committed one again adds nothing.  One
writer at a time per database, as with any catalog without transactions.
"""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import spec as S
from starloom.functions.recode import quote
from starloom.operators import quality as Q
from starloom.session import local_table, remove_table
from starloom.sources import sinks as SK

log = logging.getLogger(__name__)

LEDGER = "load_ledger"
LOAD = "load_id"
PRIMARY, REFERENCES = "primary_key", "references."
_NAME = re.compile(r"[0-9A-Za-z_]+")


def _checked_name(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"bad name {name!r}: letters, digits and underscores only")
    return name


def types_of(star: dict[str, DataFrame]) -> dict[str, dict[str, str]]:
    """The types a star has as built, for layouts without fixed ones."""
    return {t: {f.name: f.dataType.simpleString() for f in df.schema} for t, df in star.items()}


# S10 ------------------------------------------------------------------------
def recreate_tables(spark: SparkSession, database: str, layout: S.StarLayout = S.MAIN_STAR,
                    types: dict = S.LOAD_TYPES, location: str | None = None, created_at: bool = False) -> None:
    """Drop the star's tables, rows and layout included, and create them empty.

    The database is created if missing, under ``location`` or in the
    warehouse.  The ledger goes first, so a failure between the drops leaves no
    load that looks committed.
    """
    db = _checked_name(database)
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{at}")
    for t in (LEDGER, *reversed(layout.tables)):
        spark.sql(f"DROP TABLE IF EXISTS {db}.{_checked_name(t)}")
    for d in layout.dims:
        _create(spark, f"{db}.{d.table}", types[d.table], {PRIMARY: d.key}, created_at)
    _create(spark, f"{db}.{layout.fact_table}", types[layout.fact_table],
            {PRIMARY: layout.record_key} | {f"{REFERENCES}{d.key}": f"{d.table}.{d.key}" for d in layout.dims}, created_at)
    _create(spark, f"{db}.{LEDGER}", {"table_name": "string", "row_count": "bigint", "min_key": "bigint",
                                      "max_key": "bigint"}, {}, False)


def _create(spark: SparkSession, table: str, types: dict[str, str], properties: dict[str, str], created_at: bool) -> None:
    columns = [f"{quote(c)} {t}" for c, t in types.items()] + (["created_at timestamp"] if created_at else [])
    kept = ", ".join(f"'starloom.{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}, {LOAD} string) USING parquet PARTITIONED BY ({LOAD})"
              + (f" TBLPROPERTIES ({kept})" if kept else ""))


def declared_keys(spark: SparkSession, database: str, table: str) -> tuple[str | None, dict[str, tuple[str, str]]]:
    """(primary key, {column: (table, column it references)}) as created."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {_checked_name(database)}.{_checked_name(table)}").collect()
    own = {r["key"].removeprefix("starloom."): r["value"] for r in rows if r["key"].startswith("starloom.")}
    return own.get(PRIMARY), {k.removeprefix(REFERENCES): tuple(v.split(".")) for k, v in own.items()
                              if k.startswith(REFERENCES)}


def table_columns(spark: SparkSession, database: str, tables: list[str]) -> DataFrame:
    """(table_name, position, column_name, data_type, key_role) as the catalog has them, one row per column."""
    rows = []
    for t in tables:
        primary, refs = declared_keys(spark, database, t)
        named = spark.sql(f"DESCRIBE TABLE {_checked_name(database)}.{t}").collect()
        for i, r in enumerate(named, 1):
            if r["col_name"] == LOAD or not r["col_name"] or r["col_name"].startswith("#"):
                break  # the load column ends the table's own
            role = "primary key" if r["col_name"] == primary else \
                "references " + ".".join(refs[r["col_name"]]) if r["col_name"] in refs else ""
            rows.append((t, i, r["col_name"], r["data_type"], role))
    return local_table(spark, rows, "table_name string, position int, column_name string, data_type string, "
                                    "key_role string")


# S8 / S9 --------------------------------------------------------------------
def committed(spark: SparkSession, database: str) -> list[str]:
    """Ids of the committed loads, from the ledger's partitions: no scan."""
    parts = spark.sql(f"SHOW PARTITIONS {_checked_name(database)}.{LEDGER}").collect()
    return [r[0].removeprefix(f"{LOAD}=") for r in parts]


def loaded(spark: SparkSession, database: str, table: str, with_load: bool = False) -> DataFrame:
    """The committed rows of a table; loads that never committed are pruned by partition."""
    rows = spark.table(f"{_checked_name(database)}.{_checked_name(table)}") \
        .where(F.col(LOAD).isin(committed(spark, database)))
    return rows if with_load else rows.drop(LOAD)


def _folder(spark: SparkSession, database: str, table: str, load_id: str) -> str:
    at = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{table}").collect()
              if r["col_name"] == "Location")
    return f"{at.rstrip('/')}/{LOAD}={load_id}"


def _add(spark: SparkSession, database: str, table: str, load_id: str) -> None:
    spark.sql(f"ALTER TABLE {database}.{table} ADD IF NOT EXISTS PARTITION ({LOAD} = '{load_id}')")


def _repeated_keys(spark: SparkSession, database: str, table: str, key: str, new: DataFrame,
                   lo: int, hi: int) -> int:
    """Keys of a load that a committed one holds already.

    The ledger has each load's key range, so a load of new ids reads no other
    one; where ranges overlap only those loads' keys inside the range are read.
    """
    over = [r[LOAD] for r in loaded(spark, database, LEDGER, True)
            .where((F.col("table_name") == table) & (F.col("min_key") <= hi) & (F.col("max_key") >= lo))
            .select(LOAD).collect()]  # one row per load
    if not over:
        return 0
    old = spark.table(f"{database}.{table}").where(F.col(LOAD).isin(over) & F.col(key).between(lo, hi)).select(key)
    return new.select(key).join(old, key, "left_semi").count()


def load_star(star: dict[str, DataFrame], database: str, load_id: str, layout: S.StarLayout = S.MAIN_STAR,
              types: dict = S.LOAD_TYPES, check: bool = True, fill_nulls: bool = True, created_at: bool = False) -> bool:
    """Append a star as one load, to all tables or none; False if it is committed already.

    A table that ``star`` lacks, or without rows, gets nothing, with a warning.
    Foreign keys may point to dimension rows of this load or of committed
    ones; primary keys must be new.  With ``check`` any violation raises and
    nothing is loaded; without, nulls are zeroed first (``fill_nulls``), so a
    null never passes the check as a zero.
    """
    spark = next(iter(star.values())).sparkSession
    db, load = _checked_name(database), _checked_name(load_id)
    if load in committed(spark, db):
        log.warning("load %s is committed already; nothing loaded", load)
        return False
    found: dict[tuple[str, str, str], int] = {}
    written: dict[str, DataFrame] = {}
    folders, entries = {}, []
    for name in [t for t in layout.tables if t in star]:  # dims first
        df, stored = star[name], types.get(name, {})
        key, references = declared_keys(spark, db, name)
        columns, checks, late = df.columns, {}, []
        if check:
            checks = Q.named_row_checks(df, stored, *(
                (S.RANGE_CHECKS, "diabetes_status") if name == layout.fact_table else ()))
            refs = []
            for column, (dim, dim_key) in references.items():
                keys = loaded(spark, db, dim).select(dim_key)
                refs.append((column, keys.unionByName(written[dim].select(dim_key)) if dim in written else keys, dim_key))
            if refs:
                df, more, late = Q.probed_foreign_keys(df, refs)
                checks |= more
        elif fill_nulls:
            df = SK.fill_zero(df)
        path = folders[name] = _folder(spark, db, name, load)
        found |= SK.write_checked(df, columns, path, name, checks, stored, created_at)
        rows = written[name] = spark.read.parquet(path)
        n, lo, hi = rows.agg(F.count(F.lit(1)), F.min(key).cast("long"), F.max(key).cast("long")).first()
        entries.append((name, n, lo, hi))
        if not n:
            log.warning("no data to load for table %s", name)
        elif check:
            repeated = 0 if Q.unique_in_runs(rows.select(key), key) else Q.unique_key(rows, name, key).count()
            repeated += _repeated_keys(spark, db, name, key, rows, lo, hi) if lo is not None else 0
            if repeated:
                found["unique_key", name, key] = repeated
        for r in (Q.foreign_keys(rows, name, key, late, False).groupBy("column_name").count().collect() if late else ()):
            found["foreign_key", name, r["column_name"]] = r["count"]
    if found:
        for path in folders.values():
            remove_table(spark, path)
        raise ValueError(f"load {load} failed its constraints; nothing loaded: "
                         + ", ".join(f"{c} {t}.{col}: {n}" for (c, t, col), n in sorted(found.items())))
    for name, n, _, _ in entries:
        if n:
            _add(spark, db, name, load)
    ledger = _folder(spark, db, LEDGER, load)
    local_table(spark, entries, "table_name string, row_count long, min_key long, max_key long") \
        .coalesce(1).write.mode("overwrite").parquet(ledger)
    _add(spark, db, LEDGER, load)
    return True


def verify_loads(spark: SparkSession, database: str, layout: S.StarLayout = S.MAIN_STAR) -> DataFrame:
    """S11 by load: (table_name, load_id, row_count, ledger_count), the ledger's count beside the table's own."""
    parts = [loaded(spark, database, t, True).groupBy(LOAD).agg(F.count(F.lit(1)).alias("row_count"))
             .withColumn("table_name", F.lit(t)) for t in layout.tables]
    counted = parts[0]
    for p in parts[1:]:
        counted = counted.unionByName(p)
    said = loaded(spark, database, LEDGER, True).select("table_name", LOAD, F.col("row_count").alias("ledger_count"))
    return said.join(counted, ["table_name", LOAD], "left").select(
        "table_name", LOAD, F.coalesce("row_count", F.lit(0)).alias("row_count"), "ledger_count")
