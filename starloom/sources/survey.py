"""Input tables.

``read_table`` reads one of the given parquet tables, projecting only the
columns asked for so the scan's ReadSchema stays narrow.  ``derived_survey``
turns ``orders`` into a coded health survey with the fixture SQL shared by the
Spark side and the SQL oracle (one row per order, ``row_key`` = order key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Fixture SQL (fixed text, shared verbatim with the oracle).  ``{orders}`` is
# the orders relation.
DERIVED_SURVEY_SQL = """\
SELECT o_orderkey AS row_key,
       CAST(CASE WHEN ((o_orderkey * 3 + o_custkey * 7) % 97) < 2 THEN NULL WHEN ((o_orderkey * 3 + o_custkey * 7) % 97) < 4 THEN 9 WHEN ((o_orderkey * 3 + o_custkey * 7) % 97) < 6 THEN 4 WHEN ((o_orderkey * 3 + o_custkey * 7) % 97) < 20 THEN 1 WHEN ((o_orderkey * 3 + o_custkey * 7) % 97) < 26 THEN 2 ELSE 3 END AS DOUBLE) AS DIABETE3,
       CAST(CASE WHEN ((o_orderkey * 7 + o_custkey * 11) % 101) < 1 THEN NULL WHEN ((o_orderkey * 7 + o_custkey * 11) % 101) < 2 THEN 9 WHEN ((o_orderkey * 7 + o_custkey * 11) % 101) < 20 THEN 1 ELSE 2 END AS DOUBLE) AS _RFHYPE5,
       CAST(CASE WHEN ((o_orderkey * 11 + o_custkey * 15) % 103) < 1 THEN NULL WHEN ((o_orderkey * 11 + o_custkey * 15) % 103) < 2 THEN 9 WHEN ((o_orderkey * 11 + o_custkey * 15) % 103) < 23 THEN 1 ELSE 2 END AS DOUBLE) AS TOLDHI2,
       CAST(CASE WHEN ((o_orderkey * 13 + o_custkey * 17) % 107) < 1 THEN NULL WHEN ((o_orderkey * 13 + o_custkey * 17) % 107) < 2 THEN 9 WHEN ((o_orderkey * 13 + o_custkey * 17) % 107) < 26 THEN 1 ELSE 2 END AS DOUBLE) AS _CHOLCHK,
       CAST(CASE WHEN ((o_orderkey * 17 + o_custkey * 21) % 109) < 1 THEN NULL WHEN ((o_orderkey * 17 + o_custkey * 21) % 109) < 2 THEN 9 WHEN ((o_orderkey * 17 + o_custkey * 21) % 109) < 29 THEN 1 ELSE 2 END AS DOUBLE) AS SMOKE100,
       CAST(CASE WHEN ((o_orderkey * 19 + o_custkey * 23) % 113) < 1 THEN NULL WHEN ((o_orderkey * 19 + o_custkey * 23) % 113) < 2 THEN 9 WHEN ((o_orderkey * 19 + o_custkey * 23) % 113) < 32 THEN 1 ELSE 2 END AS DOUBLE) AS CVDSTRK3,
       CAST(CASE WHEN ((o_orderkey * 23 + o_custkey * 27) % 127) < 1 THEN NULL WHEN ((o_orderkey * 23 + o_custkey * 27) % 127) < 2 THEN 9 WHEN ((o_orderkey * 23 + o_custkey * 27) % 127) < 35 THEN 1 ELSE 2 END AS DOUBLE) AS _MICHD,
       CAST(CASE WHEN ((o_orderkey * 29 + o_custkey * 33) % 131) < 1 THEN NULL WHEN ((o_orderkey * 29 + o_custkey * 33) % 131) < 2 THEN 9 WHEN ((o_orderkey * 29 + o_custkey * 33) % 131) < 38 THEN 1 ELSE 2 END AS DOUBLE) AS _TOTINDA,
       CAST(CASE WHEN ((o_orderkey * 31 + o_custkey * 35) % 137) < 1 THEN NULL WHEN ((o_orderkey * 31 + o_custkey * 35) % 137) < 2 THEN 9 WHEN ((o_orderkey * 31 + o_custkey * 35) % 137) < 41 THEN 1 ELSE 2 END AS DOUBLE) AS _FRTLT1,
       CAST(CASE WHEN ((o_orderkey * 37 + o_custkey * 41) % 139) < 1 THEN NULL WHEN ((o_orderkey * 37 + o_custkey * 41) % 139) < 2 THEN 9 WHEN ((o_orderkey * 37 + o_custkey * 41) % 139) < 44 THEN 1 ELSE 2 END AS DOUBLE) AS _VEGLT1,
       CAST(CASE WHEN ((o_orderkey * 41 + o_custkey * 45) % 149) < 1 THEN NULL WHEN ((o_orderkey * 41 + o_custkey * 45) % 149) < 2 THEN 9 WHEN ((o_orderkey * 41 + o_custkey * 45) % 149) < 47 THEN 1 ELSE 2 END AS DOUBLE) AS _RFDRHV5,
       CAST(CASE WHEN ((o_orderkey * 43 + o_custkey * 47) % 151) < 1 THEN NULL WHEN ((o_orderkey * 43 + o_custkey * 47) % 151) < 2 THEN 9 WHEN ((o_orderkey * 43 + o_custkey * 47) % 151) < 50 THEN 1 ELSE 2 END AS DOUBLE) AS HLTHPLN1,
       CAST(CASE WHEN ((o_orderkey * 47 + o_custkey * 51) % 157) < 1 THEN NULL WHEN ((o_orderkey * 47 + o_custkey * 51) % 157) < 2 THEN 9 WHEN ((o_orderkey * 47 + o_custkey * 51) % 157) < 53 THEN 1 ELSE 2 END AS DOUBLE) AS MEDCOST,
       CAST(CASE WHEN ((o_orderkey * 53 + o_custkey * 57) % 163) < 1 THEN NULL WHEN ((o_orderkey * 53 + o_custkey * 57) % 163) < 2 THEN 9 WHEN ((o_orderkey * 53 + o_custkey * 57) % 163) < 56 THEN 1 ELSE 2 END AS DOUBLE) AS DIFFWALK,
       CAST(1400 + ((o_orderkey * 59 + o_custkey * 63) % 2503) AS DOUBLE) AS _BMI5,
       CAST(CASE WHEN ((o_orderkey * 61 + o_custkey * 65) % 167) < 2 THEN 9 ELSE 1 + ((o_orderkey * 61 + o_custkey * 65) % 167) % 5 END AS DOUBLE) AS GENHLTH,
       CAST(CASE WHEN ((o_orderkey * 67 + o_custkey * 71) % 173) < 2 THEN 9 ELSE 1 + ((o_orderkey * 67 + o_custkey * 71) % 173) % 2 END AS DOUBLE) AS SEX,
       CAST(CASE WHEN ((o_orderkey * 71 + o_custkey * 75) % 179) < 2 THEN 14 ELSE 1 + ((o_orderkey * 71 + o_custkey * 75) % 179) % 13 END AS DOUBLE) AS _AGEG5YR,
       CAST(CASE WHEN ((o_orderkey * 73 + o_custkey * 77) % 181) < 2 THEN 9 ELSE 1 + ((o_orderkey * 73 + o_custkey * 77) % 181) % 6 END AS DOUBLE) AS EDUCA,
       CAST(CASE WHEN ((o_orderkey * 79 + o_custkey * 83) % 191) < 2 THEN 99 ELSE 1 + ((o_orderkey * 79 + o_custkey * 83) % 191) % 8 END AS DOUBLE) AS INCOME2,
       CAST(CASE WHEN ((o_orderkey * 83 + o_custkey * 87) % 193) < 2 THEN 88 ELSE 0 + ((o_orderkey * 83 + o_custkey * 87) % 193) % 31 END AS DOUBLE) AS MENTHLTH,
       CAST(CASE WHEN ((o_orderkey * 89 + o_custkey * 93) % 197) < 2 THEN 77 ELSE 0 + ((o_orderkey * 89 + o_custkey * 93) % 197) % 31 END AS DOUBLE) AS PHYSHLTH
FROM {orders}
"""


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def derived_survey(spark: SparkSession, sf_dir: str, with_year: bool = False) -> DataFrame:
    """Raw coded survey from ``orders``: ``row_key`` + the 22 survey columns.

    ``with_year`` adds ``DATA_YEAR`` = year of the order date, which makes the
    table a multi-year survey (one "yearly file" per order year).
    """
    columns = ["o_orderkey", "o_custkey"] + (["o_orderdate"] if with_year else [])
    orders = read_table(spark, sf_dir, "orders", columns)
    if not with_year:
        return _barrier(spark.sql(DERIVED_SURVEY_SQL, orders=orders))
    orders = orders.withColumn("DATA_YEAR", utc_year(orders, "o_orderdate")).drop("o_orderdate")
    return _barrier(spark.sql(
        DERIVED_SURVEY_SQL.replace("\nFROM {orders}", ",\n       DATA_YEAR\nFROM {orders}"), orders=orders))


def _barrier(df: DataFrame) -> DataFrame:
    """The same rows, with expressions the optimizer does not inline further up.

    Every fixture column is a CASE over modular arithmetic and the cleaning
    steps test each several times; inlined into the filters, planning grows
    exponentially.  A real survey has plain columns and needs none of this.
    """
    from pyspark.sql import functions as F

    return df.select(F.inline(F.array(F.struct(*df.columns))))


def utc_year(df: DataFrame, column: str):
    """Calendar year of a timestamp in UTC, whatever the session time zone.

    An instant (``timestamp``) goes through epoch days, which no time zone
    shifts; a wall-clock ``timestamp_ntz`` already is UTC-naive.
    """
    from pyspark.sql import functions as F

    if dict(df.dtypes)[column] == "timestamp":
        days = F.floor(F.unix_seconds(F.col(column)) / 86400).cast("int")
        return F.year(F.date_from_unix_date(days)).cast("int")
    return F.year(F.col(column)).cast("int")


def derived_survey_sql_text(orders_relation: str = "orders") -> str:
    return DERIVED_SURVEY_SQL.replace("{orders}", orders_relation)
