"""The star in Spark's catalog: re-creation, loads that can be repeated, loads that are refused."""

import uuid

import pytest
from pyspark.sql import functions as F

from starloom import spec as S
from starloom.session import local_table
from starloom.sources import warehouse as WH

DIM = S.DimSpec("dim_a", "a_id", (("A", "a"),))
LAYOUT = S.StarLayout("small", (DIM,), "fact_a", "record_id", (("V", "v", None),))
TYPES = {"dim_a": {"a_id": "int", "a": "varchar(3)"},
         "fact_a": {"record_id": "bigint", "v": "decimal(3,1)", "a_id": "int"}}


def dims(spark, *rows):
    return local_table(spark, list(rows), "a_id int, a string")


def facts(spark, *rows):
    return local_table(spark, list(rows), "record_id long, v double, a_id int")


@pytest.fixture()
def db(spark, tmp_dir):
    name = "t_" + uuid.uuid4().hex[:10]
    WH.recreate_tables(spark, name, LAYOUT, TYPES, tmp_dir)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def load(star, db, load_id, **kw):
    return WH.load_star(star, db, load_id, LAYOUT, TYPES, **kw)


def ids(spark, db):
    return sorted(r[0] for r in WH.loaded(spark, db, "fact_a").select("record_id").collect())


def test_loads_append_once(spark, db):
    first = {"dim_a": dims(spark, (1, "x")), "fact_a": facts(spark, (1, 1.0, 1), (2, 2.0, 1))}
    assert load(first, db, "one") and not load(first, db, "one")
    assert ids(spark, db) == [1, 2]
    # dimension rows of an earlier load are valid targets; an absent or empty table gets nothing
    assert load({"dim_a": dims(spark, (1, "x")).limit(0), "fact_a": facts(spark, (3, 3.0, 1))}, db, "two")
    assert load({"fact_a": facts(spark, (5, 0.5, 1))}, db, "three")
    assert ids(spark, db) == [1, 2, 3, 5]
    counts = {(r["table_name"], r["load_id"]): (r["row_count"], r["ledger_count"])
              for r in WH.verify_loads(spark, db, LAYOUT).collect()}
    assert counts == {("dim_a", "one"): (1, 1), ("fact_a", "one"): (2, 2), ("dim_a", "two"): (0, 0),
                      ("fact_a", "two"): (1, 1), ("fact_a", "three"): (1, 1)}
    row = WH.loaded(spark, db, "fact_a").where("record_id = 5").first()
    assert str(row["v"]) == "0.5" and WH.loaded(spark, db, "fact_a").columns == ["record_id", "v", "a_id"]


@pytest.mark.parametrize("fact, said", [
    ([(2, 1.0, 1), (9, 1.0, 1)], "unique_key"),      # 2 is committed; the range overlaps
    ([(7, 1.0, 1), (7, 2.0, 1)], "unique_key"),      # twice in the load
    ([(7, 1.0, 8)], "foreign_key"),
    ([(7, None, 1)], "not_null"),
    ([(7, 123.0, 1)], "fits_type"),
])
def test_refused_loads_leave_nothing(spark, db, fact, said):
    load({"dim_a": dims(spark, (1, "x")), "fact_a": facts(spark, (1, 1.0, 1), (2, 2.0, 1), (4, 2.0, 1))}, db, "one")
    with pytest.raises(ValueError, match=said):
        load({"dim_a": dims(spark, (2, "y")), "fact_a": facts(spark, *fact)}, db, "two")
    assert ids(spark, db) == [1, 2, 4] and WH.loaded(spark, db, "dim_a").count() == 1
    assert WH.committed(spark, db) == ["one"]
    # mended, the same load goes in; ids between committed ones are new
    assert load({"dim_a": dims(spark, (2, "y")), "fact_a": facts(spark, (3, 1.0, 2))}, db, "two")
    assert ids(spark, db) == [1, 2, 3, 4]


def test_a_load_that_died_is_not_seen_and_can_run_again(spark, db, monkeypatch):
    star = {"dim_a": dims(spark, (1, "x")), "fact_a": facts(spark, (1, 1.0, 1))}
    add = WH._add

    def dies(spark, database, table, load_id):
        if table == WH.LEDGER:
            raise RuntimeError("lost")
        add(spark, database, table, load_id)
    monkeypatch.setattr(WH, "_add", dies)
    with pytest.raises(RuntimeError):
        load(star, db, "one")
    assert spark.table(f"{db}.fact_a").count() == 1 and ids(spark, db) == []
    monkeypatch.setattr(WH, "_add", add)
    assert load(star, db, "one") and ids(spark, db) == [1]
    assert spark.table(f"{db}.fact_a").count() == 1


def test_nulls_become_zeros_only_unchecked(spark, db):
    load({"dim_a": dims(spark, (1, None)), "fact_a": facts(spark, (1, None, 1))}, db, "raw", check=False)
    assert WH.loaded(spark, db, "dim_a").first()["a"] == "0"
    assert float(WH.loaded(spark, db, "fact_a").first()["v"]) == 0.0


def test_recreate_replaces_layout_and_rows(spark, db):
    load({"dim_a": dims(spark, (1, "x")), "fact_a": facts(spark, (1, 1.0, 1))}, db, "one")
    wider = {**TYPES, "fact_a": {"record_id": "bigint", "w": "double", "a_id": "int"}}
    WH.recreate_tables(spark, db, LAYOUT, wider, created_at=True)
    assert WH.committed(spark, db) == [] and ids(spark, db) == []
    got = [(r["column_name"], r["data_type"], r["key_role"]) for r in
           WH.table_columns(spark, db, LAYOUT.tables).where("table_name = 'fact_a'").orderBy("position").collect()]
    assert got == [("record_id", "bigint", "primary key"), ("w", "double", ""),
                   ("a_id", "int", "references dim_a.a_id"), ("created_at", "timestamp", "")]
    star = {"dim_a": dims(spark, (1, "x")), "fact_a": facts(spark, (1, 1.0, 1)).withColumnRenamed("v", "w")}
    assert WH.load_star(star, db, "one", LAYOUT, wider, created_at=True)
    assert WH.loaded(spark, db, "fact_a").where(F.col("created_at").isNotNull()).count() == 1


def test_committed_loads_are_pruned_by_partition(spark, db):
    load({"dim_a": dims(spark, (1, "x"))}, db, "one")
    plan = WH.loaded(spark, db, "dim_a")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(load_id" in plan or "PartitionFilters: [(load_id" in plan


@pytest.mark.parametrize("bad", ["a b", "x'; DROP", ""])
def test_names_are_checked(spark, db, bad):
    with pytest.raises(ValueError, match="bad name"):
        load({"dim_a": dims(spark, (1, "x"))}, db, bad)
