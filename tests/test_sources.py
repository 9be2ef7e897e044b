import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from starloom import spec as S
from starloom.operators import clean as C
from starloom.operators import profile as P
from starloom.operators import star as ST
from starloom.sources import files as FS
from starloom.sources import sinks as SK
from starloom.sources.survey import derived_survey


def _write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def _full_row(**over):
    vals = {c: "1" for c in S.SELECTED_COLUMNS}
    vals.update({"DIABETE3": "3", "_BMI5": "2500", "MENTHLTH": "0", "PHYSHLTH": "0",
                 "GENHLTH": "2", "SEX": "2", "_AGEG5YR": "5", "EDUCA": "4", "INCOME2": "6"})
    vals.update(over)
    return vals


def test_year_discovery_union_and_skips(spark, tmp_dir):
    cols = list(S.SELECTED_COLUMNS)
    _write_csv(f"{tmp_dir}/2014.csv", cols, [[_full_row()[c] for c in cols]] * 2)
    no_income = [c for c in cols if c != "INCOME2"]
    _write_csv(f"{tmp_dir}/2015.csv", no_income, [[_full_row()[c] for c in no_income]] * 3)
    _write_csv(f"{tmp_dir}/notes.csv", ["a"], [["x"]])
    no_target = [c for c in cols if c != "DIABETE3"]
    _write_csv(f"{tmp_dir}/2016.csv", no_target, [[_full_row()[c] for c in no_target]])
    assert sorted(FS.year_files(spark, tmp_dir)) == [2014, 2015, 2016]
    u = FS.union_years(spark, tmp_dir)                # 2016 skipped (no target)
    years = {r["DATA_YEAR"]: r["n_records"] for r in P.years_included(u).collect()
             if not r["is_total"]}
    assert years == {2014: 2, 2015: 3}
    assert [r["n_records"] for r in P.years_included(u).collect() if r["is_total"]] == [5]
    assert u.filter("DATA_YEAR = 2015 AND INCOME2 IS NULL").count() == 3
    # the year missing a column loses all its rows at the null step
    assert C.clean_survey(u).groupBy("DATA_YEAR").count().collect()[0]["DATA_YEAR"] == 2014


def test_all_years_fail(spark, tmp_dir):
    _write_csv(f"{tmp_dir}/2016.csv", ["x"], [["1"]])
    with pytest.raises(RuntimeError):
        FS.union_years(spark, tmp_dir)
    with pytest.raises(FileNotFoundError):
        FS.single_year(spark, tmp_dir, 2015)


def test_null_tokens(spark, tmp_dir):
    cols = list(S.SELECTED_COLUMNS)
    rows = []
    for tok in ["", "NA", "NaN", "null", " 4 "]:
        r = _full_row(EDUCA=tok)
        rows.append([r[c] for c in cols])
    _write_csv(f"{tmp_dir}/2015.csv", cols, rows)
    df = FS.csv_scan(spark, f"{tmp_dir}/2015.csv")
    vals = [r["EDUCA"] for r in df.collect()]
    assert vals == [None, None, None, None, 4.0]


def test_feature_select_errors(spark):
    df = spark.createDataFrame([(1.0,)], "other double")
    with pytest.raises(ValueError):
        FS.select_features(df)
    df2 = spark.createDataFrame([(1.0,)], "_BMI5 double")
    with pytest.raises(ValueError):
        FS.select_features(df2)


def test_bounded_scan_in_key_order(spark):
    raw = derived_survey(spark, SF0001)
    got = [r["row_key"] for r in FS.bounded_scan(raw, 10).collect()]
    assert got == sorted(r["row_key"] for r in raw.orderBy("row_key").limit(10).collect())


def test_csv_sink_and_dataset_scan_round_trip(spark, tmp_dir):
    clean = C.clean_survey(derived_survey(spark, SF0001))
    paths = SK.write_csv_tables({"clean": clean}, tmp_dir)
    back = FS.dataset_scan(spark, paths["clean"])
    assert back.exceptAll(clean.select(*back.columns)).count() == 0
    assert back.count() == clean.count()


def test_fill_zero(spark):
    df = spark.createDataFrame([(None, None)], "a double, b string")
    assert tuple(SK.fill_zero(df).first()) == (0.0, "0")


def test_jdbc_derby_in_memory(spark):
    """JDBC load + verification through Derby embedded in this JVM (no server)."""
    star = ST.build_star(C.clean_survey(derived_survey(spark, SF0001)))
    url = "jdbc:derby:memory:starloom_test;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    SK.jdbc_load_star(star, url, properties=props)
    counts = {r["table_name"]: r["row_count"] for r in
              SK.jdbc_counts(spark, url, S.MAIN_STAR.tables, props).collect()}
    assert counts == {"dim_demographics": 718, "dim_lifestyle": 32, "dim_medical_conditions": 59,
                      "dim_healthcare_access": 4, "fact_health_records": 1077}
    back = spark.read.jdbc(url, "fact_health_records", properties=props)
    assert dict(back.dtypes)["BMI_VALUE".lower()] == "decimal(5,2)"


def test_empty_frame_skipped(spark):
    empty = spark.createDataFrame([], "a int")
    assert SK.jdbc_write(empty, "jdbc:derby:memory:unused;create=true", "t") is False


def test_partitioned_year_layout_discovered(spark, tmp_dir):
    raw = derived_survey(spark, SF0001, with_year=True)
    FS.write_year_files(raw, f"{tmp_dir}/years")
    years = FS.year_files(spark, f"{tmp_dir}/years")
    assert sorted(years) == list(range(1995, 2002))
    u = FS.union_years(spark, f"{tmp_dir}/years")
    assert u.count() == 1500 and u.filter("DATA_YEAR IS NULL").count() == 0


def test_publish_with_created_at(spark, tmp_dir):
    star = ST.build_star(C.clean_survey(derived_survey(spark, SF0001)))
    SK.publish_star(star, tmp_dir, created_at=True)
    fact = SK.read_published(spark, tmp_dir)["fact_health_records"]
    assert "created_at" in fact.columns and fact.filter("created_at IS NULL").count() == 0


def test_rows_with_too_many_cells(spark, tmp_dir):
    cols = list(S.SELECTED_COLUMNS)
    good = [_full_row()[c] for c in cols]
    _write_csv(f"{tmp_dir}/2014.csv", cols, [good] * 2)
    for year, extra in ((2015, ["7"]), (2016, [""])):
        _write_csv(f"{tmp_dir}/{year}.csv", cols, [good, good + extra])
    _write_csv(f"{tmp_dir}/2017.csv", cols, [good, good[:-1]])      # a missing cell is a null
    with pytest.raises(ValueError):
        FS.single_year(spark, tmp_dir, 2015)
    with pytest.raises(ValueError):
        FS.single_year(spark, tmp_dir, 2016)
    assert FS.single_year(spark, tmp_dir, 2017).count() == 2
    years = {r["DATA_YEAR"] for r in FS.union_years(spark, tmp_dir).select("DATA_YEAR").distinct().collect()}
    assert years == {2014, 2017}


def _keyless_files(tmp_dir, n=400):
    cols = list(S.SELECTED_COLUMNS)
    for f in range(3):
        rows = [[_full_row(SEX=str(1 + (i * 7 + f) % 2), _AGEG5YR=str(1 + (i * 5 + f) % 13),
                           _BMI5=str(2000 + f * n + i))[c] for c in cols] for i in range(n)]
        rows[3][0] = ""                                             # dropped by the null step
        _write_csv(f"{tmp_dir}/part-{f}.csv", cols, rows)


def test_record_ids_follow_the_files_whatever_the_splits(spark, tmp_dir):
    _keyless_files(tmp_dir)
    want = None
    for split in ("128m", "4k", "900b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            star = ST.build_star(C.clean_survey(FS.csv_scan(spark, tmp_dir, file_order=True)))
            got = [r["bmi_value"] for r in star["fact_health_records"].orderBy("record_id").collect()]
            dims = sorted(map(tuple, star["dim_demographics"].collect()))
            plan = star["fact_health_records"]._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == sorted(got) and len(got) == 3 * 399
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
        want = want or (got, dims)
        assert (got, dims) == want


def test_rows_without_any_order_are_refused(spark, tmp_dir):
    _keyless_files(tmp_dir, 5)
    with pytest.raises(ValueError):
        ST.build_star(C.clean_survey(FS.csv_scan(spark, tmp_dir)))


def test_run_from_files(spark, tmp_dir):
    from starloom.plans import runs

    cols = list(S.SELECTED_COLUMNS)
    for year in (2014, 2015):
        _write_csv(f"{tmp_dir}/in/{year}.csv", cols,
                   [[_full_row(_BMI5=str(year + i))[c] for c in cols] for i in range(6)])
    for years, first, n in ((None, None, 12), (2015, None, 6), ([2014], None, 6), (None, 4, 4)):
        runs.run_files(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", years=years, first_rows=first)
        fact = SK.read_published(spark, f"{tmp_dir}/out")["fact_health_records"].orderBy("record_id").collect()
        assert [r["record_id"] for r in fact] == list(range(1, n + 1))
        start = 2015 if years == 2015 else 2014
        assert float(fact[0]["bmi_value"]) == start / 100


def test_publish_keeps_the_old_version_when_it_fails(spark, tmp_dir, monkeypatch):
    star = ST.build_star(C.clean_survey(derived_survey(spark, SF0001)))
    SK.publish_star(star, tmp_dir, version="one")

    def crash(*args, **kwargs):
        raise RuntimeError("crash before the switch")
    monkeypatch.setattr(SK, "_point_to", crash)
    with pytest.raises(RuntimeError):
        SK.publish_star(star, tmp_dir, version="two")
    assert SK.published_paths(spark, tmp_dir)["fact_health_records"].endswith("v=one/fact_health_records")
    monkeypatch.undo()
    SK.publish_star(star, tmp_dir, version="three")
    assert SK.published_paths(spark, tmp_dir)["fact_health_records"].endswith("v=three/fact_health_records")
    broken = dict(star, fact_health_records=star["fact_health_records"].withColumn("bmi_value", F.lit(-1.0)))
    with pytest.raises(ValueError):
        SK.publish_star(broken, tmp_dir, version="four")
    assert SK.read_published(spark, tmp_dir)["fact_health_records"].count() == 1077


def test_jdbc_load_is_all_or_nothing(spark):
    star = ST.build_star(C.clean_survey(derived_survey(spark, SF0001)))
    url = "jdbc:derby:memory:starloom_atomic;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    SK.jdbc_load_star(star, url, properties=props)
    fail = dict(star, fact_health_records=star["fact_health_records"].withColumn(
        "bmi_value", F.when(F.col("record_id") == 500, F.raise_error(F.lit("lost"))).otherwise(F.col("bmi_value"))))
    small = {t: df.limit(2) for t, df in fail.items() if t != "fact_health_records"}
    with pytest.raises(Exception):
        SK.jdbc_load_star({**fail, **small}, url, properties=props, check=False)
    counts = {r["table_name"]: r["row_count"] for r in
              SK.jdbc_counts(spark, url, S.MAIN_STAR.tables, props).collect()}
    assert counts["dim_demographics"] == 718 and counts["fact_health_records"] == 1077
    SK.jdbc_load_star({t: df.limit(0) for t, df in star.items()}, url, properties=props)
    assert {r["row_count"] for r in SK.jdbc_counts(spark, url, S.MAIN_STAR.tables, props).collect()} == {0}


def test_multi_year_survey_asks_for_few_partitions(spark):
    from starloom.operators.numbering import range_tag

    raw = derived_survey(spark, "/root/testdata/sf0.1", with_year=True)
    tagged = range_tag(raw, ["row_key"])
    assert tagged.select("_pid").distinct().count() <= 16


def test_part_files_with_their_own_headers(spark, tmp_dir):
    """Two parts of one year in opposite column order, one with more columns."""
    cols = list(S.SELECTED_COLUMNS)
    row = _full_row(SEX="1", INCOME2="8", _BMI5="3100")
    _write_csv(f"{tmp_dir}/2015.csv/part-0.csv", cols, [[row[c] for c in cols]])
    _write_csv(f"{tmp_dir}/2015.csv/part-1.csv", ["EXTRA", *cols[::-1], "sex"], [["5", *(row[c] for c in cols[::-1]), "9"]])
    for df in (FS.union_years(spark, tmp_dir), FS.single_year(spark, tmp_dir, 2015),
               FS.union_years(spark, tmp_dir, check_rows=False), FS.csv_scan(spark, f"{tmp_dir}/2015.csv")):
        got = [tuple(r[c] for c in cols) for r in df.collect()]
        assert got == [tuple(float(row[c]) for c in cols)] * 2


def test_text_is_parsed_once_and_rejects_are_kept(spark, tmp_dir):
    from starloom.sources import intake

    cols = list(S.SELECTED_COLUMNS)
    good = [_full_row()[c] for c in cols]
    _write_csv(f"{tmp_dir}/2014.csv", cols, [good] * 3)
    _write_csv(f"{tmp_dir}/2015.csv", cols, [good, good + ["7"], good + [""], good[:-2]])
    taken = FS.take_in_years(spark, tmp_dir)
    assert taken.years == {2014: (3, 0), 2015: (4, 2)}
    assert [r["DATA_YEAR"] for r in taken.rows.collect()] == [2014] * 3
    assert sorted((r["DATA_YEAR"], r["line"]) for r in taken.rejected.collect()) == \
        sorted([(2015, ",".join(good + ["7"])), (2015, ",".join(good + [""]))])
    files = [p for y in (2014, 2015) for p in intake.part_files(spark, f"{tmp_dir}/{y}.csv")]
    scan = intake.scan_files(spark, files, S.SURVEY, (), True)
    assert scan._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert "FileScan csv" not in taken.rows._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="more cells than the header"):
        FS.csv_scan(spark, f"{tmp_dir}/2015.csv").count()
    with pytest.raises(Exception, match="more cells than the header"):
        FS.union_years(spark, tmp_dir, check_rows=False).collect()


def test_compressed_and_empty_parts(spark, tmp_dir):
    import gzip

    cols = list(S.SELECTED_COLUMNS)
    row = [_full_row()[c] for c in cols]
    os.makedirs(f"{tmp_dir}/2015.csv")
    with gzip.open(f"{tmp_dir}/2015.csv/part-0.csv.gz", "wt") as f:
        f.write("\ufeff" + ",".join(cols) + "\n" + ",".join(row) + "\n")
    open(f"{tmp_dir}/2015.csv/part-1.csv", "w").close()
    open(f"{tmp_dir}/2016.csv", "w").close()
    assert FS.union_years(spark, tmp_dir).count() == 1
    with pytest.raises(ValueError):
        FS.single_year(spark, tmp_dir, 2016)
