import pytest

from starloom import spec as S
from starloom.operators import quality as Q
from starloom.sources import sinks as SK


def broken_star(spark):
    """A star with one violation of each kind."""
    demo = spark.createDataFrame(
        [(1, "Male", 5.0, 4.0, 6.0), (1, "Female", 5.0, 4.0, 6.0), (2, None, 5.0, 4.0, 6.0),
         (3, "Nonbinary!!", 5.0, 4.0, 6.0), (4, "Male", 5.0, 4.0, 1000.0)],
        "demographic_id int, sex string, age_group double, education_level double, "
        "income_bracket double")
    life = spark.createDataFrame([(1, "Yes", "Yes", "Yes", "Yes", "No")],
                                 "lifestyle_id int, smoker_status string, physical_activity string, "
                                 "fruits_consumption string, vegetables_consumption string, "
                                 "heavy_alcohol_consumption string")
    med = spark.createDataFrame([(1, "No", "No", "Yes", "No", "No", "No")],
                                "medical_conditions_id int, high_blood_pressure string, "
                                "high_cholesterol string, cholesterol_check string, "
                                "stroke_history string, heart_disease_or_attack string, "
                                "difficulty_walking string")
    hc = spark.createDataFrame([(1, "Yes", "No")], "healthcare_access_id int, "
                               "any_healthcare_coverage string, no_doctor_due_to_cost string")
    fact = spark.createDataFrame(
        [(1, "Healthy", 25.0, 0.0, 0.0, 2.0, 1, 1, 1, 1),
         (2, "Diabetic", 0.0, 3.0, 4.0, 2.0, 1, 1, 1, 1),        # bmi 0 (range)
         (3, "Diabetic", 120.0, 31.0, 4.0, 9.0, 2, 1, 1, 1),     # bmi 120, days 31, general 9
         (4, "Prediabetic", 1000.0, 3.0, 4.0, 2.0, 9, 1, 1, 1),  # bmi overflow + orphan FK
         (4, None, 30.0, 3.0, 4.0, 2.0, 1, 1, 1, 1)],            # duplicate key + null status
        "record_id bigint, diabetes_status string, bmi_value double, mental_health_days double, "
        "physical_health_days double, general_health_score double, demographic_id int, "
        "lifestyle_id int, medical_conditions_id int, healthcare_access_id int")
    return {"dim_demographics": demo, "dim_lifestyle": life, "dim_medical_conditions": med,
            "dim_healthcare_access": hc, "fact_health_records": fact}


def test_every_constraint_fires(spark):
    v = Q.check_star(broken_star(spark))
    got = {(r["constraint"], r["table_name"], r["column_name"], r["row_key"]) for r in v.collect()}
    assert ("not_null", "dim_demographics", "sex", 2) in got
    assert ("unique_key", "dim_demographics", "demographic_id", 1) in got
    assert ("fits_type", "dim_demographics", "sex", 3) in got               # 11 chars
    assert ("fits_type", "dim_demographics", "income_bracket", 4) in got    # decimal(3,1)
    assert ("check_range", "fact_health_records", "bmi_value", 2) in got
    assert ("check_range", "fact_health_records", "bmi_value", 3) in got
    assert ("check_range", "fact_health_records", "mental_health_days", 3) in got
    assert ("check_range", "fact_health_records", "general_health_score", 3) in got
    assert ("fits_type", "fact_health_records", "bmi_value", 4) in got      # decimal(5,2)
    assert ("foreign_key", "fact_health_records", "demographic_id", 4) in got
    assert ("unique_key", "fact_health_records", "record_id", 4) in got
    assert ("not_null", "fact_health_records", "diabetes_status", 4) in got
    # rows 1 and the valid parts of others are clean
    assert not any(k[3] == 1 and k[1] == "fact_health_records" for k in got)


def test_null_passes_check_constraint(spark):
    df = spark.createDataFrame([(1, None)], "record_id bigint, bmi_value double")
    v = Q.row_checks(df, "t", "record_id", ranges=S.RANGE_CHECKS)
    assert [r["constraint"] for r in v.collect()] == ["not_null"]


def test_publish_refuses_broken_star_and_keeps_previous(spark, tmp_dir):
    good = broken_star(spark)
    good["dim_demographics"] = good["dim_demographics"].filter("demographic_id = 1 AND sex = 'Male'")
    good["fact_health_records"] = good["fact_health_records"].filter("record_id = 1")
    SK.publish_star(good, tmp_dir, version="v1")
    with pytest.raises(ValueError):
        SK.publish_star(broken_star(spark), tmp_dir, version="v2")
    current = SK.read_published(spark, tmp_dir)
    assert current["fact_health_records"].count() == 1


def test_created_at(spark):
    df = Q.with_created_at(spark.range(3))
    assert df.filter("created_at IS NULL").count() == 0


def test_foreign_keys_one_scan_equals_salted_anti_joins(spark):
    star = broken_star(spark)
    fact = star["fact_health_records"].union(spark.createDataFrame(
        [(5, "Healthy", 25.0, 0.0, 0.0, 2.0, 7, 8, None, 9)], star["fact_health_records"].schema))
    refs = [(d.key, star[d.table], d.key) for d in S.MAIN_STAR.dims]
    one = Q.foreign_keys(fact, "fact_health_records", "record_id", refs, dims_bounded=True)
    salted = Q.foreign_keys(fact, "fact_health_records", "record_id", refs, dims_bounded=False)
    assert one.count() == 4 and one.exceptAll(salted).count() == 0 \
        and salted.exceptAll(one).count() == 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 4


def test_check_star_same_with_and_without_broadcast_bound(spark):
    star = broken_star(spark)
    one = Q.check_star(star, dims_bounded=True)
    salted = Q.check_star(star, dims_bounded=False)
    assert one.count() == salted.count() > 0
    assert one.exceptAll(salted).count() == 0 and salted.exceptAll(one).count() == 0


def test_check_star_scans_the_fact_twice(spark, tmp_dir):
    """Row checks and all four foreign keys share one fact scan; uniqueness is
    the other.  Counted on the executed plan over a parquet fact."""
    star = broken_star(spark)
    path = f"{tmp_dir}/fact_parquet"
    star["fact_health_records"].write.mode("overwrite").parquet(path)
    star["fact_health_records"] = spark.read.parquet(path)
    plan = Q.check_star(star, dims_bounded=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("fact_parquet") == 2, plan


def test_publish_writes_the_fact_once_and_names_what_failed(spark, tmp_dir, monkeypatch):
    from conftest import SF0001
    from starloom.operators import clean as C
    from starloom.operators import star as ST
    from starloom.sources.survey import derived_survey

    good = ST.build_star(C.clean_survey(derived_survey(spark, SF0001)))
    writes = []
    monkeypatch.setattr(SK, "load_casts", lambda df, types, strict=True, real=SK.load_casts: (
        writes.append(df.columns[0]), real(df, types, strict))[1])
    SK.publish_star(good, tmp_dir, version="v1")
    assert writes == [d.key for d in S.MAIN_STAR.dims] + ["record_id"]
    with pytest.raises(ValueError) as e:
        SK.publish_star(broken_star(spark), tmp_dir, version="v2")
    want = {}
    for r in Q.check_star(broken_star(spark)).collect():
        k = (r["constraint"], r["table_name"], r["column_name"])
        want[k] = want.get(k, 0) + 1
    assert str(e.value).split(": ", 1)[1] == ", ".join(f"{c} {t}.{col}: {n}" for (c, t, col), n in sorted(want.items()))
    assert SK.published_paths(spark, tmp_dir)["dim_lifestyle"].endswith("v=v1/dim_lifestyle")
    import os
    assert not os.path.exists(f"{tmp_dir}/v=v2")


def test_unique_in_runs(spark, tmp_dir):
    ids = spark.range(1, 20_001).repartitionByRange(6, "id").sortWithinPartitions("id")
    assert Q.unique_in_runs(ids, "id")
    plan = Q.id_runs(ids, "id")
    assert plan.count() == 6 and plan.agg({"n": "sum"}).first()[0] == 20_000
    # a gap with a repeat that counts, minima and maxima would not show
    assert not Q.unique_in_runs(spark.createDataFrame([(1,), (1,), (3,)], "id long").coalesce(1), "id")
    assert not Q.unique_in_runs(ids.union(spark.range(500, 501)), "id")
    assert Q.unique_in_runs(spark.createDataFrame([], "id long"), "id")
    assert Q.unique_in_runs(spark.createDataFrame([(None,), (7,), (None,)], "id long"), "id")


def test_pointers_are_exclusive(spark, tmp_dir):
    SK._point_to(spark, tmp_dir, "a")
    p, fs = SK._files(spark, f"{tmp_dir}/{SK.POINTER}-000000000002")
    fs.create(p, False).close()             # a publisher that died
    assert SK.published_paths(spark, tmp_dir)["dim_lifestyle"].endswith("v=a/dim_lifestyle")
    SK._point_to(spark, tmp_dir, "b")
    assert SK._pointers(spark, tmp_dir) == [1, 2, 3]
    assert SK.published_paths(spark, tmp_dir)["dim_lifestyle"].endswith("v=b/dim_lifestyle")
