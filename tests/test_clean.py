from pyspark.sql import functions as F

from conftest import SF0001, survey_df, survey_row
from starloom import spec as S
from starloom.functions import recode as R
from starloom.operators import clean as C
from starloom.operators import profile as P
from starloom.operators.binary import infer_binary_modes, resolve_mode
from starloom.sources.survey import derived_survey


def test_clean_counts_match_fixture(spark):
    raw = derived_survey(spark, SF0001)
    clean = C.clean_survey(raw)
    assert raw.count() == 1500
    assert clean.count() == 1077
    dist = {r["diabetes_status"]: r["n_records"] for r in P.class_distribution(clean).collect()}
    assert dist == {"Diabetic": 157, "Prediabetic": 69, "Healthy": 851}


def test_step_deltas_match_fixture(spark):
    steps = {r["step"]: r for r in P.step_deltas(derived_survey(spark, SF0001)).collect()}
    assert steps["drop_any_null"]["rows_after"] == 1339
    assert steps["valid_target"]["rows_after"] == 1278
    assert steps["binary:DIFFWALK"]["rows_after"] == 1171
    assert steps["validate"]["rows_after"] == 1077
    assert steps["validate"]["removed"] == 0


def test_resolve_mode_edges():
    # (has0, has1, has2, has_other)
    assert resolve_mode(True, False, False, False) == "01"     # only {0}
    assert resolve_mode(False, True, False, False) == "01"     # only {1}
    assert resolve_mode(False, False, True, False) == "12"     # only {2}
    assert resolve_mode(True, True, True, True) == "01"        # {0,1,2,9}
    assert resolve_mode(False, True, True, True) == "12"       # {1,2,9}
    assert resolve_mode(True, False, True, False) is None      # {0,2}
    assert resolve_mode(False, True, False, True) is None      # {1,9}
    assert resolve_mode(False, False, True, True) is None      # {2,9}
    assert resolve_mode(False, False, False, False) == "01"    # empty


def test_inferred_modes_are_sequential(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0), (9.0, 2.0)], "A double, B double")
    # A keeps {0,1}; that drops the B=2 row, so B then looks like {1} -> "01"
    assert infer_binary_modes(df, ["A", "B"]) == {"A": "01", "B": "01"}
    assert infer_binary_modes(df, ["B"]) == {"B": "12"}


def test_no_mode_column_rejected_by_validation(spark):
    rows = [survey_row(_RFHYPE5=0.0), survey_row(_RFHYPE5=2.0)]   # {0,2}: no pattern
    clean = C.clean_survey(survey_df(spark, rows), binary_mode="inferred")
    assert clean.count() == 0


def test_null_safe_domain(spark):
    df = spark.createDataFrame([(None,), (1.0,), (5.0,)], "x double")
    got = df.select(R.in_domain("x", [1, 2]).alias("a"), R.not_in_domain("x", [1, 2]).alias("b"))
    assert [tuple(r) for r in got.collect()] == [(False, True), (True, False), (False, True)]


def test_missing_columns_tolerated(spark):
    df = survey_df(spark, [survey_row(), survey_row(INCOME2=99.0)]).drop("INCOME2")
    clean = C.clean_survey(df)
    assert "Income" not in clean.columns and clean.count() == 2


def test_final_format_only_validated(spark):
    lenient = C.lenient_recode(survey_df(spark, [survey_row(), survey_row(SEX=9.0),
                                                 survey_row(DIABETE3=7.0)]))
    assert C.is_final_format(lenient)
    assert C.clean_survey(lenient).count() == 1


def test_invalid_report_charges_first_rule(spark):
    rows = [survey_row(DIABETE3=7.0, SEX=9.0), survey_row(SEX=9.0), survey_row(MENTHLTH=88.0),
            survey_row(MENTHLTH=88.0), survey_row()]
    lenient = C.lenient_recode(survey_df(spark, rows))
    rep = {r["column_name"]: r for r in P.invalid_report(lenient).collect()}
    assert rep["diabetes_status"]["invalid_rows"] == 1 and rep["diabetes_status"]["null_rows"] == 1
    assert rep["MentHlth"]["invalid_rows"] == 2 and rep["MentHlth"]["distinct_invalid"] == 1
    assert rep["Sex"]["invalid_rows"] == 1          # the other bad-Sex row was charged to status
    vals = {(r["column_name"], r["value"]): r["n"] for r in P.invalid_values(lenient).collect()}
    assert vals[("MentHlth", "88.0")] == 2


def test_unmapped_sex_counted(spark):
    df = survey_df(spark, [survey_row(SEX=9.0), survey_row()])
    rough = C.clean_survey(df, ordinal_filter=False, validate=False)
    row = P.unmapped_count(rough).first()
    assert (row["unmapped_rows"], row["total_rows"]) == (1, 2)


def test_labels_table_inferred_as_01(spark):
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    assert infer_binary_modes(labels, ["quality", "toxic"]) == {"quality": "01", "toxic": "01"}


def test_value_profile(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "a double, b double")
    got = {(r["column_name"], r["value"]): r["n"] for r in P.value_profile(df).collect()}
    assert got == {("a", 1.0): 2, ("b", 2.0): 1}


def test_clean_is_one_map_stage(spark):
    plan = C.clean_survey(derived_survey(spark, SF0001))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_binary_declared_matches_inferred(spark):
    raw = derived_survey(spark, SF0001)
    a = C.clean_survey(raw)
    b = C.clean_survey(raw, binary_mode="inferred")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_yes_no_labels(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "x double")
    out = C.apply_binary_modes(df, {"x": "01"}).orderBy("x")
    assert [r[0] for r in out.collect()] == [S.NO, S.YES]
    df2 = spark.createDataFrame([(1.0,), (2.0,), (9.0,)], "x double")
    out2 = C.apply_binary_modes(df2, {"x": "12"})
    assert sorted(r[0] for r in out2.collect()) == [S.NO, S.YES]
    assert out2.filter(F.col("x").isNull()).count() == 0


def test_cleaning_filters_reach_the_parquet_scan(spark, tmp_dir):
    from starloom.sources.sinks import write_stage

    staged = write_stage(derived_survey(spark, SF0001), f"{tmp_dir}/raw")
    df = C.clean_survey(staged)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters")][0]
    assert "IsNotNull(row_key)" in pushed and "IsNotNull(PHYSHLTH)" in pushed
    assert "In(DIABETE3, [1.0,2.0,3.0])" in pushed and "In(SEX, [1.0,2.0])" in pushed


def test_clean_is_idempotent_through_final_format_path(spark):
    once = C.clean_survey(derived_survey(spark, SF0001))
    twice = C.clean_survey(once)            # final format -> validation only
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_local_and_distributed_mode_resolution_agree(spark):
    from starloom.operators import binary as B

    df = spark.createDataFrame([(0.0, 1.0, 2.0), (1.0, 1.0, 9.0), (9.0, 2.0, 1.0), (1.0, 2.0, 2.0)],
                               "A double, B double, C double")
    local = B.infer_binary_modes(df, ["A", "B", "C"])
    saved = B.fits_broadcast
    B.fits_broadcast = lambda _df, max_rows=0: False      # force the distributed loop
    try:
        distributed = B.infer_binary_modes(df, ["A", "B", "C"])
    finally:
        B.fits_broadcast = saved
    assert local == distributed


def test_value_profile_by_step_agrees_with_clean(spark):
    prof = P.value_profile_by_step(derived_survey(spark, SF0001))
    sex = prof.filter("column_name = 'SEX' AND removed_at_step IS NULL").collect()
    assert {r["value"] for r in sex} == {1.0, 2.0}
    assert sum(r["n"] for r in sex) == 1077
    # rows removed by the null step carry no value for the null column itself
    assert prof.filter("removed_at_step = 1").count() > 0


def test_sql_text_predicates_equal_column_forms(spark):
    """The one-string IN / CASE expressions give the same values as the
    literal-by-literal Column expressions, on nulls, NaN and off-domain codes."""
    from pyspark.sql import Column

    vals = [None, float("nan"), 0.0, 1.0, 1.5, 2.0, 3.0, 9.0, -1.0]
    texts = [None, "NaN", " 0 ", "1", "1.5", "N/A", "", "abc", "-1"]
    df = spark.createDataFrame(list(zip(vals, texts)), "x double, t string")
    x = df["x"]
    assert isinstance(x, Column)
    pairs = [
        (R.in_domain("x", [1, 2, 3]), R.in_domain(x, [1, 2, 3])),
        (R.keep_in("x", [0, 1]), R.keep_in(x, [0, 1])),
        (R.not_in_domain("x", [1, 2]), R.not_in_domain(x, [1, 2])),
        (R.lookup("x", S.TARGET_LABELS), R.lookup(x, S.TARGET_LABELS)),
        (R.case_else_label("x", "a", "b"), R.case_else_label(x, "a", "b")),
        (R.recode_binary("x", "12"), R.recode_binary(x, "12")),
        (R.recode_binary_lenient("x", "12"), R.recode_binary_lenient(x, "12")),
        (R.recode_binary_lenient("x", "01"), R.recode_binary_lenient(x, "01")),
        (R.parse_number("t"), R.parse_number(df["t"])),
    ]
    out = df.select(*[F.struct(a.alias("a"), b.alias("b")).alias(f"p{i}")
                      for i, (a, b) in enumerate(pairs)]).collect()
    for row in out:
        for i in range(len(pairs)):
            assert row[f"p{i}"]["a"] == row[f"p{i}"]["b"], (i, row)
