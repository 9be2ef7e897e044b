"""Reports gathered on the way: step counters of a write, co-moments, distinct sketches."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, survey_df, survey_row
from starloom.operators import clean as C
from starloom.operators import profile as P
from starloom.sources.survey import derived_survey


def test_observed_deltas_equal_the_report(spark, tmp_dir):
    raw = derived_survey(spark, SF0001)
    clean, deltas = P.stage_with_deltas(raw, f"{tmp_dir}/clean")
    assert sorted(map(tuple, deltas.collect())) == sorted(map(tuple, P.step_deltas(raw).collect()))
    want = C.clean_survey(raw)
    assert clean.columns == want.columns and clean.exceptAll(want).count() == 0 == want.exceptAll(clean).count()


def test_observed_deltas_of_an_inferred_run_and_an_empty_table(spark, tmp_dir):
    raw = survey_df(spark, [survey_row(SMOKE100=0.0), survey_row(SMOKE100=1.0), survey_row(SMOKE100=2.0),
                            survey_row(DIABETE3=9.0), survey_row(SEX=None)])
    spec = P.inferred_spec(raw)
    clean, deltas = P.stage_with_deltas(raw, f"{tmp_dir}/a", spec)
    assert sorted(map(tuple, deltas.collect())) == sorted(map(tuple, P.step_deltas(raw, spec).collect()))
    want = C.clean_survey(raw, spec, "inferred")
    assert sorted(map(str, clean.collect())) == sorted(map(str, want.collect()))
    clean, deltas = P.stage_with_deltas(raw.where("false"), f"{tmp_dir}/b")
    assert clean.count() == 0 and {r["rows_before"] for r in deltas.collect()} == {0}


def test_correlations_equal_the_builtin(spark):
    clean = C.clean_survey(derived_survey(spark, SF0001))
    got = {(r["column_a"], r["column_b"]): r for r in P.correlations(clean).collect()}
    assert len(got) == 22 * 21 // 2
    coded = clean.select(*[x.alias(c) for c, x in P.encoded_columns(clean).items()])
    some = list(got)[::17]
    want = coded.agg(*[F.corr(a, b).alias(f"{a}-{b}") for a, b in some]).first()
    for a, b in some:
        assert got[a, b]["r"] == pytest.approx(want[f"{a}-{b}"], abs=1e-9) and got[a, b]["n"] == clean.count()
    assert all(r["r"] is None for r in P.correlations(clean.where("Sex = 'Male'")).collect()
               if "Sex" in (r["column_a"], r["column_b"]))
    assert {r["n"] for r in P.correlations(clean.where("false")).collect()} == {0}


def test_sketches_of_loads_merge_to_the_sketch_of_all(spark, tmp_dir):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    columns = ["l_orderkey", "l_partkey", "l_suppkey"]
    P.distinct_sketches(lines, columns, F.col("l_linenumber")).write.parquet(f"{tmp_dir}/sketches")
    stored = spark.read.parquet(f"{tmp_dir}/sketches")
    got = {r["column_name"]: r["n_distinct"] for r in P.sketched_counts(stored).collect()}
    exact = lines.agg(*[F.count_distinct(c).alias(c) for c in columns]).first().asDict()
    for c in columns:
        assert abs(got[c] - exact[c]) <= 0.04 * exact[c]
    few = {r["column_name"]: r["n_distinct"] for r in P.sketched_counts(stored, [1]).collect()}
    one = lines.where("l_linenumber = 1").agg(F.count_distinct("l_orderkey")).first()[0]
    assert abs(few["l_orderkey"] - one) <= 0.04 * one
