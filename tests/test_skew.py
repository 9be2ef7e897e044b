from pyspark.sql import functions as F

from starloom.operators.skew import fits_broadcast, salted_join


def _hot(spark):
    # 80% of the big side on one key, plus a key with no partner and a null key
    big = spark.range(0, 5000).select(
        F.col("id").alias("rid"),
        F.when(F.col("id") % 5 != 0, F.lit("hot"))
         .when(F.col("id") % 10 == 0, F.lit("cold"))
         .otherwise(F.lit(None)).alias("k"))
    small = spark.createDataFrame([("hot", 1), ("cold", 2), ("none", 3)], "kk string, v int")
    return big, small


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_salted_join_equals_plain_join(spark):
    big, small = _hot(spark)
    for how in ("inner", "left", "left_anti"):
        plain = big.join(small, big["k"] == small["kk"], how)
        salted = salted_join(big, small, [("k", "kk")], how, salts=7)
        assert _rows(plain.select(*sorted(plain.columns))) == \
            _rows(salted.select(*sorted(salted.columns))), how


def test_salted_join_null_safe(spark):
    big = spark.createDataFrame([(1, None), (2, "a")], "rid int, k string")
    small = spark.createDataFrame([(None, 10), ("a", 20)], "kk string, v int")
    got = salted_join(big, small, [("k", "kk")], "left", null_safe=True, salts=3)
    assert sorted((r["rid"], r["v"]) for r in got.collect()) == [(1, 10), (2, 20)]


def test_fits_broadcast(spark):
    assert fits_broadcast(spark.range(10), max_rows=10)
    assert not fits_broadcast(spark.range(11), max_rows=10)
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) AS s")
    assert fits_broadcast(wide, max_rows=10, max_bytes=20_000)
    assert not fits_broadcast(wide, max_rows=10, max_bytes=9_000)   # rows fit, bytes do not


def test_star_with_hot_tuple_salted_equals_broadcast(spark, monkeypatch):
    from conftest import survey_df, survey_row
    from starloom import spec as S
    from starloom.operators import clean as C
    from starloom.operators import star as ST

    rows = [survey_row() for _ in range(60)]                       # one hot tuple
    rows += [survey_row(_AGEG5YR=float(a), EDUCA=float(e)) for a in range(1, 6) for e in range(1, 5)]
    clean = C.clean_survey(survey_df(spark, rows))
    ref = ST.build_star(clean, validated=False)
    want = {t: sorted(map(tuple, df.collect()), key=repr) for t, df in ref.items()}
    monkeypatch.setattr(ST, "fits_broadcast", lambda _df, max_rows=0: False)
    salted = ST.build_star(clean, validated=False)
    fact = salted["fact_health_records"]
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
    got = {t: sorted(map(tuple, df.collect()), key=repr) for t, df in salted.items()}
    assert got == want
    assert len(want["fact_health_records"]) == 80 and len(want["dim_demographics"]) == 20
    assert S.MAIN_STAR.fact_table in got


def test_equal_rows_spread_over_all_salts(spark):
    from starloom.operators.skew import SALT, salt_big, salted_join

    same = spark.createDataFrame([("x", 1)] * 2000, "k string, v int").repartition(3)
    assert salt_big(same, 8).select(SALT).distinct().count() == 8
    small = spark.createDataFrame([("x", 5)], "k2 string, w int")
    assert salted_join(same, small, [("k", "k2")], "inner", salts=8).count() == 2000
