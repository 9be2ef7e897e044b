import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from starloom import spec as S
from starloom.operators import clean as C
from starloom.operators import star as ST
from starloom.operators import views as V
from starloom.operators.numbering import dense_index
from starloom.sources.survey import derived_survey


@pytest.fixture(scope="module")
def clean(spark):
    return C.clean_survey(derived_survey(spark, SF0001))


def test_star_sizes_match_fixture(clean):
    star = ST.build_star(clean)
    sizes = {t: df.count() for t, df in star.items()}
    assert sizes == {"dim_demographics": 718, "dim_lifestyle": 32, "dim_medical_conditions": 59,
                     "dim_healthcare_access": 4, "fact_health_records": 1077}


def test_round_trip_gives_back_clean_rows(clean):
    star = ST.build_star(clean)
    back = ST.star_round_trip(star).select(
        F.col("diabetes_status"), F.col("bmi_value").alias("BMI"),
        F.col("mental_health_days").alias("MentHlth"), F.col("physical_health_days").alias("PhysHlth"),
        F.col("general_health_score").alias("GenHlth"),
        *[c for d in S.MAIN_STAR.dims for c in d.sources])
    orig = clean.select(*back.columns)
    assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0


def test_keys_dense_and_first_seen(clean):
    star = ST.build_star(clean)
    for d in S.MAIN_STAR.dims:
        ids = [r[0] for r in star[d.table].select(d.key).orderBy(d.key).collect()]
        assert ids == list(range(1, len(ids) + 1))
    fact = star["fact_health_records"]
    ids = [r[0] for r in fact.select("record_id").orderBy("record_id").collect()]
    assert ids == list(range(1, 1078))
    # record 1 is the smallest order key; its tuples got key 1 everywhere
    first = fact.filter("record_id = 1").first()
    assert all(first[d.key] == 1 for d in S.MAIN_STAR.dims)


@pytest.mark.parametrize("n", [1, 7, 50])
def test_partition_invariance(clean, n):
    ref = ST.build_star(clean)["fact_health_records"]
    got = ST.build_star(clean, num_partitions=n)["fact_health_records"]
    assert ref.exceptAll(got).count() == 0 and got.exceptAll(ref).count() == 0


def test_dense_index_distributed(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7 % 5003).alias("k"))
    out = dense_index(df, ["k"], "rn", num_partitions=9)
    rows = out.orderBy("k").collect()
    assert [r["rn"] for r in rows] == list(range(1, 5001))


def test_strict_lookup_raises(spark):
    dim = S.DimSpec("d", "d_id", (("a", "a"),))
    dim_df = spark.createDataFrame([(1, "x")], "d_id int, a string")
    fact = spark.createDataFrame([("x",), ("y",)], "a string")
    with pytest.raises(Exception):
        ST.lookup_key(fact, dim_df, dim, bound=2, strict=True).collect()
    loose = ST.lookup_key(fact, dim_df, dim, bound=2, strict=False)
    assert sorted((r["a"], r["d_id"]) for r in loose.collect()) == [("x", 1), ("y", None)]


def test_alternate_layout(clean):
    star = ST.build_star(clean, S.ALT_STAR)
    assert set(star["dim_healthcare_access"].columns) == {
        "healthcare_access_id", "AnyHealthcare", "NoDocbcCost", "CholCheck"}
    assert "difficulty_walking" in star["fact_health_records"].columns
    assert star["fact_health_records"].filter(F.col("healthcare_access_id").isNull()).count() == 0


def test_view_plan_broadcasts_dims_no_python(clean):
    view = V.analysis_view(V.encode_star(ST.build_star(clean)), dims_bounded=True)
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 8      # 4 lookups + 4 view joins
    assert "SortMergeJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert view.count() == 1077


def test_encode_decode_round_trip(clean):
    star = ST.build_star(clean)
    back = V.decode_star(V.encode_star(star))
    for t in S.MAIN_STAR.tables:
        a, b = star[t], back[t].select(*star[t].columns)
        assert a.exceptAll(b).count() == 0, t


def test_generic_dimension_value_order(spark):
    li = spark.read.parquet(f"{SF0001}/lineitem.parquet").select("l_returnflag", "l_linestatus")
    dim = S.DimSpec("dim_status", "status_id", (("l_returnflag", "flag"), ("l_linestatus", "status")))
    out = ST.build_dimension(li, dim).orderBy("status_id").collect()
    keys = [(r["flag"], r["status"]) for r in out]
    assert keys == sorted(keys) and [r["status_id"] for r in out] == list(range(1, len(out) + 1))


def test_local_table_matches_create_dataframe(spark):
    from starloom.session import local_table

    rows = [(1, "O'Brien \\ x", 1e-05, None, 3_000_000_000), (2, None, -1.5, 2.0, None)]
    schema = "k int, s string, d double, e double, b bigint"
    inline, plain = local_table(spark, rows, schema), spark.createDataFrame(rows, schema)
    assert inline.schema == plain.schema
    assert inline.collect() == plain.collect()
    assert local_table(spark, [], schema).count() == 0


def test_local_table_large_falls_back(spark):
    from starloom import session

    rows = [(i, float(i)) for i in range(session.INLINE_MAX_ROWS + 1)]
    big = session.local_table(spark, rows, "k int, v double")
    assert "LocalRelation" not in big._jdf.queryExecution().analyzed().toString()
    assert big.count() == len(rows)
    small = session.local_table(spark, rows[:3], "k int, v double")
    assert "LocalRelation" in small._jdf.queryExecution().optimizedPlan().toString()


def test_range_partition_count_small_input(spark):
    """A small input gets one partition per core at most, whatever the shuffle
    setting; an explicit count is kept."""
    from starloom.operators.numbering import partition_count

    df = spark.range(1000)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        assert partition_count(df) == min(200, spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        assert partition_count(df) == min(2, spark.sparkContext.defaultParallelism)
        assert partition_count(df, 37) == 37
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_a_repeated_order_key_is_refused(spark):
    from starloom.operators.numbering import numbered_rows

    rows = spark.range(1000).select((F.col("id") % 997).alias("k"), "id").repartition(5)
    with pytest.raises(ValueError, match="3 rows repeat"):
        numbered_rows(rows, "n", "k", 4)
    got = numbered_rows(rows.where("id < 997"), "n", "k", 4).collect()
    assert sorted((r["k"], r["n"]) for r in got) == [(i, i + 1) for i in range(997)]


def test_staged_rows_keep_the_file_order_however_they_are_read(spark):
    """Pieces of a block in several tasks, and rows dealt anew (pieces that overlap)."""
    from starloom.operators.numbering import BLOCK, FILE, POS, numbered_rows

    rows = spark.range(3000).select(
        F.concat(F.lit("f"), (F.col("id") / 1000).cast("int").cast("string")).alias(FILE),
        (F.col("id") % 1000 / 500).cast("int").cast("long").alias(BLOCK), F.col("id").alias(POS), "id")
    for dealt in (rows.repartitionByRange(7, "id"), rows.repartition(7)):
        got = numbered_rows(dealt.where("id % 3 > 0"), "n", None).orderBy("n").collect()
        assert [r["id"] for r in got] == [i for i in range(3000) if i % 3]
        assert [r["n"] for r in got] == list(range(1, 2001)) and set(got[0].asDict()) == {"id", "n"}
