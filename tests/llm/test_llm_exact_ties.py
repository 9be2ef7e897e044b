"""Copies that tie on the largest doc_id: one stays, and one per task at most is shuffled."""

from pyspark.sql import functions as F

from starloom.llm import exact


def tied(spark):
    same = spark.range(0, 3000, 1, 6).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    rest = spark.range(0, 50, 1, 2).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 40).cast("string"))
                                          .alias("text"))
    return same.unionByName(rest)


def test_ties_keep_one_row(spark):
    got = sorted((r["text"], r["doc_id"]) for r in exact.drop_copies(tied(spark)).collect() if r["text"] != "one text")
    assert got == sorted((f"t{i % 40}", i) for i in range(10, 50))
    assert exact.drop_copies(tied(spark)).where("text = 'one text'").count() == 1


def test_ties_leave_a_task_as_one_row(spark):
    plan = exact.drop_copies(tied(spark))._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning(_digest"):]
    assert "row_number(), 1, Final" in plan and "row_number(), 1, Partial" in before
