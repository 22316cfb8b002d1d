"""Conforming, soft deletes and the silver job."""

import pytest
from pyspark.sql import functions as F

from changelake.operators.conform import (
    Target,
    append_evolve,
    conform,
    drop_soft_deleted,
    filter_soft_deleted,
    union_conformed,
)
from changelake.plans import feeds, silver

SF = "/root/testdata/sf0.001"


def test_deleted_rows_go_before_the_flag(spark):
    rows = [(1, "True"), (2, "False"), (3, "None"), (4, ""), (5, None), (6, " true ")]
    df = spark.createDataFrame(rows, "id int, deleted string").withColumn("x_deleted", F.lit(1))
    df = df.withColumn("deleted_by", F.lit("me"))
    assert sorted(r.id for r in filter_soft_deleted(df).collect()) == [2, 3, 4, 5]
    assert drop_soft_deleted(df).columns == ["id", "deleted_by"]
    flags = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, deleted boolean")
    assert sorted(r.id for r in filter_soft_deleted(flags).collect()) == [2, 3]


def test_conform_types(spark):
    df = spark.sql("SELECT '7' s, timestamp_ntz'2024-02-03 10:00:00' t, '3.2.2024' d, ' a  b ' w")
    spec = [
        Target("n", "string", "s", "int"),
        Target("t", "string", "t", "date"),
        Target("d", "string", "d", "date"),
        Target("w", "string", "w", "ws"),
        Target("pad", "date"),
    ]
    out = conform(df, spec)
    assert out.first() == ("7", "03-02-2024", "03-02-2024", "a b", None)
    assert dict(out.dtypes)["pad"] == "date"


def test_union_needs_one_schema(spark):
    a, b = spark.range(1), spark.range(1).selectExpr("cast(id as string) id")
    with pytest.raises(ValueError):
        union_conformed(a, b)
    both = append_evolve(spark.sql("SELECT 1 b, 2 a"), spark.sql("SELECT 3 c, 4 a"))
    assert both.columns == ["a", "b", "c"] and both.count() == 2


def test_silver_job(spark, tmp_path):
    a, b = feeds.source_a(spark, SF), feeds.source_b(spark, SF)
    a.write.parquet(f"{tmp_path}/a")
    b.write.parquet(f"{tmp_path}/b")
    n = silver.write_silver(spark, f"{tmp_path}/a", f"{tmp_path}/b", f"{tmp_path}/silver")
    out = spark.read.parquet(f"{tmp_path}/silver")
    assert n == out.count() > 0
    assert out.columns == [name for name, _ in silver.TARGETS] and len(out.columns) == 29
    with pytest.raises(ValueError, match="nowhere"):
        silver.write_silver(spark, f"{tmp_path}/a", f"{tmp_path}/nowhere", f"{tmp_path}/other")


def test_silver_plan_has_no_python_and_no_shuffle(spark):
    df = silver.unify(feeds.source_a(spark, SF), feeds.source_b(spark, SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Sort" not in plan
