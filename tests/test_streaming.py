from pyspark.sql import functions as F

from strata.streaming import run_available_now


def test_available_now_runs_resume_and_merge(spark, tmp_root):
    src, table, ckpt = f"{tmp_root}/in", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    schema = "k int, v string, ts int"
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], schema).write.parquet(f"{src}/f1")
    clean = lambda df: df.withColumn("v", F.upper("v"))
    out = run_available_now(spark, src + "/*", spark.createDataFrame([], schema).schema, clean,
                            table, ["k"], ckpt)
    assert sorted(map(tuple, out.select("k", "v").collect())) == [(1, "A"), (2, "B")]
    # second run: only the new file is read; key 2 changes, key 3 is new
    spark.createDataFrame([(2, "bb", 2), (3, "c", 2)], schema).write.parquet(f"{src}/f2")
    out = run_available_now(spark, src + "/*", spark.createDataFrame([], schema).schema, clean,
                            table, ["k"], ckpt)
    assert sorted(map(tuple, out.select("k", "v").collect())) == [(1, "A"), (2, "BB"), (3, "C")]
    # a third run with nothing new leaves the table as it is
    out = run_available_now(spark, src + "/*", spark.createDataFrame([], schema).schema, clean,
                            table, ["k"], ckpt)
    assert out.count() == 3


def test_available_now_partitioned_table(spark, tmp_root):
    src, table, ckpt = f"{tmp_root}/in", f"{tmp_root}/table", f"{tmp_root}/ckpt"
    schema = "k int, v string, day string"
    spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2")], schema).write.parquet(f"{src}/f1")
    st = spark.createDataFrame([], schema).schema
    run_available_now(spark, src + "/*", st, lambda df: df, table, ["k"], ckpt, partition_by=["day"])
    spark.createDataFrame([(2, "bb", "d2"), (3, "c", "d1")], schema).write.parquet(f"{src}/f2")
    out = run_available_now(spark, src + "/*", st, lambda df: df, table, ["k"], ckpt,
                            partition_by=["day"])
    assert sorted(map(tuple, out.select("k", "v").collect())) == [(1, "a"), (2, "bb"), (3, "c")]
