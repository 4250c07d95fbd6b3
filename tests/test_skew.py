"""One key holding a third of all rows: results stay whole and exact."""

import pandas as pd
from pyspark.sql import functions as F

from strata.operators import latest_per_key, lookup
from strata.operators.quality import check_unique, orphan_count

N = 30000


def skewed(spark):
    # key 0 holds a third of the rows; the rest spread over 2000 keys
    return spark.range(N, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        (F.col("id") * 7919 % 100003).alias("ts"), F.col("id").alias("v"))


def test_latest_per_key_hot_key(spark):
    df = skewed(spark)
    out = latest_per_key(df, ["k"], ["ts"])
    pdf = df.toPandas()
    expect = (pdf.sort_values(["k", "ts", "v"], ascending=[True, False, True])
                 .groupby("k").head(1).sort_values("k"))
    got = out.toPandas().sort_values("k")
    assert list(got["v"]) == list(expect["v"]) and len(got) == pdf["k"].nunique()
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the partial limit sits below the exchange: at most one row per key per map task is shuffled
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_lookup_and_checks_hot_key(spark):
    df = skewed(spark)
    dim = spark.range(0, 1500).select(F.col("id").alias("k"), (F.col("id") * 10).alias("attr"))
    pdf, pdim = df.toPandas(), dim.toPandas()
    for salt in (1, 8):
        got = lookup(df, dim, "k", ["attr"], required=False, salt=salt, salt_by=["v"]).toPandas()
        exp = pdf.merge(pdim, on="k", how="left")
        assert len(got) == N
        assert sorted(got["attr"].fillna(-1)) == sorted(exp["attr"].fillna(-1))
    dups = check_unique(df, "k").toPandas()
    assert len(dups) == (pdf["k"].value_counts() > 1).sum()
    assert int(dups.loc[dups["k"] == 0, "n_records"].iloc[0]) == N // 3
    r = orphan_count(df, "k", dim, "k").first()
    assert (r.total, r.orphans) == (N, int((~pdf["k"].isin(pdim["k"])).sum()))


def test_session_enables_adaptive_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_split_lookup_hot_key(spark):
    from strata.operators import frequent_keys, lookup_split
    df = skewed(spark).withColumn("k", F.when(F.col("v") % 11 != 5, F.col("k")))
    dim = spark.range(0, 1500).select(F.col("id").cast("int").alias("key"), (F.col("id") * 10).alias("attr"))
    hot = frequent_keys(df, ["k"], share=0.01)
    assert hot.count() == 1
    for required in (True, False):
        want = sorted(map(str, lookup(df, dim, {"k": "key"}, ["attr"], required).collect()))
        got = lookup_split(df, dim, {"k": "key"}, ["attr"], required, share=0.01)
        assert got.columns == ["k", "ts", "v", "attr"] and sorted(map(str, got.collect())) == want
    # two keys, none of them hot; a table without rows
    two = lookup_split(df.withColumn("p", F.lit("x")), dim.withColumn("q", F.lit("x")), [("k", "key"), ("p", "q")], {"attr": "a2"}, False)
    assert two.count() == N and two.where("a2 IS NOT NULL").count() == lookup(df, dim, {"k": "key"}, ["attr"]).count()
    assert lookup_split(df.limit(0), dim, {"k": "key"}, ["attr"], False).count() == 0
    # the hot key's rows are not shuffled by the key, however large the dimension
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = lookup_split(df, dim, {"k": "key"}, ["attr"], False, share=0.01)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        assert out.groupBy("k").count().where("k = 0").first()["count"] == df.where("k = 0").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_left_lookup_reads_only_used_columns(spark, tmp_root):
    spark.range(100).selectExpr("id", "id % 7 AS k", "id AS a", "id AS b", "id AS c").write.parquet(f"{tmp_root}/f")
    fact = spark.read.parquet(f"{tmp_root}/f")
    dim = spark.range(7).selectExpr("id AS k", "id * 2 AS x")
    plan = lookup(fact, dim, "k", ["x"], required=False).select("a", "x")._jdf.queryExecution().executedPlan().toString()
    schema = [line for line in plan.split("\n") if "FileScan" in line][0].split("ReadSchema: ")[1]
    assert "a:" in schema and "k:" in schema and "b:" not in schema and "c:" not in schema
