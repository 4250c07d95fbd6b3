import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import (VersionedTable, dim_from_groups,
                              incremental_slice, latest_per_key, lookup, orphans, sync_columns,
                              upsert, upsert_table)
from strata.sources import tag_union, with_row_id, rekey_tenant, scrub_null_text


def _key(t):
    return tuple((x is not None, x if x is not None else 0) for x in t)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)


# ------------------------------------------------------------------ dedup

def test_latest_per_key_latest_and_null_last(spark):
    df = spark.createDataFrame([
        ("a", "2025-01-02", 1), ("a", "2025-01-03", 2), ("a", None, 3),
        ("b", None, 4), ("b", "bad", 5)], "k string, ts string, v int")
    out = latest_per_key(df, ["k"], [F.col("ts").try_cast("timestamp").desc_nulls_last()])
    assert rows(out, "k", "v") == [("a", 2), ("b", 4)]


def test_latest_per_key_tie_is_deterministic_across_partitionings(spark):
    data = [("k%d" % (i % 5), "2025-01-01", i % 3, "x%d" % i) for i in range(200)]
    df = spark.createDataFrame(data, "k string, ts string, a int, b string")
    order = [F.col("ts").desc_nulls_last()]
    r1 = rows(latest_per_key(df.repartition(1), ["k"], order), "k", "a", "b")
    r7 = rows(latest_per_key(df.repartition(7), ["k"], order), "k", "a", "b")
    assert r1 == r7 and len(r1) == 5


def test_latest_per_key_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# ----------------------------------------------------------------- lookup

def test_lookup_required_and_optional(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, code string")
    dim = spark.createDataFrame([("a", 10), ("b", 20)], "code string, k int")
    inner = lookup(fact, dim, "code", ["k"], required=True)
    left = lookup(fact, dim, "code", {"k": "dim_k"}, required=False)
    assert rows(inner, "id", "k") == [(1, 10), (2, 20)]
    assert rows(left, "id", "dim_k") == [(1, 10), (2, 20), (3, None)]


def test_lookup_composite_key(spark):
    fact = spark.createDataFrame([("G1", 1), ("G1", 2)], "gate string, park int")
    dim = spark.createDataFrame([("G1", 1, "k1"), ("G1", 2, "k2")], "g string, p int, key string")
    out = lookup(fact, dim, [("gate", "g"), ("park", "p")], ["key"])
    assert rows(out, "gate", "park", "key") == [("G1", 1, "k1"), ("G1", 2, "k2")]


def test_left_lookup_spreads_rows_without_key(spark):
    fact = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN cast(id AS string) END AS code")
    dim = spark.range(0, 1000, 20).selectExpr("cast(id AS string) AS code", "id AS k")
    out = lookup(fact, dim, "code", ["k"], required=False)
    assert out.columns == ["id", "code", "k"]
    assert out.count() == 1000 and out.filter("k IS NOT NULL").count() == 50
    plan = lookup(fact, dim.hint("merge"), "code", ["k"], required=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "__spread" in plan and "__zero" in plan  # both are join keys, neither is folded away


def test_orphans_nullable(spark):
    child = spark.createDataFrame([("a",), ("z",), (None,), ("None",)], "fk string")
    parent = spark.createDataFrame([("a",)], "pk string")
    assert rows(orphans(child, parent, "fk", "pk"), "fk") == [(None,), ("None",), ("z",)]
    assert rows(orphans(child, parent, "fk", "pk", nullable=True, null_texts=("None",)), "fk") == \
        [("z",)]


def test_dim_from_groups_independent_max(spark):
    df = spark.createDataFrame([("g", "SF", "A", "Z3"), ("g", "SF", "B", "Z1")],
                               "gate_id string, park string, loc string, zone string")
    out = dim_from_groups(df, ["gate_id", "park"], {"loc": "max", "zone": "max"})
    assert rows(out, "loc", "zone") == [("B", "Z3")]  # a pair that no input row holds


# ------------------------------------------------------------ incremental

def test_upsert_replaces_and_appends_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = upsert(target, batch, ["k"])
    twice = upsert(once, batch, ["k"])
    assert rows(once, "k", "v") == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(twice, "k", "v") == rows(once, "k", "v")


def test_upsert_collapses_repeated_batch_keys(spark):
    batch = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, v string, ts int")
    out = upsert(None, batch, ["k"], collapse_order=[F.col("ts").desc()])
    assert rows(out, "k", "v") == [(1, "y")]


def test_sync_columns(spark):
    old = spark.createDataFrame([(1, "x", 5)], "k int, gone string, n int")
    new = spark.createDataFrame([(2, 7, "y")], "k int, n long, added string")
    out = sync_columns(old, new.schema)
    assert out.columns == ["k", "n", "added"]
    assert dict(out.dtypes)["n"] == "bigint"
    assert rows(upsert(old, new, ["k"]), "k", "n", "added") == [(1, 5, None), (2, 7, "y")]


def test_incremental_slice_rules(spark):
    src = spark.createDataFrame([("2025-01-01 00:00:00",), ("2025-01-03 00:00:00",)], "ts string")
    tgt = spark.createDataFrame([(dt.datetime(2025, 1, 2),)], "wm timestamp")
    empty = tgt.limit(0)
    assert incremental_slice(src, "ts", None, "wm").count() == 2
    assert incremental_slice(src, "ts", tgt, "wm").count() == 1
    assert incremental_slice(src, "ts", empty, "wm").count() == 2
    assert incremental_slice(src, "ts", empty, "wm", empty_target="none").count() == 0


def test_versioned_table_two_batches(spark, tmp_root):
    path = f"{tmp_root}/silver_x"
    b1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b2 = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    upsert_table(spark, path, b1, ["k"])
    out = upsert_table(spark, path, b2, ["k"])
    assert rows(out, "k", "v") == [(1, "a"), (2, "B"), (3, "c")]
    t = VersionedTable(spark, path)
    assert t.current_version() == 2
    assert rows(t.read(version=1), "k", "v") == [(1, "a"), (2, "b")]
    assert upsert_table(spark, path, b2.limit(0), ["k"]).count() == 3 and t.current_version() == 2
    assert t.vacuum(keep=1) == [1] and t.read().count() == 3


def test_versioned_table_survives_a_stop_between_its_steps(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/silver_y"
    b1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b2 = spark.createDataFrame([(3, "c")], "k int, v string")
    t = VersionedTable(spark, path)
    assert t.read() is None

    def stop(*args):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:  # before the first record
        m.setattr(VersionedTable, "_publish", stop)
        with pytest.raises(RuntimeError):
            upsert_table(spark, path, b1, ["k"])
    assert t.current_version() is None
    upsert_table(spark, path, b1, ["k"])
    with monkeypatch.context() as m:  # data written, record missing
        m.setattr(VersionedTable, "_publish", stop)
        with pytest.raises(RuntimeError):
            upsert_table(spark, path, b2, ["k"])
    assert rows(t.read(), "k", "v") == [(1, "a"), (2, "b")]
    assert rows(upsert_table(spark, path, b2, ["k"]), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(Exception):  # a second writer of the same version
        t._publish(2, "other")
    assert t.read().count() == 3


def test_a_batch_with_repeated_keys_is_rejected(spark, tmp_root):
    from strata.operators import upsert_partitions
    batch = spark.createDataFrame([(1, "a", "x"), (1, "b", "x")], "k int, v string, day string")
    with pytest.raises(ValueError):
        upsert_table(spark, f"{tmp_root}/r", batch, ["k"])
    with pytest.raises(ValueError):
        upsert_partitions(spark, f"{tmp_root}/r2", batch, ["k"], ["day"])
    assert upsert_table(spark, f"{tmp_root}/r", batch, ["k"], collapse_order=["v"]).first()["v"] == "b"


def test_slice_per_source_takes_late_and_equal_instants(spark):
    mk = lambda r: spark.createDataFrame(r, "region string, ts string")
    src = mk([("sf", "2025-01-01 10:00:00"), ("SF ", "2025-01-01 09:00:00"), ("aq", "2025-01-01 08:00:00"),
              ("aq", "2025-01-01 09:30:00"), (None, "2024-01-01 00:00:00"), ("new", "2020-01-01 00:00:00")])
    stored = mk([("SF", "2025-01-01 10:00:00"), ("AQ", "2025-01-01 08:00:00")]).selectExpr("region", "cast(ts AS timestamp) AS ts")
    got = incremental_slice(src, "ts", stored, "ts", by="region", inclusive=True)
    assert got.columns == ["region", "ts"]
    assert sorted((r.region or "", r.ts[11:16]) for r in got.collect()) == [
        ("", "00:00"), ("aq", "08:00"), ("aq", "09:30"), ("new", "00:00"), ("sf", "10:00")]


# ---------------------------------------------------------------- sources

def test_tag_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, id int")
    out = tag_union({"SF": a, "AQ": b})
    assert rows(out, "id", "v", "source_region") == [(1, "x", "SF"), (2, "y", "AQ")]
    assert out.filter("source_region = 'AQ'").count() == 1


def test_rekey_tenant_and_scrub(spark):
    df = spark.createDataFrame([("SF-CUST-1", "SF", "None", 3)],
                               "id string, park_code string, tier string, n int")
    out = rekey_tenant(df, "SF-", "AQ-", {"park_code": "AQ"}).first()
    assert (out.id, out.park_code, out.tier, out.n) == ("AQ-CUST-1", "AQ", None, 3)
    s = scrub_null_text(spark.createDataFrame([("NULL", "nan", 1)], "a string, b string, c int"))
    assert tuple(s.first()) == (None, None, 1)


def test_with_row_id_consecutive(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 7 % 1000).alias("x"))
    out = with_row_id(df, ["x"])
    got = rows(out, "bronze_id", "x")
    assert [g[0] for g in got] == list(range(1, 1001))
    assert all(g[1] == g[0] - 1 for g in got)
    assert out.columns[0] == "bronze_id"


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_row_ids_of_a_wide_table_with_a_repeated_order_key(spark, coalesce):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        df = spark.range(300_000).selectExpr("id % 50 AS k", "id", *[f"concat('text', id * {i}) AS c{i}" for i in range(1, 6)])
        ids = with_row_id(df, ["k"]).agg(F.count("*"), F.countDistinct("bronze_id"), F.min("bronze_id"), F.max("bronze_id")).first()
        assert tuple(ids) == (300_000, 300_000, 1, 300_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_landing_load_maps_nan_and_timestamps(spark, tmp_root):
    from strata.sources import write_landing
    df = spark.sql("SELECT 1 AS id, double('NaN') AS x, float('NaN') AS y, timestamp_ntz '2025-01-01 10:00:00' AS t "
                   "UNION ALL SELECT 1, 2.0D, float(3), NULL")
    assert write_landing(df, tmp_root, "sf_x", order_by=["id"])
    out = spark.read.parquet(f"{tmp_root}/landing_zone/sf_x")
    assert dict(out.dtypes) == {"bronze_id": "bigint", "id": "int", "x": "double", "y": "float", "t": "timestamp"}
    assert out.filter("x IS NULL AND y IS NULL").count() == 1 and out.filter("isnan(x) OR isnan(y)").count() == 0


def test_salted_lookup_same_result(spark):
    fact = spark.createDataFrame([(i, "hot" if i % 3 else "cold") for i in range(60)] + [(99, None)],
                                 "id int, code string")
    dim = spark.createDataFrame([("hot", 1), ("cold", 2)], "code string, k int")
    plain = rows(lookup(fact, dim, "code", ["k"], required=False), "id", "k")
    salted = lookup(fact, dim, "code", ["k"], required=False, salt=4, salt_by=["id"])
    assert rows(salted, "id", "k") == plain
    assert "__salt" not in salted.columns


def test_orphan_count_preaggregates(spark):
    from strata.operators.quality import orphan_count
    child = spark.createDataFrame([("a",)] * 50 + [("z",)] * 3, "fk string")
    parent = spark.createDataFrame([("a",)], "pk string")
    r = orphan_count(child, "fk", parent, "pk").first()
    assert (r.total, r.orphans) == (53, 3)


def test_upsert_partitions_rewrites_only_touched(spark, tmp_root):
    import glob
    import os
    from strata.operators import upsert_partitions
    path = f"{tmp_root}/facts"
    first = spark.createDataFrame([(1, "a", "2025-01-01"), (2, "b", "2025-01-01"), (3, "c", "2025-01-02"),
                                   (4, "d", "2025-01-03")], "k int, v string, day string")
    upsert_partitions(spark, path, first, ["k"], ["day"])
    untouched = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/day=2025-01-0[23]/*.parquet")}
    batch = spark.createDataFrame([(2, "B", "2025-01-01"), (5, "e", "2025-01-01")], "k int, v string, day string")
    out = upsert_partitions(spark, path, batch, ["k"], ["day"])
    assert rows(out, "k", "v", "day") == [(1, "a", "2025-01-01"), (2, "B", "2025-01-01"),
                                          (3, "c", "2025-01-02"), (4, "d", "2025-01-03"),
                                          (5, "e", "2025-01-01")]
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{path}/day=2025-01-0[23]/*.parquet")} == untouched


def test_upsert_partitions_prunes_at_scan(spark, tmp_root):
    from strata.operators import upsert_partitions
    path = f"{tmp_root}/pruned"
    base = spark.range(100).selectExpr("id as k", "'x' as v", "cast(id % 10 as string) as day")
    upsert_partitions(spark, path, base, ["k"], ["day"])
    stored = spark.read.schema(base.schema).parquet(path)
    plan = stored.filter("day = '3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    batch = spark.createDataFrame([(3, "y", "3")], "k long, v string, day string")
    out = upsert_partitions(spark, path, batch, ["k"], ["day"])
    assert out.count() == 100 and out.filter("v = 'y'").count() == 1


def test_upsert_partitions_many_partitions_and_moved_keys(spark, tmp_root):
    from strata.operators import upsert_partitions
    path = f"{tmp_root}/many"
    base = spark.range(600).selectExpr("id AS k", "'x' AS v", "cast(id AS string) AS day").repartition(4, "day")
    upsert_partitions(spark, path, base, ["k"], ["day"])
    out = upsert_partitions(spark, path, base.selectExpr("k", "'y' AS v", "day"), ["k"], ["day"])
    assert out.count() == 600 and out.filter("v = 'y'").count() == 600
    moved = spark.createDataFrame([(3, "z", "4")], "k long, v string, day string")
    with pytest.raises(ValueError):
        upsert_partitions(spark, path, moved, ["k"], ["day"])
    assert spark.read.parquet(path).count() == 600


def test_scale_conf_sizes_partitions():
    from strata.session import scale_conf
    c = scale_conf(30 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 163840
    assert int(scale_conf(10 * 1024 ** 2, 8)["spark.sql.shuffle.partitions"]) == 16


def test_latest_split_is_latest_per_key_and_leaves_single_rows(spark):
    from strata.operators.dedup import latest_split
    df = spark.range(400, numPartitions=5).select(
        F.when(F.col("id") % 50 != 7, F.concat(F.lit("K-"), F.when(F.col("id") < 40, F.col("id") % 13).otherwise(F.col("id")).cast("string"))).alias("k"),
        (F.col("id") % 3).alias("p"), F.when(F.col("id") % 4 != 1, F.col("id") % 5).alias("ts"), (F.col("id") % 7).alias("v"))
    df = df.unionAll(df.where("v = 2"))
    want = rows(latest_per_key(df, ["k", "p"], ["ts"]), *df.columns)
    for buckets in (1, 8, 1 << 20):  # all rows ranked, some, only repeated keys
        assert rows(latest_split(df, ["k", "p"], ["ts"], buckets=buckets), *df.columns) == want
    assert latest_split(df.where("false"), ["k"], ["ts"]).count() == 0


def test_transactions_of_one_key_are_not_ranked(spark):
    """Only lines that share their key reach the ranking's shuffle."""
    from strata.plans.silver import build_silver_transactions
    from strata.plans import driver_tables as D
    plan = build_silver_transactions(D.landing(spark, "/root/testdata/sf0.001", "raw_transactions"))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and plan.index("Union") < plan.index("Window")
    ranked = build_silver_transactions(D.landing(spark, "/root/testdata/sf0.001", "raw_transactions"), repeats=True)
    assert "LeftAnti" not in ranked._jdf.queryExecution().optimizedPlan().toString()


def test_first_load_is_written_once(spark, tmp_root, monkeypatch):
    from strata.operators import incremental
    from strata.session import child_names
    monkeypatch.setattr(incremental, "settled_batch", None)  # a first load needs no copy of its batch
    path = f"{tmp_root}/once"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    with pytest.raises(ValueError, match="repeats keys"):
        upsert_table(spark, path, df.unionAll(df), ["k"])
    assert VersionedTable(spark, path).read() is None and not child_names(spark, f"{path}/data")
    assert rows(upsert_table(spark, path, df, ["k"]), "k", "v") == rows(df, "k", "v")
    folder = child_names(spark, f"{path}/data")[0]
    assert any(".zstd." in n for n in child_names(spark, f"{path}/data/{folder}"))


@pytest.mark.parametrize("share", [0.005, 0.3, 1.0])
def test_latest_spread_is_latest_per_key_and_sorts_once(spark, share):
    from strata.operators.dedup import latest_spread
    df = spark.range(900, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 != 7, F.concat(F.lit("K-"), (F.col("id") % 211).cast("string"))).alias("k"),
        (F.col("id") % 2).alias("p"), F.when(F.col("id") % 4 != 1, F.col("id") % 5).alias("ts"), (F.col("id") % 7).alias("v"))
    df = df.unionAll(df.where("v = 2"))
    out = latest_spread(df, ["k", "p"], ["ts"], share=share)
    assert out.columns == df.columns
    assert rows(out, *df.columns) == rows(latest_per_key(df, ["k", "p"], ["ts"]), *df.columns)
    assert latest_spread(df.where("false"), ["k", "p"], ["ts"]).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    # few rows a key: nothing is sorted before the shuffle; hot keys: limited in each task before it
    spread, limited = plan.split("REPARTITION_BY_COL")[0], plan.split("REPARTITION_BY_COL")[1]
    assert "WindowGroupLimit" in spread and "WindowGroupLimit" in limited.split("ENSURE_REQUIREMENTS", 1)[1]


def test_ride_records_are_sorted_after_their_shuffle_only(spark):
    from strata.plans import driver_tables as D
    from strata.plans.silver import build_silver_ride_operations
    plan = build_silver_ride_operations(D.landing(spark, "/root/testdata/sf0.001", "raw_ride_operations"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("REPARTITION_BY_COL") < plan.index("LeftAnti") < plan.rindex("WindowGroupLimit")
    assert "WindowGroupLimit" not in plan[plan.index("REPARTITION_BY_COL"):plan.index("LeftAnti")]


def test_two_tenants_join_their_lines_twice_only(spark):
    from strata.plans import extra_queries as X
    plan = X.two_tenants("raw_transactions")(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [" in line and "l_linenumber" in line for line in plan.split("\n")) == 2


def test_landed_lines_meet_orders_that_have_their_region(spark, tmp_root):
    """The lines are in the outermost join only; rows are those of the SQL, with null and repeated keys."""
    import duckdb

    from strata.plans import driver_tables as D
    src = "/root/testdata/sf0.001"
    for t in ("nation", "region"):
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(f"{tmp_root}/{t}.parquet")
    c = spark.read.parquet(f"{src}/customer.parquet")
    c.withColumn("c_nationkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey"))).unionAll(c.where("c_custkey < 9")).write.parquet(f"{tmp_root}/customer.parquet")
    o = spark.read.parquet(f"{src}/orders.parquet")
    o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey"))).unionAll(o.where("o_orderkey < 40")).write.parquet(f"{tmp_root}/orders.parquet")
    li = spark.read.parquet(f"{src}/lineitem.parquet").where("l_orderkey < 400")
    li.withColumn("l_orderkey", F.when(F.col("l_linenumber") != 6, F.col("l_orderkey"))).write.parquet(f"{tmp_root}/lineitem.parquet")
    landed = D.landing(spark, tmp_root, "raw_transactions").select("source_transaction_id", "park_code", "customer_id")
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_root}/{t}.parquet/*.parquet')")
    want = con.execute(f"SELECT source_transaction_id, park_code, customer_id FROM ({D.landing_sql('raw_transactions')})").fetchall()
    text = lambda found: sorted(map(str, map(tuple, found)))
    assert text(landed.collect()) == text(want) and len(want) > 100
    plan = D.landing(spark, tmp_root, "raw_transactions")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Join LeftOuter")


def test_write_landing_does_not_look_at_its_input_first(spark, tmp_root, monkeypatch):
    from strata.session import child_names
    from strata.sources import write_landing
    df = spark.createDataFrame([("b",), ("a",)], "a string")
    monkeypatch.setattr(df, "isEmpty", None)
    assert write_landing(df, tmp_root, "sf_x", order_by=["a"]) is True
    assert write_landing(df.where("false"), tmp_root, "sf_y", order_by=["a"]) is False
    assert child_names(spark, f"{tmp_root}/landing_zone") == ["sf_x"]
