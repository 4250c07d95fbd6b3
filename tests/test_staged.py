"""Wide steps in stored slices: the rows of the plan in one piece, little left on disk."""

import pytest
from pyspark.sql import functions as F

from strata.operators import latest_per_key, lookup
from strata.operators import staged
from strata.operators.dedup import latest_sliced
from strata.operators.incremental import upsert, upsert_stored
from strata.session import child_names
from strata.sources.catalog import BucketedTable, LayerCatalog
from strata.sources.landing import with_row_id, write_landing


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture()
def sliced(monkeypatch):
    """Tables of any size count as large."""
    monkeypatch.setattr(staged, "SLICE_BYTES", 1)


def lines(spark, n=300):
    return spark.range(n, numPartitions=4).select(
        F.concat(F.lit("T-"), F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("P-"), (F.col("id") % 23).cast("string"))).alias("p"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("C-"), (F.col("id") % 17).cast("string"))).alias("c"),
        (F.col("id") % 3).alias("v"))


def test_lookups_in_slices_are_the_lookups(spark, sliced):
    fact = lines(spark)
    fact = fact.unionAll(fact.where("v = 1"))
    dim = lambda x, n: spark.range(n).select(F.concat(F.lit(x), F.col("id").cast("string")).alias("k"), (F.col("id") * 7).alias(f"{x[0].lower()}_key"))
    p, c = dim("P-", 15), dim("C-", 9)
    c = c.unionAll(c.where("c_key = 7"))
    steps = [(p, {"p": "k"}, ["p_key"], True), (c, {"c": "k"}, ["c_key"], False)]
    want = lookup(lookup(fact, p, {"p": "k"}, ["p_key"]), c, {"c": "k"}, ["c_key"], required=False).select("id", "v", "p_key", "c_key")
    stage = staged.Stage(spark)
    got = staged.lookups(fact, steps, ["id", "v"], stage)
    assert got.columns == want.columns and rows(got) == rows(want) and want.count() > 200
    assert len(child_names(spark, stage.root)) == 1  # earlier steps are gone
    stage.clear()
    assert not child_names(spark, stage.root)
    none = staged.lookups(fact.where("v > 5"), steps, ["id"], stage)
    assert none.columns == ["id", "p_key", "c_key"] and none.count() == 0
    assert rows(staged.lookups(fact, steps, ["id", "v"])) == rows(want)  # without a stage: a plan


def test_fact_in_slices_is_the_fact(spark, monkeypatch, tmp_root):
    from strata.plans import gold as G
    silver = lines(spark).withColumn("u", F.md5("id")).selectExpr(
        "u AS transaction_sk", "id AS source_transaction_id", "p AS product_code", "c AS source_customer_id", "CASE WHEN v > 0 THEN 'E-1' END AS cashier_id",
        "'N' AS park_code", "CASE WHEN v < 2 THEN DATE'2024-01-02' END AS transaction_date", "'x' AS terminal_id", "'x' AS booking_reference",
        "'x' AS payment_method", "'x' AS transaction_status", "'x' AS sales_channel", "true AS is_group_booking", "1 AS group_size", "1 AS quantity",
        "1.5D AS unit_price", "1.5D AS gross_amount", "CASE WHEN v > 0 THEN 0.5D END AS discount_amount", "1D AS net_amount", "1D AS vat_amount", "2D AS total_charged",
        "'r' AS refund_reference_id")
    date = spark.sql("SELECT DATE'2024-01-02' AS full_date, 20240102 AS date_key")
    park = spark.sql("SELECT 'N' AS park_code, 3 AS park_key")
    product = spark.range(20).selectExpr("concat('P-', id) AS product_code", "md5(concat('p', id)) AS product_key")
    customer = spark.range(12).selectExpr("concat('C-', id) AS source_customer_id", "md5(concat('c', id)) AS customer_key")
    staff = spark.sql("SELECT 'E-1' AS source_employee_id, 'S' AS staff_key")
    build = lambda **more: G.build_fact_transaction(silver, date, park, product, customer, staff, "2024-02-01 00:00:00", **more)
    want = build()
    assert want.where("discount_amount = 0").count() > 0 and want.where("customer_key IS NULL").count() > 0
    monkeypatch.setattr(staged, "SLICE_BYTES", 1)
    stage = staged.Stage(spark)
    got = build(stage=stage)
    assert got.schema.simpleString() == want.schema.simpleString() and rows(got) == rows(want)
    keys = build(stage=stage, only=["date_key", "product_key"])
    assert keys.columns == ["date_key", "product_key"] and rows(keys) == rows(want.select("date_key", "product_key"))


def test_ranking_in_slices_is_the_ranking(spark, sliced):
    df = lines(spark).unionAll(lines(spark))
    want = latest_per_key(df, ["p", "c"], ["v"])
    got = latest_sliced(df, ["p", "c"], ["v"])
    assert rows(got) == rows(want) and got.schema.simpleString() == want.schema.simpleString()
    assert latest_sliced(df.where("v > 5"), ["p"], ["v"]).count() == 0


@pytest.mark.parametrize("first", ["p", "v", "n"])
def test_row_ids_in_slices_are_the_row_ids(spark, monkeypatch, first):
    df = lines(spark).withColumn("n", F.when(F.col("v") == 1, F.lit(float("nan"))).otherwise(-F.col("v").cast("double")))
    order = [first, "id"]
    want = rows(with_row_id(df, order, start=5))
    monkeypatch.setattr(staged, "SLICE_BYTES", 1)
    assert rows(with_row_id(df, order, start=5)) == want
    assert with_row_id(df.where("v > 5"), order).count() == 0


@pytest.fixture()
def scratch(monkeypatch, tmp_root):
    """A scratch folder that no other test writes to."""
    monkeypatch.setattr("strata.session.checkpoint_dir", lambda spark: f"{tmp_root}/scratch")
    return f"{tmp_root}/scratch"


def test_a_landing_load_leaves_its_table_only(spark, sliced, scratch, tmp_root):
    assert write_landing(lines(spark), tmp_root, "x", order_by=["id"])
    assert not child_names(spark, scratch)
    got = spark.read.parquet(f"{tmp_root}/landing_zone/x")
    assert sorted(r[0] for r in got.select("bronze_id").collect()) == list(range(1, 301))


def test_stored_merge_is_the_merge(spark):
    old = lines(spark).withColumn("v", F.lit(0))
    new = lines(spark, 400).where("v > 0 OR id LIKE '%7'").drop("v").withColumn("v", F.lit(1))
    want = rows(upsert(old, new, ["id", "p"]))
    for buckets in (1, 7, 1 << 20):
        assert rows(upsert_stored(old, new, ["id", "p"], buckets)) == want
    plan = upsert_stored(old, new, ["id", "p"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 2 and plan.count("LeftSemi") >= 2  # rows of other buckets meet no join of texts
    zero = lambda x, y: spark.createDataFrame([(x, y)], "k double, v string")
    assert rows(upsert_stored(zero(0.0, "a"), zero(-0.0, "b"), ["k"])) == rows(upsert(zero(0.0, "a"), zero(-0.0, "b"), ["k"]))


def test_bucketed_merge_in_parts(spark, sliced, scratch, tmp_root, monkeypatch):
    c = LayerCatalog(spark, tmp_root, "staged_parts_")
    t = BucketedTable(c, "silver", "s", ["id", "p"], 5)
    old, new = lines(spark).withColumn("w", F.lit("old")), lines(spark, 350).where("v > 0").withColumn("w", F.lit("new"))
    assert rows(t.merge(old)) == rows(old)
    assert rows(t.merge(new)) == rows(upsert(old, new, ["id", "p"])) == rows(t.read())
    assert not child_names(spark, scratch)
    # a writer that stops between two parts leaves no version
    from pyspark.sql import DataFrameWriter
    plain, done = DataFrameWriter.saveAsTable, []

    def stops(self, *a, **k):
        if done:
            raise RuntimeError("stopped")
        done.append(1)
        return plain(self, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", stops)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrameWriter.saveAsTable", stops, raising=False)
    before = c.current("silver", "s")
    with pytest.raises(RuntimeError, match="stopped"):
        t.merge(new)
    assert c.current("silver", "s") == before


def test_both_sides_of_the_split_read_one_shuffle(spark, tmp_root):
    from strata.operators.dedup import latest_split
    spark.range(50).selectExpr("id AS k", "id % 7 AS o", "id % 3 AS v").write.parquet(f"{tmp_root}/l")
    spark.range(7).selectExpr("id AS o2", "id * 2 AS x").write.parquet(f"{tmp_root}/o")
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(held, ("-1", "false")):
            spark.conf.set(k, v)
        joined = spark.read.parquet(f"{tmp_root}/l").join(spark.read.parquet(f"{tmp_root}/o"), F.col("o") == F.col("o2")).select("k", "v", "x")
        plan = latest_split(joined, ["k", "v"], ["x"])._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    # one shuffle of the lines serves all three reads of them
    assert sum("Exchange hashpartitioning(o#" in x and "Reused" not in x for x in plan.split("\n")) == 1, plan


def test_checks_go_fact_by_fact(spark):
    """Facts and their silver tables are gone when the next one is written; the report is whole."""
    import os
    from strata.plans.warehouse import GOLD_FACTS, Warehouse, gold_suite, run_gold_suite
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("driver test data not present")
    w = Warehouse.materialized(spark, "/root/testdata/sf0.001", models=[])
    seen = []
    materialize = w.materialize

    def noted(root, models=None, parallel=4):
        seen.append({n for n in w.paths if n in GOLD_FACTS})
        return materialize(root, models, parallel)
    w.materialize = noted
    report = run_gold_suite(w)
    assert all(len(s) == 0 for s in seen) and not {n for n in w.paths if n in GOLD_FACTS or n == "silver_transactions"}
    assert report.count() == sum(len(c) for c in gold_suite(1, 2).values())
