"""Tables of the layers: publishing, bucketed merges, appended bronze, schema changes, replays."""

import pytest
from pyspark.sql import functions as F

from strata.operators.incremental import VersionedTable, partitions_since, region_marks, upsert_table
from strata.session import child_names
from strata.sources.catalog import AppendedTable, BucketedTable, LayerCatalog


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


class Stop(Exception):
    pass


def catalog(spark, root):
    return LayerCatalog(spark, root, prefix="t" + root.rsplit("-", 1)[1].replace("_", "x").lower() + "_")


# -------------------------------------------------------------- full refresh
def test_readers_see_the_old_or_the_new_table(spark, tmp_root, monkeypatch):
    c = catalog(spark, tmp_root)
    old, new = spark.range(5).withColumn("v", F.lit("old")), spark.range(9).withColumn("w", F.lit("new"))
    c.publish(old, "gold", "d")
    view = f"{c.schema('gold')}.d"

    def both():
        spark.catalog.refreshTable(view)
        return rows(spark.table(view)), rows(c.table("gold", "d"))

    was, will = rows(old), rows(new)
    assert both() == (was, was)
    # stopped before anything is written, and in the middle of writing
    broken = new.select("*", F.when(F.col("id") == 7, F.raise_error(F.lit("stop"))).otherwise(F.lit(1)).alias("x"))
    with pytest.raises(Exception):
        c.publish(broken, "gold", "d")
    assert both() == (was, was)
    (spark.range(3).write.parquet(c.new_folder("gold", "d") + "x"))  # not a version's name
    spark.range(2).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(c.new_folder("gold", "d"))
    assert both() == (was, was)
    # stopped between writing and swapping: each way of reading gives one whole table
    with monkeypatch.context() as m:
        m.setattr(LayerCatalog, "swap", lambda *a: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            c.publish(new, "gold", "d")
    assert both() == (was, will)
    assert c.register("gold", "d") and both() == (will, will)
    # a table may be built from itself
    c.publish(c.table("gold", "d").where("id < 4"), "gold", "d")
    assert both()[0] == [r for r in will if r[0] < 4] == both()[1]
    held = c.table("gold", "d")
    c.publish(old, "gold", "d")
    assert len(rows(held)) == 4  # a reader of an older version is not disturbed
    c.vacuum("gold", "d", keep=1)
    assert both() == (was, was) and len(c.versions("gold", "d")) == 1
    assert c.table("gold", "none") is None and not c.register("gold", "none")


# ----------------------------------------------------------------- commit log
def test_half_a_record_does_not_lock_the_table(spark, tmp_root):
    path = f"{tmp_root}/t"
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")

    def leave(number):
        spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log/{number:012d}/_temporary/0").getFileSystem(
            spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log/{number:012d}/_temporary/0"))

    leave(1)
    assert VersionedTable(spark, path).read() is None and VersionedTable(spark, path).current_version() is None
    assert rows(upsert_table(spark, path, first, ["k"])) == [(1, "a"), (2, "b")]
    leave(3)
    leave(4)
    got = upsert_table(spark, path, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"])
    assert rows(got) == [(1, "a"), (2, "c"), (3, "d")]
    assert VersionedTable(spark, path).current_version() == 5
    assert rows(upsert_table(spark, path, spark.createDataFrame([(1, "e")], "k int, v string"), ["k"])) == [(1, "e"), (2, "c"), (3, "d")]
    VersionedTable(spark, path).vacuum(keep=1)
    assert rows(VersionedTable(spark, path).read()) == [(1, "e"), (2, "c"), (3, "d")]


def test_a_batch_is_computed_once(spark, tmp_root):
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    for start in (0, 50):
        batch = spark.range(start, start + 100, numPartitions=2).mapInPandas(note, "id long")
        upsert_table(spark, f"{tmp_root}/t", batch, ["id"])
    assert seen.value == 200 and VersionedTable(spark, f"{tmp_root}/t").read().count() == 150


# -------------------------------------------------------------- bucketed merge
def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges_above(plan, scan):
    """Exchanges on the paths from the root to the scans whose line has ``scan``."""
    depth, found = [], []
    for line in plan.split("\n"):
        text = line.lstrip(" :+-*()0123456789")
        level = len(line) - len(line.lstrip(" :+-"))
        depth = [d for d in depth if d[0] < level] + [(level, text)]
        if scan in line:
            found.append(sum(t.startswith("Exchange") for _, t in depth))
    return found


def test_bucketed_merge_shuffles_the_batch_only(spark, tmp_root):
    c = catalog(spark, tmp_root)
    t = BucketedTable(c, "silver", "s", ["k", "p"], 4)
    assert t.read() is None
    first = spark.range(400).select(F.col("id").alias("k"), F.when(F.col("id") % 10 > 0, (F.col("id") % 7).cast("string")).alias("p"),
                                    F.lit("old").alias("v"))
    t.merge(first)
    batch = first.where("k % 3 = 0").withColumn("v", F.lit("new")).union(spark.createDataFrame([(900, None, "new"), (901, "x", "new")], "k long, p string, v string"))
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = plan_of(t.merged(t.read().where("k IS NOT NULL AND p IS NOT NULL"), batch.where("p IS NOT NULL")))
        scans = exchanges_above(plan, "Bucketed: true")
        assert scans and set(scans) == {0}, plan
        assert "Exchange" in plan  # the batch's
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    got = t.merge(batch)
    want = {(r[0], r[1]): r for r in rows(first)} | {(r[0], r[1]): r for r in rows(batch)}
    assert rows(got) == sorted(want.values(), key=str) == rows(t.read())
    assert rows(spark.table(f"{c.schema('silver')}.s")) == rows(got)
    assert rows(t.merge(batch.limit(0))) == rows(got)
    # another session's catalog knows nothing yet: the buckets are declared over the folder again
    again = BucketedTable(LayerCatalog(spark, tmp_root, c.prefix + "z_"), "silver", "s", ["k", "p"], 4)
    assert rows(again.read()) == rows(got) and "Bucketed: true" in plan_of(again.read().groupBy("k", "p").count())
    with pytest.raises(ValueError):
        t.merge(batch.union(batch))
    wider = t.merge(spark.createDataFrame([(1, "1", "w", 5)], "k long, p string, v string, extra int"))
    assert wider.columns == ["k", "p", "v", "extra"] and wider.where("extra = 5").count() == 1 and wider.count() == got.count()


# ------------------------------------------------------------- appended bronze
def test_appended_batches_count_when_complete(spark, tmp_root):
    t = AppendedTable(spark, f"{tmp_root}/raw", ["region", "day"])
    assert t.read() is None and t.append(spark.createDataFrame([], "v int, region string, day date")) is None
    one = spark.sql("SELECT 1 AS v, 'SF' AS region, DATE '2024-01-01' AS day UNION ALL SELECT 2, 'AQ', NULL")
    t.append(one)
    t.append(spark.sql("SELECT 3 AS v, 'SF' AS region, DATE '2024-01-05' AS day"))
    assert rows(t.read(one.schema).select("v", "region")) == [(1, "SF"), (2, "AQ"), (3, "SF")]
    last = t.batches()[-1]
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{tmp_root}/raw/{last}/_SUCCESS")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False)  # its writer stopped before the end
    assert rows(t.read(one.schema).select("v")) == [(1,), (2,)]
    t.append(spark.sql("SELECT 4 AS v, 'SF' AS region, DATE '2024-01-09' AS day"))
    assert rows(t.read(one.schema).select("v")) == [(1,), (2,), (4,)]
    marks = region_marks(t.read(one.schema).where("region = 'SF'").select("region", F.col("day").alias("wm")), "wm", "region")
    since = partitions_since(t.read(one.schema), marks, "region", "day")
    assert rows(since.select("v")) == [(2,), (4,)]  # AQ has no mark
    filters = [x for x in plan_of(since).split("PartitionFilters: [")[1].split("]")][0]
    assert "region" in filters and "day" in filters


def test_bronze_second_batch(spark, tmp_root):
    from strata.plans.layers import append_bronze, bronze_table
    from strata.sources.landing import write_landing

    def land(park, data):
        write_landing(spark.createDataFrame(data, "id string, ingestion_timestamp string"), tmp_root, f"{park}_staff", order_by=["id"])

    a, b, day = "2024-01-01 08:00:00", "2024-01-02 08:00:00", "2024-01-02 08:00:01"
    land("sf", [("1", a), ("2", b), ("3", None), ("3", None)])
    land("aq", [("1", a)])
    once = append_bronze(spark, tmp_root, "staff")
    assert once.count() == 5
    n = len(bronze_table(spark, tmp_root, "staff").batches())
    assert append_bronze(spark, tmp_root, "staff").count() == 5 and len(bronze_table(spark, tmp_root, "staff").batches()) == n
    # the same instant again with another row, a later one, an earlier one (loaded before), a new row without an instant
    land("sf", [("0", a), ("2", b), ("4", b), ("5", day), ("3", None), ("6", None)])
    got = append_bronze(spark, tmp_root, "staff")
    assert sorted((r.id, r.source_region) for r in got.collect()) == [
        ("1", "AQ"), ("1", "SF"), ("2", "SF"), ("3", "SF"), ("3", "SF"), ("4", "SF"), ("5", "SF"), ("6", "SF")]


# --------------------------------------------- schema changes of a partitioned table
def test_partitions_of_any_schema(spark, tmp_root):
    from strata.operators import upsert_partitions
    path, by = f"{tmp_root}/p", ["day"]
    upsert_partitions(spark, path, spark.createDataFrame([(1, "a", 5, "old"), (2, "b", 6, "old"), (3, "c", 7, "old")], "k int, day string, n int, gone string"), ["k"], by)
    # one column added, one dropped, one widened; partition c is not touched
    batch = spark.createDataFrame([(1, "a", 1 << 40, "x"), (4, "b", 9, "y")], "k int, day string, n long, extra string")
    files = lambda: {f for f in spark.read.parquet(path).inputFiles() if "day=c" in f}
    before = files()
    got = upsert_partitions(spark, path, batch, ["k"], by)
    assert rows(got.select("k", "day", "n", "extra")) == [(1, "a", 1 << 40, "x"), (2, "b", 6, None), (3, "c", 7, None), (4, "b", 9, "y")]
    assert "gone" not in got.columns and files() == before
    # another kind of type: every partition is rewritten
    batch = spark.createDataFrame([(4, "b", "nine", 1.5)], "k int, day string, n string, extra double")
    got = upsert_partitions(spark, path, batch.drop("extra"), ["k"], by)
    assert rows(got.select("k", "day", "n")) == [(1, "a", str(1 << 40)), (2, "b", "6"), (3, "c", "7"), (4, "b", "nine")] and files() != before
    assert rows(spark.read.parquet(path).select("k", "n")) == rows(got.select("k", "n"))
