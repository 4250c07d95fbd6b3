"""Micro-batches of a stream: late rows, repeats and a replay."""

from pyspark.sql import functions as F

from strata.operators.incremental import VersionedTable
from strata.session import child_names, delete_path
from strata.streaming import run_available_now


def files(spark, root):
    rows = [(i, f"2024-01-{1 + i % 28:02d} 00:00:00", i * 10) for i in range(90)]
    for n, part in enumerate([rows[:30], rows[20:60], rows[55:], [(500, "2024-01-01 00:00:00", 1)], rows[:5]]):
        spark.createDataFrame(part, "id long, t string, v long").withColumn("t", F.col("t").cast("timestamp")) \
             .coalesce(1).write.parquet(f"{root}/in/part={n}")
    return rows


def load(spark, root, seen, **options):
    schema = spark.read.parquet(f"{root}/in/part=0").schema

    def note(batch):
        seen.append(batch.count())
        return batch
    return run_available_now(spark, f"{root}/in/part=*", schema, note, f"{root}/table", ["id"], f"{root}/_checkpoint",
                             max_files_per_trigger=1, **options)


def lose_last_commit(spark, root):
    commits = sorted(int(n) for n in child_names(spark, f"{root}/_checkpoint/commits") if n.isdigit())
    delete_path(spark, f"{root}/_checkpoint/commits/{commits[-1]}")


def test_micro_batches_late_rows_and_replay(spark, tmp_root):
    rows, seen = files(spark, tmp_root), []
    got = load(spark, tmp_root, seen, repeats=(["id"], "t", "60 days"))
    # repeats within the delay never reach the merge, the late row does
    assert seen[:4] == [30, 30, 30, 1] and sum(seen) == 91
    want = sorted([(r[0], r[2]) for r in rows] + [(500, 1)])
    assert sorted((r.id, r.v) for r in got.collect()) == want
    table = VersionedTable(spark, f"{tmp_root}/table")
    version = table.current_version()
    lose_last_commit(spark, tmp_root)
    again = load(spark, tmp_root, seen, repeats=(["id"], "t", "60 days"))
    assert table.current_version() == version and sorted((r.id, r.v) for r in again.collect()) == want


def test_replay_is_not_merged_again(spark, tmp_root):
    files(spark, tmp_root)
    seen = []
    load(spark, tmp_root, seen)
    assert seen == [30, 40, 35, 1, 5]
    table = VersionedTable(spark, f"{tmp_root}/table")
    version = table.current_version()
    lose_last_commit(spark, tmp_root)
    load(spark, tmp_root, seen)
    assert len(seen) == 5 and table.current_version() == version and table.has_epoch(4) and not table.has_epoch(5)


def test_replay_into_partitions(spark, tmp_root):
    files(spark, tmp_root)
    seen = []
    options = dict(partition_by=["v"], collapse_order=["t"])
    got = load(spark, tmp_root, seen, **options)
    assert len(seen) == 5 and got.count() == 91
    lose_last_commit(spark, tmp_root)
    assert load(spark, tmp_root, seen, **options).count() == 91 and len(seen) == 5
