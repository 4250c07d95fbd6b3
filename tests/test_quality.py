from pyspark.sql import functions as F

from strata.operators import quality as Q


def test_unique_single_ignores_null_combination_does_not(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 2), (None, 2), (3, 3)], "a int, b int")
    assert Q.check_unique(df, "a").count() == 1
    assert Q.check_unique(df.filter("a IS NULL"), "a").count() == 0
    assert Q.check_unique(df, "a", "b").count() == 2


def test_not_null_accepted_range_expr_at_least_one_count(spark):
    df = spark.createDataFrame([(1, "A"), (None, "B"), (20, None)], "n int, s string")
    assert Q.check_not_null(df, "n").count() == 1
    acc = Q.check_accepted(df, "s", ["A"]).collect()
    assert [(r.value_field, r.n_records) for r in acc] == [("B", 1)]  # NULL passes
    assert Q.check_range(df, "n", 0, 10).count() == 1                 # NULL passes
    assert Q.check_range(df, "n", min_value=0).count() == 0
    assert Q.check_expr(df, "n < 10").count() == 1
    assert Q.check_at_least_one(df.filter("n IS NULL"), "n").count() == 1
    assert Q.check_at_least_one(df, "n").count() == 0
    assert Q.check_count(df, 3).count() == 0 and Q.check_count(df, 2).count() == 1


def test_fk_null_passes(spark):
    child = spark.createDataFrame([(1,), (None,), (9,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert [r.fk for r in Q.check_fk(child, "fk", parent, "pk").collect()] == [9]


def test_run_suite_folds_and_reports(spark):
    t = spark.createDataFrame([(1, "A"), (1, None)], "k int, s string")
    p = spark.createDataFrame([(1,)], "k int")
    suite = {"t": [Q.Check("not_null", "s"), Q.Check("unique", "k"),
                   Q.Check("accepted_values", "s", values=("A",), severity="warn"),
                   Q.Check("relationships", "k", parent="p", parent_column="k"),
                   Q.Check("row_count", expected=2)]}
    out = {r.test: r for r in Q.run_suite({"t": t, "p": p}, suite).collect()}
    assert out["not_null(s)"].failures == 1 and out["not_null(s)"].status == "FAIL"
    assert out["unique(k)"].failures == 1
    assert out["accepted_values(s)"].failures == 0 and out["accepted_values(s)"].status == "PASS"
    assert out["relationships(k)"].failures == 0 and out["row_count()"].failures == 0


def test_reconcile_threshold_is_truncated(spark):
    gold = spark.range(94)
    silver = spark.range(100)
    r = Q.reconcile([Q.ReconcilePair("f", gold, silver)], failing_only=False).first()
    assert r.failed is True and r.retention_pct == 94.0
    ok = Q.reconcile([Q.ReconcilePair("f", spark.range(95), silver)])
    assert ok.count() == 0


def test_null_fk_report_and_inactive(spark):
    f = spark.createDataFrame([("k1", None, "s1"), ("k2", 1, "s2"), ("k3", 1, None)],
                              "key string, d int, staff_key string")
    rep = {r.validation: r.violation_count for r in
           Q.null_fk_report({"fact": (f, ["d", "staff_key"])}, failing_only=False).collect()}
    assert rep == {"fact — NULL d": 1, "fact — NULL staff_key": 1}
    dim = spark.createDataFrame([("s1", "E1", False, "INACTIVE"), ("s2", "E2", None, "INACTIVE")],
                                "staff_key string, source_employee_id string, is_active boolean, "
                                "staff_status string")
    bad = Q.inactive_dim_rows([("fact", f, "key", "staff_key")], dim, "staff_key").collect()
    assert [(r.fact_table, r.fact_key, r.source_employee_id) for r in bad] == [("fact", "k1", "E1")]


def test_ri_report(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,), ("None",)], "fk string")
    parent = spark.createDataFrame([("a",)], "pk string")
    rep = {r.label: r for r in Q.ri_report([
        Q.Relation("mandatory", child, "fk", parent, "pk"),
        Q.Relation("nullable", child, "fk", parent, "pk", nullable=True)]).collect()}
    assert (rep["mandatory"].total, rep["mandatory"].orphans, rep["mandatory"].status) == (4, 3, "FAIL")
    assert (rep["nullable"].total, rep["nullable"].orphans) == (2, 1)
    assert rep["nullable"].orphan_pct == 50.0


def test_hashed_checks_tell_colliding_keys_apart(spark, monkeypatch):
    from pyspark.sql import functions as F
    from strata.operators import quality as Q
    child = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (2, "c", "y"), (None, "zz", "y"), (None, "q", None), (3, None, None), (4, None, None)], "id int, fk string, p string")
    parent = spark.createDataFrame([("a",), ("c",), ("q",), (None,)], "pk string")
    suite = {"child": [Q.Check("unique", column="id"), Q.Check("unique", column="fk"), Q.Check("unique_combination", columns=["id", "p"]),
                       Q.Check("unique_combination", columns=["p"]), Q.Check("relationships", column="fk", parent="parent", parent_column="pk")]}

    def report():
        return {(r.test): r.failures for r in Q.run_suite({"child": child, "parent": parent}, suite).collect()}
    want = {"unique(id)": 1, "unique(fk)": 0, "unique_combination(id,p)": 0, "unique_combination(p)": 3, "relationships(fk)": 2}
    assert report() == want
    # every key shares one of two hashes: the exact keys and the second hash still tell them apart
    monkeypatch.setattr(Q, "_key_hash", lambda *cols: F.pmod(F.xxhash64(*[c.cast("string") for c in cols]), F.lit(2)))
    assert report() == want
    assert want["relationships(fk)"] == 2  # b and zz


def test_observed_counts_equal_counted_ones(spark):
    from strata.plans.warehouse import GOLD_FACTS, Warehouse, observed_reconciliation, reconciliation
    w = Warehouse.materialized(spark, "/root/testdata/sf0.001", models=GOLD_FACTS)
    a = sorted(map(tuple, observed_reconciliation(w).collect()))
    assert a == sorted(map(tuple, reconciliation(w).collect())) and len(a) == 5
    assert all(w.counts[m]["rows"] == df.count() for m, df in w.tables.items() if m in w.counts)


def test_checks_of_keys_write_no_tables(spark, monkeypatch):
    """Reports that need a few keys of each table do not store whole tables for it."""
    from strata.plans import extra_queries as X
    from strata.plans.warehouse import Warehouse
    monkeypatch.setattr(Warehouse, "materialize", None)
    for run in (X.dq_inactive_staff, X.dq_late_arriving, X.dq_ri_report):
        run(spark, "/root/testdata/sf0.001").collect()
    assert X.dq_ri_report(spark, "/root/testdata/sf0.001").count() == 6
