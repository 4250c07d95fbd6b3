from strata.plans.layers import BRONZE_MODELS, bronze_table, landing_ri_report, load_landing, run_layers
from strata.plans.warehouse import GOLD_MODELS
from strata.sources import rekey_tenant
from strata.sources.catalog import LayerCatalog

import fixtures as X

MASTER_SCHEMA = "bronze_id long, source_record_id string, source_system string, record_type string, price_amount double, " + X.META


def landing_tables(spark):
    return {
        "customers": X.customers(spark), "transactions": X.transactions(spark),
        "gate_events": X.gates(spark), "feedback": X.feedback(spark), "weather": X.weather(spark),
        "ride_operations": X.rides(spark), "products": X.products(spark), "staff": X.staff(spark),
        "master_data": spark.createDataFrame([(1, "SF-MST-0001", "ERP", "SKU", 10.0) + X.meta()],
                                             MASTER_SCHEMA),
    }


def test_run_layers_two_parks_and_rerun(spark, tmp_root):
    sf = {e: df.drop("source_region", "bronze_id") for e, df in landing_tables(spark).items()}
    aq = {e: rekey_tenant(df, "SF-", "AQ-", {"park_code": "AQ"} if "park_code" in df.columns else {})
          for e, df in sf.items()}
    # the fixtures hold orphans on purpose: the landed product code is padded
    # (silver trims it), so before the load no transaction line finds it
    ri = {r.label: r for r in landing_ri_report(sf).collect()}
    assert ri["transactions.product_code -> products.product_code"].orphans == 9
    assert ri["transactions.customer_id -> customers.source_customer_id"].status == "PASS"
    assert load_landing(spark, tmp_root, "sf", sf).filter("status = 'FAIL'").count() > 0
    load_landing(spark, tmp_root, "sf", sf, require_integrity=False)
    load_landing(spark, tmp_root, "aq", aq, require_integrity=False)
    report = {(r.model, r.test): r for r in
              run_layers(spark, tmp_root, X.PARKS, as_of="2026-01-01 00:00:00").collect()}
    assert report[("dim_park", "row_count()")].failures == 0
    assert report[("fact_transaction", "relationships(product_key)")].failures == 0
    assert report[("dim_customer", "unique(source_customer_id)")].failures == 0
    assert report[("dim_product", "not_null(list_price)")].failures == 2
    for name in BRONZE_MODELS:
        assert bronze_table(spark, tmp_root, name[4:]).read().select("source_region").distinct().count() == 2
    gold = LayerCatalog(spark, tmp_root)
    first = gold.table("gold", "fact_transaction").count()
    assert spark.table("gold.fact_transaction").count() == first
    # 4 valid lines in SF; the AQ copy also keeps the line whose park was
    # unknown, because the tenant copy sets park_code to 'AQ' on every row
    assert first == 9
    # a second run sees no new rows: bronze, silver and gold stay as they are
    batches = {n: bronze_table(spark, tmp_root, n[4:]).batches() for n in BRONZE_MODELS}
    before = {m: gold.current("gold", m) for m in GOLD_MODELS}
    again = run_layers(spark, tmp_root, X.PARKS, as_of="2026-01-01 00:00:00")
    assert {n: bronze_table(spark, tmp_root, n[4:]).batches() for n in BRONZE_MODELS} == batches
    changed = [m for m in GOLD_MODELS if gold.current("gold", m) != before[m]]
    assert gold.table("gold", "fact_transaction").count() == first
    assert {(r.model, r.test): r.failures for r in again.collect()} == {k: r.failures for k, r in report.items()}
    assert changed == []
    # the command line re-runs the checks on the stored gold tables
    from strata.cli import main
    parks = '[[1, "SF", "Park one"], [2, "AQ", "Park two"]]'
    # the fixtures hold one product without a price in each park: error status
    assert main(["test", "--root", tmp_root, "--parks", parks]) == 1
