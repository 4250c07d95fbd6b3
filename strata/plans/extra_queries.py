"""Operator-level queries (ingest, row ids, incremental loads, quality checks).

Each entry runs one or a few library operators over whole driver tables (or
over models derived from them) and has an oracle in DuckDB SQL.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.incremental import incremental_slice, sync_columns, upsert, upsert_table
from ..operators.staged import settle
from ..sources.bronze import card_number, rekey_tenant, scrub_null_text, split_name, tag_union, with_sales_amounts
from ..sources.landing import with_row_id
from . import driver_tables as D
from . import oracle_sql as O
from .oracle_checks import all_checks_sql, gold_checks_sql
from .silver import MERGE_KEYS, SILVER_BUILDERS, SILVER_SOURCES, build_silver_gate_events, build_silver_staff, build_silver_transactions, cdc_filter
from .warehouse import Warehouse, decimals_to_double, observed_reconciliation, run_all_checks, run_gold_suite

# Fixed parameters of the two-batch incremental load: rows ingested up to the
# cutoff form the first load, the rest arrive in the second run.
BATCH_CUTOFF = "1998-06-30 00:00:00"


# ---------------------------------------------------------------- ingest / bronze

def bronze_products_two_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + R2 + R1: tenant SF as landed, tenant AQ re-keyed from it, tagged union,
    then null-like text scrubbed."""
    sf = D.landing(spark, sf_dir, "raw_products").drop("source_region")
    aq = rekey_tenant(sf, "SKU-", "AQ-SKU-", {"batch_id": "BATCH-AQ"})
    return scrub_null_text(tag_union({"SF": sf, "AQ": aq}, tag_col="source_region"))


def _bronze_products_sql() -> str:
    cols = [c for c in D.landing_columns("raw_products") if c != "source_region"]
    strings = {"product_code", "description", "category", "ingestion_date", "batch_id",
               "pipeline_name", "validation_status", "is_duplicate"}

    def scrub(x):
        return f"CASE WHEN {x} IN ('None', 'nan', 'NaN') OR lower({x}) = 'null' THEN NULL ELSE {x} END"

    def rekey(c):
        if c == "batch_id":
            return "'BATCH-AQ'"
        if c in strings:
            r = f"replace({c}, 'SKU-', 'AQ-SKU-')"
            return f"CASE WHEN {r} IN ('None', 'nan', 'NaN') THEN NULL ELSE {r} END"
        return c

    land = D.landing_sql("raw_products")
    sf = ", ".join((f"{scrub(c)} AS {c}" if c in strings else c) for c in cols)
    aq = ", ".join((f"{scrub(rekey(c))} AS {c}" if c in strings else c) for c in cols)
    return (f"SELECT {sf}, 'SF' AS source_region FROM ({land}) UNION ALL "
            f"SELECT {aq}, 'AQ' AS source_region FROM ({land})")


def parties_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 over two different sources of one shape: customers and suppliers."""
    c = D.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("balance"))
    s = D.read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation_key"), F.col("s_acctbal").alias("balance"))
    return tag_union({"CUSTOMER": c, "SUPPLIER": s}, tag_col="party_type")


PARTIES_SQL = """
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nation_key, c_acctbal AS balance,
  'CUSTOMER' AS party_type FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier"""


LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate"]


def landing_row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9: consecutive ``bronze_id`` 1..n over the whole line table."""
    return with_row_id(D.read(spark, sf_dir, "lineitem"), LINEITEM_ORDER)


ROW_IDS_SQL = (f"SELECT row_number() OVER (ORDER BY {', '.join(LINEITEM_ORDER)}) AS bronze_id, * "
               f"FROM lineitem")


def sales_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3: gross / net / VAT / total from unit price, quantity and discount."""
    li = D.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.round(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("discount_amount"))
    return with_sales_amounts(li)


def _round2(x: str) -> str:
    """Spark's ROUND(double, 2): half-up on the shortest decimal text of the double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 15)), 2) AS DOUBLE)"


SALES_SQL = f"""
SELECT l_orderkey, l_linenumber, unit_price, quantity, discount_amount, gross_amount,
  gross_amount - discount_amount AS net_amount,
  {_round2('(gross_amount - discount_amount) * 0.15')} AS vat_amount,
  (gross_amount - discount_amount) + {_round2('(gross_amount - discount_amount) * 0.15')}
    AS total_charged
FROM (
  SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price,
    CAST(l_quantity AS BIGINT) AS quantity,
    {_round2('l_extendedprice * l_discount')} AS discount_amount,
    {_round2('CAST(l_quantity AS BIGINT) * (l_extendedprice / l_quantity)')} AS gross_amount
  FROM lineitem
)"""


def customer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 / X23 / X24: split a full name, derive a card number from the id."""
    c = D.read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lower("c_mktsegment"), F.lit(" "), F.lower("c_name"), F.lit(" jr")).alias("full_name"),
        F.concat(F.lit("CUST-"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("customer_id"))
    return split_name(c).withColumn("loyalty_card_number", card_number(F.col("customer_id")))


NAMES_SQL = """
SELECT c_custkey, full_name, customer_id,
  split_part(full_name, ' ', 1) AS first_name,
  CASE WHEN strpos(full_name, ' ') > 0 THEN substr(full_name, strpos(full_name, ' ') + 1) END
    AS last_name,
  replace(customer_id, 'CUST', 'LC') AS loyalty_card_number
FROM (
  SELECT c_custkey, lower(c_mktsegment) || ' ' || lower(c_name) || ' jr' AS full_name,
    'CUST-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS customer_id
  FROM customer
)"""


# ------------------------------------------------------------- incremental loads

def upsert_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + S5 through a stored table: the first load (every line up to the
    cutoff) is committed, then an incremental run slices the bronze table at the
    stored watermark of each region and merges by transaction line."""
    from ..session import scratch_path
    path = scratch_path(spark, f"upsert-{uuid.uuid4().hex[:12]}")
    bronze = D.landing(spark, sf_dir, "raw_transactions")
    keys = MERGE_KEYS["silver_transactions"]
    first = build_silver_transactions(
        bronze.filter(F.col("ingestion_timestamp") <= F.lit(BATCH_CUTOFF).cast("timestamp")),
        as_of=D.AS_OF)
    stored = upsert_table(spark, path, first, keys)
    return upsert_table(spark, path, build_silver_transactions(bronze, as_of=D.AS_OF, target=stored), keys)


def _upsert_sql() -> str:
    cut = f"TIMESTAMP '{BATCH_CUTOFF}'"
    first = O.silver_transactions(where=f"ingestion_timestamp <= {cut}")
    # each region's own watermark, its instant included
    late = O.silver_transactions(
        where="ingestion_timestamp >= coalesce((SELECT m.mark FROM marks m WHERE m.region = upper(trim(source_region))), "
              "TIMESTAMP '1970-01-01 00:00:00')")
    return f"""
WITH first_load AS ({first}),
marks AS (SELECT upper(trim(source_region)) AS region, max(ingestion_timestamp) AS mark FROM first_load GROUP BY 1),
second_batch AS ({late})
SELECT * FROM first_load f WHERE NOT EXISTS (
  SELECT 1 FROM second_batch b WHERE b.transaction_sk = f.transaction_sk
    AND b.product_code IS NOT DISTINCT FROM f.product_code)
UNION ALL SELECT * FROM second_batch"""


#: The region that lands late in the two-batch slice below.
LATE_REGION = "ASIA"


def late_region_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 with a late source: the stored load holds every region but one up to
    an instant; the second run takes the late region whole, and of the others
    what is as new as their own watermark."""
    bronze = D.landing(spark, sf_dir, "raw_gate_events")
    stored = bronze.filter((F.col("ingestion_timestamp") < F.lit("2024-01-20").cast("timestamp"))
                           & (F.upper(F.trim("source_region")) != LATE_REGION))
    return incremental_slice(bronze, "ingestion_timestamp", stored, "ingestion_timestamp",
                             by="source_region", inclusive=True)


def _late_region_sql() -> str:
    return f"""
WITH b AS ({D.landing_sql("raw_gate_events")}),
m AS (SELECT upper(trim(source_region)) AS region, max(ingestion_timestamp) AS mark FROM b
      WHERE ingestion_timestamp < TIMESTAMP '2024-01-20' AND upper(trim(source_region)) <> '{LATE_REGION}' GROUP BY 1)
SELECT b.* FROM b LEFT JOIN m ON upper(trim(b.source_region)) IS NOT DISTINCT FROM m.region
WHERE b.ingestion_timestamp >= coalesce(m.mark, TIMESTAMP '1970-01-01')"""


def landing_load(name: str):
    """S8 + S9: a landing table written typed with row ids, and read back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ..session import scratch_path
        from ..sources.landing import layer_path, write_landing
        root = scratch_path(spark, f"landing-{uuid.uuid4().hex[:12]}")
        df = D.landing(spark, sf_dir, name)
        write_landing(df, root, name, order_by=[df.columns[0]])
        return spark.read.parquet(layer_path(root, "landing_zone", name))
    return run


def _landing_load_sql(name: str) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in D.landing_columns(name))
    return f"SELECT row_number() OVER (ORDER BY {order}) AS bronze_id, * FROM ({D.landing_sql(name)})"


def _twice(df: DataFrame) -> DataFrame:
    """Every row twice; what the rows are joined from is joined once."""
    return df.withColumn("__copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("__copy")


def two_tenants(name: str):
    """M1-M8: a bronze table as the tagged union of two tenants' landing tables,
    one of them holding every row twice."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sf = D.landing(spark, sf_dir, name).drop("source_region")
        aq = sf.withColumn("batch_id", F.lit("BATCH-AQ")) if "batch_id" in sf.columns else sf
        return tag_union({"SF": _twice(sf), "AQ": aq}, tag_col="source_region")
    return run


def _two_tenants_sql(name: str) -> str:
    cols = [c for c in D.landing_columns(name) if c != "source_region"]
    sf = ", ".join(cols)
    aq = ", ".join(f"'BATCH-AQ' AS {c}" if c == "batch_id" else c for c in cols)
    land = D.landing_sql(name)
    return (f"SELECT {sf}, 'SF' AS source_region FROM ({land}) UNION ALL SELECT {sf}, 'SF' FROM ({land}) "
            f"UNION ALL SELECT {aq}, 'AQ' FROM ({land})")


def doubled_silver(model: str):
    """W1-W8 on input with duplicates: a silver model over a landing table that
    holds every row twice is the model over the table itself."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        w = Warehouse(spark, sf_dir)
        source = SILVER_SOURCES[model]
        once = w.bronze(source)
        w.tables[source] = once.unionAll(once)
        w.silver_params["silver_transactions"] = {"repeats": True}
        return w.silver(model)
    return run


#: Beginning and end of the customer ids that the debug slice keeps.
CUSTOMER_SLICE = ("CUST", "7")


def gate_events_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 + X6: gate events of the customers whose id begins and ends as asked."""
    return build_silver_gate_events(D.landing(spark, sf_dir, "raw_gate_events"), as_of=D.AS_OF,
                                    customer_slice=CUSTOMER_SLICE)


def _slice_sql() -> str:
    a, b = CUSTOMER_SLICE
    return (f"SELECT * FROM ({O.silver_gate_events()}) WHERE left(source_customer_id, {len(a)}) = '{a}' "
            f"AND right(source_customer_id, {len(b)}) = '{b}'")


def gate_events_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5: gate events joined to every silver customer of their id."""
    w = Warehouse(spark, sf_dir)
    return build_silver_gate_events(w.bronze("raw_gate_events"), as_of=D.AS_OF,
                                    enrich_customers=w.silver("silver_customers"))


def _enriched_sql() -> str:
    return (f"SELECT g.* FROM ({O.silver_gate_events()}) g LEFT JOIN ({O.silver_customers()}) c "
            f"ON g.source_customer_id = c.source_customer_id")


# Status columns of the landed transactions, taken from other values of the row.
STATUS_SQL = {
    "validation_status": "CASE WHEN TRY_CAST(quantity AS DOUBLE) > 25 THEN ' valid' ELSE 'pending' END",
    "cdc_operation": "CASE WHEN refund_reference_id IS NULL THEN 'Insert' ELSE 'delete ' END",
}


def valid_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """landed transactions that are validated and not deletes."""
    landed = D.landing(spark, sf_dir, "raw_transactions")
    return cdc_filter(landed.withColumns({c: F.expr(e) for c, e in STATUS_SQL.items()}))


def _valid_sql() -> str:
    cols = ", ".join(f"{STATUS_SQL[c]} AS {c}" if c in STATUS_SQL else c for c in D.landing_columns("raw_transactions"))
    return (f"SELECT * FROM (SELECT {cols} FROM ({D.landing_sql('raw_transactions')})) "
            f"WHERE upper(trim(validation_status)) = 'VALID' AND upper(trim(cdc_operation)) <> 'DELETE'")


def dq_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared test: bronze, gold and singular, with severities."""
    return run_all_checks(Warehouse.materialized(spark, sf_dir, models=[]))


def watermark_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 alone: bronze gate events newer than what a stored load holds."""
    bronze = D.landing(spark, sf_dir, "raw_gate_events")
    stored = bronze.filter(F.col("ingestion_timestamp") < F.lit("2024-01-20").cast("timestamp"))
    return incremental_slice(bronze, "ingestion_timestamp", stored, "ingestion_timestamp")


def _watermark_sql() -> str:
    land = D.landing_sql("raw_gate_events")
    return (f"WITH b AS ({land}) SELECT * FROM b WHERE ingestion_timestamp > "
            f"(SELECT coalesce(max(ingestion_timestamp), TIMESTAMP '1970-01-01') FROM b "
            f"WHERE ingestion_timestamp < TIMESTAMP '2024-01-20')")


#: Columns of silver_staff, in order.
STAFF_COLUMNS = [
    "staff_sk", "source_employee_id", "source_region", "department", "nationality", "is_active",
    "ingestion_timestamp", "ingestion_date", "batch_id", "pipeline_name", "validation_status", "is_duplicate",
    "staff_status", "silver_loaded_at"]


def schema_sync_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + S4: the stored table has an older shape (an extra ``legacy_code``,
    no ``staff_status``); the new batch (re-activated staff) is merged after
    syncing the stored rows to the new schema."""
    new = build_silver_staff(D.landing(spark, sf_dir, "raw_staff"), as_of=D.AS_OF)
    stored = new.drop("staff_status").withColumn("legacy_code", F.lit("L1"))
    batch = new.filter(F.col("is_active") == F.lit(True))
    return upsert(sync_columns(stored, new.schema), batch, ["staff_sk"])


def _schema_sync_sql() -> str:
    s = O.silver_staff()
    cols = STAFF_COLUMNS
    old = ", ".join("CAST(NULL AS VARCHAR) AS staff_status" if c == "staff_status" else c
                    for c in cols)
    return f"""
WITH new AS ({s}), batch AS (SELECT * FROM new WHERE is_active = TRUE)
SELECT {old} FROM new n WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.staff_sk = n.staff_sk)
UNION ALL SELECT * FROM batch"""


def stream_silver_gate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + S5 as a stream: events files read with ``availableNow``, each
    micro-batch derived, cleaned by the silver builder and upserted on
    ``gate_event_sk`` into a versioned table in the shared checkpoint folder."""
    import uuid
    from ..session import scratch_path
    from ..streaming import run_available_now
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex[:12]}")
    schema = D.read(spark, sf_dir, "events").schema
    return run_available_now(
        spark, sf_dir, schema,
        lambda batch: build_silver_gate_events(
            D.landing(spark, sf_dir, "raw_gate_events", base=batch), as_of=D.AS_OF),
        f"{run}/silver_gate_events", ["gate_event_sk"], f"{run}/_checkpoint",
        file_glob="events.parquet")


# ---------------------------------------------------------------- quality checks

def dq_gold_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q9 + Q11: the declared gold tests, folded per table."""
    return run_gold_suite(Warehouse.materialized(spark, sf_dir, models=[]))


def dq_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10: gold vs silver counts with retention % and the 95 % floor (all rows), from
    the counts observed while the tables were written."""
    w = Warehouse.materialized(spark, sf_dir, models=[])
    w.each_fact(lambda fact: None)
    return observed_reconciliation(w, failing_only=False)


def _recon_sql() -> str:
    pairs = [
        ("fact_transaction", "fact_transaction", "silver_transactions", "transaction_date IS NOT NULL"),
        ("fact_gate_event", "fact_gate_event", "silver_gate_events", "event_date IS NOT NULL"),
        ("fact_ride_operations", "fact_ride_operations", "silver_ride_opeartions", "poll_date IS NOT NULL"),
        ("fact_customer_feedback", "fact_customer_feedback", "silver_feedback", "TRUE"),
        ("fact_weather_observation", "fact_weather_observation", "silver_weather",
         "weather_date IS NOT NULL AND weather_code IS NOT NULL"),
    ]
    rows = []
    for label, g, s, cond in pairs:
        rows.append(f"SELECT '{label}' AS fact_table, (SELECT count(*) FROM ({O.GOLD[g]()})) AS gold_count, "
                    f"(SELECT count(*) FROM ({O.SILVER[s]()}) WHERE {cond}) AS silver_count")
    body = "\nUNION ALL ".join(rows)
    return (f"SELECT fact_table, gold_count, silver_count, "
            f"round(gold_count * 100.0 / NULLIF(silver_count, 0), 2) AS retention_pct, "
            f"gold_count < CAST(trunc(silver_count * 0.95) AS BIGINT) AS failed FROM ({body})")


NULL_FK_CHECKS = {
    "fact_transaction": ["date_key", "park_key", "product_key"],
    "fact_gate_event": ["date_key", "park_key", "gate_key"],
    "fact_ride_operations": ["date_key", "park_key", "ride_key"],
    "fact_weather_observation": ["date_key", "park_key", "weather_key"],
    "fact_customer_feedback": ["park_key"],
}


def dq_late_arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13: NULL mandatory foreign keys per fact (all 13 counts, one pass per fact,
    of which only the keys are built; one fact after the other)."""
    w = Warehouse(spark, sf_dir).staged()
    w.only = NULL_FK_CHECKS
    out = []
    for f, cols in NULL_FK_CHECKS.items():
        out.append(settle(Q.null_fk_report({f: (w.gold(f), cols)}, failing_only=False), "report"))
        w.stage.clear()
    return reduce(DataFrame.unionByName, out)


def _late_sql() -> str:
    rows = []
    for f, cols in NULL_FK_CHECKS.items():
        for c in cols:
            rows.append(f"SELECT '{f}{Q.LABEL_SEP}NULL {c}' AS validation, "
                        f"(SELECT count(*) FROM ({O.GOLD[f]()}) WHERE {c} IS NULL) AS violation_count")
    return "\nUNION ALL ".join(rows)


def dq_inactive_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: fact rows pointing at staff whose ``is_active`` is FALSE (one pass per
    fact, of which only the keys are built)."""
    w = Warehouse(spark, sf_dir)
    return Q.inactive_dim_rows(
        [("fact_transaction", w.gold("fact_transaction"), "transaction_key", "staff_key"),
         ("fact_ride_operations", w.gold("fact_ride_operations"), "ride_ops_key", "staff_key")],
        w.gold("dim_staff"), "staff_key")


def _inactive_sql() -> str:
    ds = O.GOLD["dim_staff"]()
    out = []
    for label, f, k in (("fact_transaction", "fact_transaction", "transaction_key"),
                        ("fact_ride_operations", "fact_ride_operations", "ride_ops_key")):
        out.append(f"SELECT '{label}' AS fact_table, ft.{k} AS fact_key, ft.staff_key, "
                   f"ds.source_employee_id, ds.staff_status FROM ({O.GOLD[f]()}) ft "
                   f"JOIN ({ds}) ds ON ds.staff_key = ft.staff_key WHERE ds.is_active = FALSE")
    return "\nUNION ALL ".join(out)


def dq_ri_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q14: referential-integrity report over the silver tables (one pass per child
    table, of which only the keys are built)."""
    w = Warehouse(spark, sf_dir)
    s = w.silver
    R = Q.Relation
    return Q.ri_report([
        R("transactions.customer -> customers", s("silver_transactions"), "source_customer_id",
          s("silver_customers"), "source_customer_id", nullable=True),
        R("transactions.product -> products", s("silver_transactions"), "product_code",
          s("silver_products"), "product_code"),
        R("transactions.cashier -> staff", s("silver_transactions"), "cashier_id",
          s("silver_staff"), "source_employee_id"),
        R("gate_events.customer -> customers", s("silver_gate_events"), "source_customer_id",
          s("silver_customers"), "source_customer_id"),
        R("ride_ops.operator -> staff", s("silver_ride_opeartions"), "lead_operator_id",
          s("silver_staff"), "source_employee_id"),
        R("feedback.customer -> customers", s("silver_feedback"), "source_customer_id",
          s("silver_customers"), "source_customer_id"),
    ])


RI_RELATIONS = [
    ("transactions.customer -> customers", "silver_transactions", "source_customer_id",
     "silver_customers", "source_customer_id", True),
    ("transactions.product -> products", "silver_transactions", "product_code",
     "silver_products", "product_code", False),
    ("transactions.cashier -> staff", "silver_transactions", "cashier_id",
     "silver_staff", "source_employee_id", False),
    ("gate_events.customer -> customers", "silver_gate_events", "source_customer_id",
     "silver_customers", "source_customer_id", False),
    ("ride_ops.operator -> staff", "silver_ride_opeartions", "lead_operator_id",
     "silver_staff", "source_employee_id", False),
    ("feedback.customer -> customers", "silver_feedback", "source_customer_id",
     "silver_customers", "source_customer_id", False),
]


def _ri_sql() -> str:
    rows = []
    for label, child, fk, parent, pk, nullable in RI_RELATIONS:
        cond = f"WHERE {fk} IS NOT NULL AND {fk} <> 'None'" if nullable else ""
        ch = f"(SELECT {fk} FROM ({O.SILVER[child]()}) {cond})"
        pa = f"({O.SILVER[parent]()})"
        rows.append(
            f"SELECT '{label}' AS label, (SELECT count(*) FROM {ch}) AS total, "
            f"(SELECT count(*) FROM {ch} c WHERE NOT EXISTS (SELECT 1 FROM {pa} p "
            f"WHERE p.{pk} = c.{fk})) AS orphans, {str(nullable).upper()} AS nullable")
    body = "\nUNION ALL ".join(rows)
    return (f"SELECT label, total, orphans, orphans / greatest(total, 1) * 100.0 AS orphan_pct, "
            f"nullable, CASE WHEN orphans = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({body})")


_LANDING_ENTITIES = {"customers": "raw_customers", "transactions": "raw_transactions",
                     "products": "raw_products", "staff": "raw_staff",
                     "gate_events": "raw_gate_events", "ride_operations": "raw_ride_operations",
                     "feedback": "raw_feedback"}


def dq_landing_ri_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q14 before a load: key columns scrubbed, six relations over the landing
    tables (padded codes are orphans until silver trims them)."""
    from ..sources.bronze import scrub_null_text as scrub
    from .layers import SCRUB_COLUMNS, landing_ri_report
    frames = {}
    for e, name in _LANDING_ENTITIES.items():
        df = D.landing(spark, sf_dir, name)
        frames[e] = scrub(df, [c for c in SCRUB_COLUMNS if c in df.columns])
    return landing_ri_report(frames)


def _landing_ri_sql() -> str:
    from .layers import LANDING_RELATIONS, SCRUB_COLUMNS

    def col(entity, c):
        x = c
        if c in SCRUB_COLUMNS:
            x = f"CASE WHEN {c} IN ('None', 'nan', 'NaN') OR lower({c}) = 'null' THEN NULL ELSE {c} END"
        return f"(SELECT {x} AS v FROM ({D.landing_sql(_LANDING_ENTITIES[entity])}))"

    rows = []
    for c, fk, p, pk, nullable in LANDING_RELATIONS:
        ch = col(c, fk)
        if nullable:
            ch = f"(SELECT v FROM {ch} WHERE v IS NOT NULL AND v <> 'None')"
        pa = col(p, pk)
        rows.append(f"SELECT '{c}.{fk} -> {p}.{pk}' AS label, (SELECT count(*) FROM {ch}) AS total, "
                    f"(SELECT count(*) FROM {ch} x WHERE NOT EXISTS (SELECT 1 FROM {pa} y "
                    f"WHERE y.v = x.v)) AS orphans, {str(nullable).upper()} AS nullable")
    body = "\nUNION ALL ".join(rows)
    return (f"SELECT label, total, orphans, orphans / greatest(total, 1) * 100.0 AS orphan_pct, "
            f"nullable, CASE WHEN orphans = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({body})")


def dq_duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 on raw lines: (order, line number) pairs held by more than one row."""
    return Q.check_unique(D.read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


DUP_LINES_SQL = ("SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem "
                 "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")


def dq_gate_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: gate event types outside ENTRY / EXIT, with counts."""
    return Q.check_accepted(Warehouse(spark, sf_dir).silver("silver_gate_events"), "event_type",
                            ["ENTRY", "EXIT"])


def _event_types_sql() -> str:
    return (f"SELECT event_type AS value_field, count(*) AS n_records FROM "
            f"({O.silver_gate_events()}) WHERE event_type NOT IN ('ENTRY', 'EXIT') GROUP BY event_type")


def dq_feedback_score_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 on landing feedback: raw overall scores outside 0..10 (before the guard)."""
    return Q.check_range(D.landing(spark, sf_dir, "raw_feedback"), "overall_score", 0, 10)


def _score_range_sql() -> str:
    return (f"SELECT * FROM ({D.landing_sql('raw_feedback')}) "
            f"WHERE NOT (overall_score >= 0 AND overall_score <= 10)")


def dq_amount_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: fact lines whose discount exceeds 9 % of the gross amount."""
    return Q.check_expr(Warehouse(spark, sf_dir).gold("fact_transaction"),
                        "discount_amount <= 0.09 * gross_amount")


def _amount_rule_sql() -> str:
    return (f"SELECT * FROM ({O.fact_transaction()}) "
            f"WHERE NOT (discount_amount <= 0.09 * gross_amount)")


# ------------------------------------------------------------------ registry

def queries() -> dict:
    def dd(fn):
        return lambda spark, sf_dir: decimals_to_double(fn(spark, sf_dir))
    more = {f"landing_load_{n}": landing_load(n) for n in ("raw_transactions", "raw_feedback")}
    more |= {f"bronze_two_tenants_{n}": two_tenants(n) for n in D.SPECS}
    more |= {f"doubled_{m}": dd(doubled_silver(m)) for m in SILVER_BUILDERS}
    return more | {
        "incremental_late_region": late_region_slice,
        "silver_gate_events_slice": gate_events_slice,
        "silver_gate_events_enriched": gate_events_enriched,
        "bronze_valid_transactions": valid_transactions,
        "dq_all": dq_all,
        "bronze_products_two_tenants": bronze_products_two_tenants,
        "bronze_parties_union": parties_union,
        "landing_row_ids": landing_row_ids,
        "landing_sales_amounts": sales_amounts,
        "landing_customer_names": customer_names,
        "incremental_upsert_transactions": dd(upsert_transactions),
        "incremental_watermark_slice": watermark_slice,
        "incremental_schema_sync_staff": schema_sync_staff,
        "stream_silver_gate_events": stream_silver_gate_events,
        "dq_gold_suite": dq_gold_suite,
        "dq_reconciliation": dq_reconciliation,
        "dq_late_arriving_dimensions": dq_late_arriving,
        "dq_inactive_staff_in_facts": dq_inactive_staff,
        "dq_ri_report": dq_ri_report,
        "dq_landing_ri_report": dq_landing_ri_report,
        "dq_duplicate_lines": dq_duplicate_lines,
        "dq_gate_event_types": dq_gate_event_types,
        "dq_feedback_score_range": dq_feedback_score_range,
        "dq_amount_rule": dq_amount_rule,
    }


def oracle_sql() -> dict:
    more = {f"landing_load_{n}": _landing_load_sql(n) for n in ("raw_transactions", "raw_feedback")}
    more |= {f"bronze_two_tenants_{n}": _two_tenants_sql(n) for n in D.SPECS}
    more |= {f"doubled_{m}": O.SILVER[m]() for m in SILVER_BUILDERS}
    return more | {
        "incremental_late_region": _late_region_sql(),
        "silver_gate_events_slice": _slice_sql(),
        "silver_gate_events_enriched": _enriched_sql(),
        "bronze_valid_transactions": _valid_sql(),
        "dq_all": all_checks_sql(),
        "bronze_products_two_tenants": _bronze_products_sql(),
        "bronze_parties_union": PARTIES_SQL,
        "landing_row_ids": ROW_IDS_SQL,
        "landing_sales_amounts": SALES_SQL,
        "landing_customer_names": NAMES_SQL,
        "incremental_upsert_transactions": _upsert_sql(),
        "incremental_watermark_slice": _watermark_sql(),
        "incremental_schema_sync_staff": _schema_sync_sql(),
        "stream_silver_gate_events": O.silver_gate_events(),
        "dq_gold_suite": gold_checks_sql(),
        "dq_reconciliation": _recon_sql(),
        "dq_late_arriving_dimensions": _late_sql(),
        "dq_inactive_staff_in_facts": _inactive_sql(),
        "dq_ri_report": _ri_sql(),
        "dq_landing_ri_report": _landing_ri_sql(),
        "dq_duplicate_lines": DUP_LINES_SQL,
        "dq_gate_event_types": _event_types_sql(),
        "dq_feedback_score_range": _score_range_sql(),
        "dq_amount_rule": _amount_rule_sql(),
    }


__all__ = ["queries", "oracle_sql"]
