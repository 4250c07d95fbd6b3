"""Landing tables derived from the TPC-H-style driver tables.

The warehouse models expect landing tables of a park operator (transactions,
gate scans, ride polls, feedback, weather, customers, products, staff).  The
driver data has none of them, so each landing table is *derived* from whole
driver tables, row for row (no sampling, no id subsets):

=================  ==============================================================
landing table      derived from
=================  ==============================================================
raw_customers      customer + nation + region (park = region of the nation)
raw_transactions   lineitem + orders + customer + nation + region (one row per line)
raw_gate_events    events + customer + nation + region (gate = nation, park = region)
raw_feedback       events + customer + nation + region
raw_weather        events + customer + nation + region (poll = hour of the event)
raw_ride_operations lineitem + supplier + nation + region (ride = line number)
raw_products       part
raw_staff          supplier + nation + region
=================  ==============================================================

Dirty values (malformed dates, mixed boolean spellings, padded text, out of
range scores, ``'-'`` placeholders) are derived from value ranges of the
rows themselves.

Each column is one SQL expression that Spark SQL and DuckDB both evaluate
the same way (a pair ``(spark, duckdb)`` where the dialects differ), so the
SQL oracle starts from identical landing rows.  The joins are expressed with
the DataFrame API on the Spark side; nation and region are tiny and
broadcast, customer / orders / supplier joins are shuffle joins planned by
Catalyst and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import initcap_trim, upper_trim

# Fixed parameters of the derivation.
INGESTED_AT = "2024-02-01 00:00:00"
PIPELINE = "driver_landing"


def cust_id(col: str) -> str:
    return f"'CUST-' || lpad(CAST({col} AS STRING), 7, '0')"


def emp_id(col: str) -> str:
    return f"'EMP-' || lpad(CAST({col} AS STRING), 5, '0')"


def sku(col: str) -> str:
    return f"'SKU-' || lpad(CAST({col} AS STRING), 7, '0')"


_META_CONST = [
    ("ingestion_timestamp", f"CAST('{INGESTED_AT}' AS TIMESTAMP)"),
    ("ingestion_date", f"'{INGESTED_AT[:10]}'"),
    ("batch_id", "'BATCH-00000001'"),
    ("pipeline_name", f"'{PIPELINE}'"),
    ("validation_status", "'pending'"),
]


def _meta_from(ts: str) -> list:
    return [
        ("ingestion_timestamp", f"CAST({ts} AS TIMESTAMP)"),
        ("ingestion_date", f"CAST(CAST({ts} AS DATE) AS STRING)"),
        ("batch_id", (f"'BATCH-' || date_format({ts}, 'yyyyMM')",
                      f"'BATCH-' || strftime({ts}, '%Y%m')")),
        ("pipeline_name", f"' {PIPELINE.upper()} '"),
        ("validation_status", "'pending'"),
    ]


CUSTOMERS = [
    ("source_customer_id", cust_id("c_custkey")),
    ("source_system", "'CRM'"),
    ("full_name", "lower(c_mktsegment) || ' ' || lower(c_name)"),
    ("first_name", "lower(c_mktsegment)"),
    ("last_name", "' ' || lower(c_name)"),
    ("gender", "CASE WHEN c_acctbal < 4500 THEN ' f' ELSE 'm ' END"),
    ("nationality", "lower(n_name)"),
    ("date_of_birth", "CAST(DATE '1950-01-01' + CAST(floor(abs(c_acctbal)) AS INT) AS STRING)"),
    ("email", "'  ' || upper(c_name) || '@Example.COM '"),
    ("phone", "' +' || CAST(c_nationkey AS STRING) || '-' || CAST(c_custkey AS STRING) || ' '"),
    ("resident_type", "r_name"),
    ("loyalty_tier", "c_mktsegment"),
    ("loyalty_card_number", "'LC-' || lpad(CAST(c_custkey AS STRING), 7, '0')"),
    ("loyalty_points", "CAST(floor(c_acctbal) AS BIGINT)"),
    ("registration_date", "CASE WHEN c_acctbal < 0 THEN 'not-a-date' ELSE "
                          "CAST(DATE '2015-01-01' + CAST(floor(c_acctbal / 4) AS INT) AS STRING) END"),
    ("app_installed", "CASE WHEN c_acctbal >= 5000 THEN 'True' WHEN c_acctbal >= 0 THEN ' false' "
                      "ELSE 'unknown' END"),
    ("email_opt_in", "CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN 'Y' "
                     "WHEN c_mktsegment = 'MACHINERY' THEN 'n' ELSE NULL END"),
    ("sms_opt_in", "CASE WHEN c_acctbal > 2500 THEN 'y ' ELSE 'N' END"),
    ("cdc_operation", "'INSERT'"),
    ("record_created_at", "CAST(DATE '2020-01-01' + CAST(floor(abs(c_acctbal)) AS INT) AS STRING)"),
    *_META_CONST,
    ("is_duplicate", "CAST(NULL AS STRING)"),
    ("source_region", "r_name"),
]

TRANSACTIONS = [
    ("source_transaction_id", "'TXN-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"),
    ("source_system", "'POS'"),
    ("source_table", "'lineitem'"),
    ("park_code", "r_name"),
    ("terminal_id", "'T-' || l_linestatus"),
    ("cashier_id", emp_id("l_suppkey")),
    ("customer_id", cust_id("o_custkey")),
    ("transaction_datetime", "CASE WHEN l_discount >= 0.1 AND l_tax >= 0.08 THEN 'Invalid-Date-String' "
                             "ELSE CAST(o_orderdate AS STRING) END"),
    ("product_code", sku("l_partkey")),
    ("product_description", "CASE l_returnflag WHEN 'R' THEN ' returned item' "
                            "WHEN 'A' THEN 'accepted ITEM ' ELSE 'regular item' END"),
    ("product_category", "' ' || lower(l_linestatus)"),
    ("unit_price", "l_extendedprice / l_quantity"),
    ("quantity", "CAST(l_quantity AS BIGINT)"),
    ("payment_method", "lower(substr(o_orderpriority, 3))"),
    ("transaction_status", "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN ' pending' "
                           "ELSE 'failed' END"),
    ("sales_channel", "'online '"),
    ("is_group_booking", "CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'R' THEN 'yes' ELSE '0' END"),
    ("group_size", "CAST(l_linenumber AS BIGINT)"),
    ("booking_reference", "'BK-' || CAST(l_orderkey AS STRING)"),
    ("gross_amount", "l_extendedprice"),
    ("discount_amount", "l_extendedprice * l_discount"),
    ("net_amount", "l_extendedprice * (1 - l_discount)"),
    ("vat_amount", "l_extendedprice * (1 - l_discount) * l_tax"),
    ("total_charged", "l_extendedprice * (1 - l_discount) * (1 + l_tax)"),
    ("refund_reference_id", "CASE WHEN l_returnflag = 'R' THEN 'RF-' || CAST(l_orderkey AS STRING) END"),
    ("cdc_operation", "'insert'"),
    *_meta_from("l_shipdate"),
    ("is_duplicate", "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'true' END"),
    ("source_region", "r_name"),
]

GATE_EVENTS = [
    ("source_event_id", "'EVT-' || CAST(event_id AS STRING)"),
    ("source_system", "'GATE'"),
    ("park_code", "r_name"),
    ("gate_id", "'G-' || lpad(CAST(n_nationkey AS STRING), 2, '0')"),
    ("gate_location", "lower(n_name) || ' gate'"),
    ("zone_code", "' z' || CAST(n_regionkey AS STRING)"),
    ("event_type", "CASE event_type WHEN 'view' THEN ' entry' WHEN 'click' THEN 'Exit ' "
                   "ELSE event_type END"),
    ("customer_id", cust_id("user_id")),
    ("event_datetime", "CAST(ts AS STRING)"),
    ("ticket_barcode", "'tk-' || CAST(event_id AS STRING)"),
    ("rejection_reason", "CASE event_type WHEN 'error' THEN ' INVALID_TICKET ' "
                         "WHEN 'signup' THEN '-' WHEN 'purchase' THEN '  ' END"),
    *_meta_from("ts"),
    ("is_duplicate", "CAST(NULL AS STRING)"),
    ("source_region", "r_name"),
]

FEEDBACK = [
    ("source_feedback_id", "'FBK-' || CAST(event_id AS STRING)"),
    ("park_code", "r_name"),
    ("customer_id", cust_id("user_id")),
    ("feedback_date", "CASE WHEN event_type = 'error' THEN 'n/a' "
                      "ELSE CAST(CAST(ts AS DATE) AS STRING) END"),
    ("overall_score", "CAST(floor(value / 40) AS BIGINT)"),
    ("nps_raw", "CAST(floor(value / 45) AS BIGINT) - 1"),
    ("cleanliness_score", "CAST(floor(value / 100) AS BIGINT) + 1"),
    ("staff_score", "CAST(length(props) AS BIGINT)"),
    ("has_complaint", "CASE event_type WHEN 'error' THEN ' TRUE' WHEN 'click' THEN 'false' "
                      "ELSE 'maybe' END"),
    ("complaint_text", "CASE event_type WHEN 'error' THEN '  slow queue ' WHEN 'purchase' THEN '-' "
                       "WHEN 'view' THEN '' END"),
    *_meta_from("ts"),
    ("is_duplicate", "CAST(NULL AS STRING)"),
    ("source_region", "r_name"),
]

WEATHER = [
    ("park_code", "r_name"),
    ("poll_datetime", ("date_format(ts, 'yyyy-MM-dd HH:00:00')", "strftime(ts, '%Y-%m-%d %H:00:00')")),
    ("temperature_c", "value / 10"),
    ("feels_like_c", "value / 10 + 1.5"),
    ("temperature_min_c", "value / 10 - 3"),
    ("temperature_max_c", "value / 12 + 4"),
    ("humidity_pct", "CAST(length(props) * 7 AS BIGINT)"),
    ("wind_speed_ms", "value / 50"),
    ("wind_direction_deg", "CAST(floor(value) AS BIGINT)"),
    ("uv_index", "CAST(floor(value / 50) AS BIGINT)"),
    ("visibility_m", "CAST(10000 AS BIGINT)"),
    ("rainfall_1h_mm", "CASE WHEN event_type = 'error' THEN value / 100 ELSE 0.0 END"),
    ("weather_code", "CASE event_type WHEN 'view' THEN ' clear' WHEN 'click' THEN 'cloudy ' "
                     "WHEN 'error' THEN 'rain' WHEN 'purchase' THEN 'sandstorm' END"),
    ("weather_description", "lower(event_type) || ' day'"),
    ("air_quality_index", "CAST(floor(value / 100) AS BIGINT) + 1"),
    ("http_status_code", "'200'"),
    ("api_error_message", "CAST(NULL AS STRING)"),
    *_meta_from("ts"),
    ("is_duplicate", "CASE WHEN event_type = 'click' THEN 'yes' END"),
    ("source_region", "r_name"),
]

RIDE_OPERATIONS = [
    ("source_record_id", "' OPS-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || ' '"),
    ("source_system", "'scada'"),
    ("park_code", "lower(r_name)"),
    ("ride_code", "' ride-' || CAST(l_linenumber AS STRING)"),
    ("ride_name", "'line ' || CAST(l_linenumber AS STRING) || ' COASTER'"),
    ("poll_datetime", "CAST(l_shipdate AS STRING)"),
    ("operational_status", "CASE l_linestatus WHEN 'F' THEN 'operational' ELSE 'maintenance' END"),
    ("current_queue_length", "CAST(l_quantity AS BIGINT)"),
    ("estimated_wait_min", "CAST(floor(l_extendedprice / 1000) AS BIGINT)"),
    ("riders_last_cycle", "CAST(l_linenumber AS BIGINT)"),
    ("safety_interlock_active", "CASE l_returnflag WHEN 'R' THEN 'TRUE' WHEN 'A' THEN 'false' "
                                "ELSE 'n/a' END"),
    ("lead_operator_id", "' ' || " + emp_id("l_suppkey") + " || ' '"),
    *_meta_from("l_shipdate"),
    ("is_duplicate", "CAST(NULL AS STRING)"),
    ("source_region", "' ' || r_name"),
]

PRODUCTS = [
    ("product_code", sku("p_partkey") + " || ' '"),
    ("description", "p_name"),
    ("category", "lower(p_type)"),
    ("price", "p_retailprice"),
    *_META_CONST,
    ("is_duplicate", "CAST(NULL AS STRING)"),
    ("source_region", "'global'"),
]

STAFF = [
    ("source_employee_id", emp_id("s_suppkey")),
    ("department", "lower(r_name)"),
    ("nationality", "lower(n_name)"),
    ("is_active", "CASE WHEN s_acctbal < 0 THEN ' No' WHEN s_acctbal < 2000 THEN 'Y' "
                  "WHEN s_acctbal < 4000 THEN '1' WHEN s_acctbal < 6000 THEN 'true' ELSE 'yes' END"),
    *_META_CONST,
    ("is_duplicate", "CAST(NULL AS STRING)"),
    ("source_region", "r_name"),
]

# Each landing table: column spec and the FROM clause (DuckDB text; the Spark
# side builds the same joins with the DataFrame API in ``_sources``).
SPECS = {
    "raw_customers": (CUSTOMERS, "customer JOIN nation ON c_nationkey = n_nationkey "
                                 "JOIN region ON n_regionkey = r_regionkey"),
    "raw_transactions": (TRANSACTIONS, "lineitem JOIN orders ON l_orderkey = o_orderkey "
                                       "LEFT JOIN customer ON o_custkey = c_custkey "
                                       "LEFT JOIN nation ON c_nationkey = n_nationkey "
                                       "LEFT JOIN region ON n_regionkey = r_regionkey"),
    "raw_gate_events": (GATE_EVENTS, "events LEFT JOIN customer ON user_id = c_custkey "
                                     "LEFT JOIN nation ON c_nationkey = n_nationkey "
                                     "LEFT JOIN region ON n_regionkey = r_regionkey"),
    "raw_feedback": (FEEDBACK, "events LEFT JOIN customer ON user_id = c_custkey "
                               "LEFT JOIN nation ON c_nationkey = n_nationkey "
                               "LEFT JOIN region ON n_regionkey = r_regionkey"),
    "raw_weather": (WEATHER, "events LEFT JOIN customer ON user_id = c_custkey "
                             "LEFT JOIN nation ON c_nationkey = n_nationkey "
                             "LEFT JOIN region ON n_regionkey = r_regionkey"),
    "raw_ride_operations": (RIDE_OPERATIONS, "lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey "
                                             "LEFT JOIN nation ON s_nationkey = n_nationkey "
                                             "LEFT JOIN region ON n_regionkey = r_regionkey"),
    "raw_products": (PRODUCTS, "part"),
    "raw_staff": (STAFF, "supplier JOIN nation ON s_nationkey = n_nationkey "
                         "JOIN region ON n_regionkey = r_regionkey"),
}

# Parameters of the silver models for this data (prices are 900-1000 here).
PRODUCT_CATEGORY_GROUPS = {"ECONOMY": "Value", "PROMO": "Promotion", "STANDARD": "Core",
                           "LARGE": "Bulk"}
PRODUCT_PRICE_RULES = ((930, "Low"), (970, "Medium"))
CALENDAR = ("1995-01-01", "2024-12-31")

# Columns whose dates the calendar dimension covers.
DATED = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]
AS_OF = "2026-01-01 00:00:00"


def spark_expr(e) -> str:
    return e[0] if isinstance(e, tuple) else e


def duck_expr(e) -> str:
    return e[1] if isinstance(e, tuple) else e


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _geo(spark, sf_dir, key_df_col_name: str, df: DataFrame, how: str) -> DataFrame:
    """Attach nation and region; Catalyst broadcasts them from their file sizes."""
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    out = df.join(nation, df[key_df_col_name] == nation["n_nationkey"], how)
    return out.join(region, out["n_regionkey"] == region["r_regionkey"], how)


def _sources(spark: SparkSession, sf_dir: str, name: str, base: DataFrame | None = None) -> DataFrame:
    """The joined driver rows behind a landing table.  ``base`` replaces the
    first (largest) table, e.g. with a streaming micro-batch of events."""
    r = lambda t: read(spark, sf_dir, t)
    if name == "raw_customers":
        return _geo(spark, sf_dir, "c_nationkey", r("customer"), "inner")
    if name == "raw_transactions":
        li = r("lineitem")
        o = r("orders")
        c = r("customer").select("c_custkey", "c_nationkey")
        # an order's region first: so the lines, many an order, are shuffled once
        placed = _geo(spark, sf_dir, "c_nationkey", o.join(c, o["o_custkey"] == c["c_custkey"], "left"), "left")
        return li.join(placed, li["l_orderkey"] == placed["o_orderkey"], "inner")
    if name in ("raw_gate_events", "raw_feedback", "raw_weather"):
        e = r("events") if base is None else base
        c = r("customer").select("c_custkey", "c_nationkey")
        j = e.join(c, e["user_id"] == c["c_custkey"], "left")
        return _geo(spark, sf_dir, "c_nationkey", j, "left")
    if name == "raw_ride_operations":
        li = r("lineitem")
        s = r("supplier").select("s_suppkey", "s_nationkey")
        j = li.join(s, li["l_suppkey"] == s["s_suppkey"], "left")
        return _geo(spark, sf_dir, "s_nationkey", j, "left")
    if name == "raw_products":
        return r("part")
    if name == "raw_staff":
        return _geo(spark, sf_dir, "s_nationkey", r("supplier"), "inner")
    raise KeyError(name)


def landing(spark: SparkSession, sf_dir: str, name: str, base: DataFrame | None = None) -> DataFrame:
    """Bronze-shaped landing rows for ``name`` (e.g. ``raw_transactions``)."""
    spec, _ = SPECS[name]
    return _sources(spark, sf_dir, name, base).selectExpr(
        *[f"{spark_expr(e)} AS {c}" for c, e in spec])


def landing_sql(name: str) -> str:
    """The same landing rows as DuckDB SQL over the driver's views."""
    spec, src = SPECS[name]
    cols = ",\n  ".join(f"{duck_expr(e)} AS {c}" for c, e in spec)
    return f"SELECT\n  {cols}\nFROM {src}"


def landing_columns(name: str) -> list[str]:
    return [c for c, _ in SPECS[name][0]]


def dim_park_from_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parks are the regions: key, code (upper) and display name."""
    return read(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("int").alias("park_key"),
        upper_trim("r_name").alias("park_code"),
        initcap_trim("r_name").alias("park_name"))
