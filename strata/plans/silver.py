"""Silver models: incremental slice -> latest row per key -> cast and clean ->
keys and derived columns.

Each ``build_silver_*`` takes the bronze DataFrame and returns the silver
rows of this run (the batch).  ``target`` (the stored silver table, or None
on a first run) only drives the high-watermark slice; the keyed merge into
storage is ``strata.sources.sinks.write_incremental`` with ``UNIQUE_KEYS``.

Clock columns (``silver_loaded_at``, ``age``, ``tenure_days``) use ``as_of``
when given, so a run can be reproduced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cases as C
from ..functions.dates import as_of_date, as_of_timestamp, day_name, days_between, whole_years_between
from ..functions.keys import uuid_key
from ..functions.text import concat_words, initcap_trim, left, lower_trim, null_tokens, right, trimmed, upper_trim
from ..operators.dedup import latest_per_key, latest_sliced, latest_split, latest_spread
from ..operators.incremental import incremental_slice

# Unique key of each silver table (the merge key of the upsert).
UNIQUE_KEYS = {
    "silver_customers": ["customer_sk"],
    "silver_transactions": ["transaction_sk"],
    "silver_gate_events": ["gate_event_sk"],
    "silver_feedback": ["feedback_sk"],
    "silver_weather": ["weather_sk"],
    "silver_ride_opeartions": ["source_record_id"],
    "silver_products": ["product_sk"],
    "silver_staff": ["staff_sk"],
}

# Keys of the stored merge.  A transaction has a row per product, all with one
# transaction_sk, so its stored rows are keyed per line.
MERGE_KEYS = UNIQUE_KEYS | {"silver_transactions": ["transaction_sk", "product_code"]}

# Bronze column compared with the watermark, and the silver
# column holding the same instant (own ingestion watermark) for each model.
# silver_customers keeps no ingestion column (see ``_slice``).
INGEST_WATERMARK = {
    "silver_customers": ("ingestion_timestamp", "silver_loaded_at"),
    "silver_transactions": ("ingestion_timestamp", "ingestion_timestamp"),
    "silver_gate_events": ("ingestion_timestamp", "source_ingested_at"),
    "silver_feedback": ("ingestion_timestamp", "source_ingested_at"),
    "silver_weather": ("ingestion_timestamp", "ingestion_timestamp"),
    "silver_ride_opeartions": ("ingestion_timestamp", "source_ingested_at"),
    "silver_products": ("ingestion_timestamp", "source_ingested_at"),
    "silver_staff": ("ingestion_timestamp", "ingestion_timestamp"),
}


def _ts(c: str) -> Column:
    return F.col(c).try_cast("timestamp")


def _slice(model: str, bronze: DataFrame, target: DataFrame | None, rule: str) -> DataFrame:
    """Incremental slice.

    ``rule="ingestion"`` (default) compares with the newest ingested instant
    stored of the same source region, that instant included (the keyed merge is
    idempotent), so neither a region that lands late nor rows of an equal
    instant are lost.  ``rule="load"`` compares with the newest load time, as
    the original warehouse did (an empty target then selects nothing).
    ``rule="all"`` takes every row.

    silver_customers stores no ingestion instant: comparing its load time would
    lose rows ingested before the load and landed after it, so the default rule
    takes all its rows and leaves the choice to the merge.
    """
    if target is None or rule == "all":
        return bronze
    src, own = INGEST_WATERMARK[model]
    if rule == "load":
        return incremental_slice(bronze, src, target, "silver_loaded_at", empty_target="none")
    if own == "silver_loaded_at":
        return bronze
    return incremental_slice(bronze, src, target, own, empty_target="all", by="source_region", inclusive=True)


def _latest(df: DataFrame, keys, order_col: str, rank=latest_per_key) -> DataFrame:
    return rank(df, keys, [_ts(order_col).desc_nulls_last()], tiebreak="all")


# ----------------------------------------------------------------- customers

def build_silver_customers(bronze: DataFrame, as_of=None, target: DataFrame | None = None,
                           watermark_rule: str = "ingestion",
                           status_filter: bool = False) -> DataFrame:
    df = _slice("silver_customers", bronze, target, watermark_rule)
    if status_filter:
        df = cdc_filter(df)
    d = _latest(df, ["source_customer_id", "source_system"], "record_created_at")
    c = d.select(
        "source_customer_id", "source_system", "source_region",
        initcap_trim("full_name").alias("full_name"),
        initcap_trim("first_name").alias("first_name"),
        initcap_trim("last_name").alias("last_name"),
        upper_trim("gender").alias("gender"),
        initcap_trim("nationality").alias("nationality"),
        F.col("date_of_birth").try_cast("date").alias("date_of_birth"),
        lower_trim("email").alias("email"),
        trimmed("phone").alias("phone"),
        initcap_trim("resident_type").alias("resident_type"),
        initcap_trim("loyalty_tier").alias("loyalty_tier"),
        "loyalty_card_number",
        F.col("loyalty_points").cast("int").alias("loyalty_points"),
        F.col("registration_date").try_cast("date").alias("registration_date"),
        C.to_bool_set("app_installed", C.TRUE_FALSE).alias("app_installed"),
        C.to_bool_set("email_opt_in", C.YES_NO_LETTER).alias("email_opt_in"),
        C.to_bool_set("sms_opt_in", C.YES_NO_LETTER).alias("sms_opt_in"),
        _ts("record_created_at").alias("source_created_at"),
    )
    today = as_of_date(as_of)
    return c.select(
        uuid_key("source_customer_id").alias("customer_sk"),
        "source_customer_id", "source_system", "source_region",
        "full_name", "first_name", "last_name",
        concat_words("first_name", "last_name").alias("derived_full_name"),
        "gender", "nationality", "date_of_birth",
        whole_years_between("date_of_birth", today).alias("age"),
        "email", "phone", "resident_type", "loyalty_tier", "loyalty_card_number",
        "loyalty_points", "registration_date",
        days_between("registration_date", today).alias("tenure_days"),
        "app_installed", "email_opt_in", "sms_opt_in",
        C.any_true("email_opt_in", "sms_opt_in").alias("is_any_opted_in"),
        "source_created_at",
        as_of_timestamp(as_of).alias("silver_loaded_at"),
    )


# The optional status / CDC filter of the customer load.
VALID_STATUS = "VALID"
DELETE_OPERATION = "DELETE"


def cdc_filter(df: DataFrame) -> DataFrame:
    """Keep validated rows that are not deletes."""
    return df.filter((upper_trim("validation_status") == VALID_STATUS)
                     & (upper_trim("cdc_operation") != DELETE_OPERATION))


# -------------------------------------------------------------- transactions

def build_silver_transactions(bronze: DataFrame, as_of=None, target: DataFrame | None = None,
                              watermark_rule: str = "ingestion", repeats: bool = False) -> DataFrame:
    """A sale line is landed once, as a rule, so lines without a second one of
    their key are told first and stay where they are; ``repeats`` says that most
    lines have one, so all are ranked (large tables are stored for it first).  The rows are the same."""
    df = _slice("silver_transactions", bronze, target, watermark_rule)
    d = _latest(df, ["source_transaction_id", "product_code"], "ingestion_timestamp",
                latest_sliced if repeats else latest_split)
    ts = _ts("transaction_datetime")
    c = d.select(
        "source_transaction_id", "source_system", "source_table", "park_code",
        "terminal_id", "cashier_id",
        F.col("customer_id").alias("source_customer_id"),
        ts.alias("transaction_timestamp"),
        ts.cast("date").alias("transaction_date"),
        "product_code",
        initcap_trim("product_description").alias("product_description"),
        upper_trim("product_category").alias("product_category"),
        F.col("unit_price").try_cast("double").alias("unit_price"),
        F.col("quantity").try_cast("int").alias("quantity"),
        initcap_trim("payment_method").alias("payment_method"),
        upper_trim("transaction_status").alias("transaction_status"),
        initcap_trim("sales_channel").alias("sales_channel"),
        C.to_bool_set("is_group_booking", C.GROUP_BOOKING).alias("is_group_booking"),
        F.col("group_size").try_cast("int").alias("group_size"),
        "booking_reference",
        *[F.col(m).try_cast("double").alias(m) for m in
          ("gross_amount", "discount_amount", "net_amount", "vat_amount", "total_charged")],
        "refund_reference_id",
        upper_trim("cdc_operation").alias("cdc_operation"),
        _ts("ingestion_timestamp").alias("ingestion_timestamp"),
        F.col("ingestion_date").try_cast("date").alias("ingestion_date"),
        "batch_id", "pipeline_name",
        upper_trim("validation_status").alias("validation_status"),
        C.to_bool_set("is_duplicate", C.DUPLICATE).alias("is_duplicate"),
        "source_region",
    )
    return c.select(
        uuid_key("source_transaction_id").alias("transaction_sk"),
        "source_transaction_id", "product_code",
        uuid_key("source_customer_id").alias("customer_sk"),
        "source_customer_id", "cashier_id", "terminal_id", "park_code",
        "transaction_timestamp", "transaction_date",
        "product_description", "product_category",
        "unit_price", "quantity", "gross_amount", "discount_amount", "net_amount",
        "vat_amount", "total_charged",
        (F.col("unit_price") * F.col("quantity")).alias("calculated_gross_amount"),
        C.discount_pct("total_charged", "discount_amount", "gross_amount").alias("discount_percentage"),
        "is_group_booking", "group_size", "booking_reference",
        "payment_method", "transaction_status", "sales_channel", "cdc_operation",
        "ingestion_timestamp", "ingestion_date", "batch_id", "pipeline_name",
        "validation_status", "is_duplicate", "source_region",
        as_of_timestamp(as_of).alias("silver_loaded_at"),
    )


# --------------------------------------------------------------- gate events

def build_silver_gate_events(bronze: DataFrame, as_of=None, target: DataFrame | None = None,
                             watermark_rule: str = "ingestion",
                             enrich_customers: DataFrame | None = None,
                             customer_slice: tuple[str, str] | None = None) -> DataFrame:
    """``enrich_customers`` adds the (row-multiplying) left join to silver
    customers; its key is re-hashed afterwards, so by default it is left out.
    ``customer_slice=(prefix, suffix)`` reproduces a left-over debug filter
    that keeps one customer's events; off by default."""
    df = _slice("silver_gate_events", bronze, target, watermark_rule)
    d = _latest(df, ["source_event_id", "park_code"], "ingestion_timestamp")
    if enrich_customers is not None:
        cust = enrich_customers.select(F.col("source_customer_id").alias("__cid"))
        d = d.join(cust, d["customer_id"] == cust["__cid"], "left").drop("__cid")
    c = d.select(
        "source_event_id", "source_system", "park_code", "source_region", "gate_id",
        initcap_trim("gate_location").alias("gate_location"),
        upper_trim("zone_code").alias("zone_code"),
        upper_trim("event_type").alias("event_type"),
        F.col("customer_id").alias("source_customer_id"),
        _ts("event_datetime").alias("event_datetime"),
        upper_trim("ticket_barcode").alias("ticket_barcode"),
        null_tokens("rejection_reason").alias("rejection_reason"),
        _ts("ingestion_timestamp").alias("source_ingested_at"),
    )
    out = c.select(
        uuid_key("source_event_id").alias("gate_event_sk"),
        uuid_key("source_customer_id").alias("customer_sk"),
        "source_event_id", "source_customer_id", "source_system", "park_code",
        "source_region", "gate_id", "gate_location", "zone_code", "event_type",
        "event_datetime",
        F.col("event_datetime").cast("date").alias("event_date"),
        day_name("event_datetime").alias("event_day_of_week"),
        F.hour("event_datetime").alias("event_hour"),
        C.time_of_day("event_datetime").alias("time_of_day"),
        C.three_valued("event_type", C.ENTRY_EXIT).alias("is_entry"),
        "ticket_barcode", "rejection_reason",
        C.is_not_null_flag("rejection_reason").alias("is_rejected"),
        "source_ingested_at",
        as_of_timestamp(as_of).alias("silver_loaded_at"),
    )
    if customer_slice is not None:
        prefix, suffix = customer_slice
        out = out.filter((left("source_customer_id", len(prefix)) == prefix)
                         & (right("source_customer_id", len(suffix)) == suffix))
    return out


# ------------------------------------------------------------------ feedback

# Valid score range of every feedback score.
SCORE_MIN, SCORE_MAX = 0, 10


def build_silver_feedback(bronze: DataFrame, as_of=None, target: DataFrame | None = None,
                          watermark_rule: str = "ingestion") -> DataFrame:
    df = _slice("silver_feedback", bronze, target, watermark_rule)
    d = _latest(df, ["source_feedback_id", "park_code"], "ingestion_timestamp")
    c = d.select(
        "source_feedback_id", "park_code", "source_region",
        F.col("customer_id").alias("source_customer_id"),
        F.col("feedback_date").try_cast("date").alias("feedback_date"),
        *[C.in_range_or_null(s, SCORE_MIN, SCORE_MAX).alias(s)
          for s in ("overall_score", "nps_raw", "cleanliness_score", "staff_score")],
        C.to_bool_set("has_complaint", C.TRUE_FALSE).alias("has_complaint"),
        null_tokens("complaint_text").alias("complaint_text"),
        _ts("ingestion_timestamp").alias("source_ingested_at"),
    )
    return c.select(
        uuid_key("source_feedback_id").alias("feedback_sk"),
        uuid_key("source_customer_id").alias("customer_sk"),
        "source_feedback_id", "park_code", "source_region", "source_customer_id",
        "feedback_date", "overall_score", "nps_raw", "cleanliness_score", "staff_score",
        F.expr("ROUND((overall_score + cleanliness_score + staff_score) / 3.0, 2)").alias("avg_score"),
        C.nps_category("nps_raw").alias("nps_category"),
        C.score_category("overall_score").alias("overall_score_category"),
        "has_complaint", "complaint_text", "source_ingested_at",
        as_of_timestamp(as_of).alias("silver_loaded_at"),
    )


# ------------------------------------------------------------------- weather

def build_silver_weather(bronze: DataFrame, as_of=None, target: DataFrame | None = None,
                         watermark_rule: str = "ingestion") -> DataFrame:
    df = _slice("silver_weather", bronze, target, watermark_rule)
    d = _latest(df, ["park_code", "poll_datetime"], "ingestion_timestamp")
    ts = _ts("poll_datetime")
    c = d.select(
        uuid_key("park_code", "poll_datetime").alias("weather_sk"),
        "park_code",
        ts.alias("weather_timestamp"),
        ts.cast("date").alias("weather_date"),
        *[F.col(m).try_cast("double").alias(m) for m in
          ("temperature_c", "feels_like_c", "temperature_min_c", "temperature_max_c")],
        F.col("humidity_pct").try_cast("int").alias("humidity_pct"),
        F.col("wind_speed_ms").try_cast("double").alias("wind_speed_ms"),
        *[F.col(m).try_cast("int").alias(m) for m in ("wind_direction_deg", "uv_index", "visibility_m")],
        F.col("rainfall_1h_mm").try_cast("double").alias("rainfall_1h_mm"),
        upper_trim("weather_code").alias("weather_code"),
        initcap_trim("weather_description").alias("weather_description"),
        F.col("air_quality_index").try_cast("int").alias("air_quality_index"),
        F.col("http_status_code").try_cast("int").alias("http_status_code"),
        "api_error_message",
        _ts("ingestion_timestamp").alias("ingestion_timestamp"),
        F.col("ingestion_date").try_cast("date").alias("ingestion_date"),
        "batch_id", "pipeline_name",
        upper_trim("validation_status").alias("validation_status"),
        C.to_bool_set("is_duplicate", C.DUPLICATE).alias("is_duplicate"),
        "source_region",
    )
    return c.select(
        "weather_sk", "park_code", "weather_timestamp", "weather_date",
        "temperature_c", "feels_like_c", "temperature_min_c", "temperature_max_c",
        "humidity_pct", "wind_speed_ms", "wind_direction_deg", "uv_index", "visibility_m",
        "rainfall_1h_mm", "air_quality_index", "weather_code", "weather_description",
        (F.col("temperature_max_c") - F.col("temperature_min_c")).alias("temperature_range"),
        C.temperature_category("temperature_c").alias("temperature_category"),
        C.positive_flag("rainfall_1h_mm").alias("is_raining"),
        C.air_quality_status("air_quality_index").alias("air_quality_status"),
        "http_status_code", "api_error_message", "ingestion_timestamp", "ingestion_date",
        "batch_id", "pipeline_name", "validation_status", "is_duplicate", "source_region",
        as_of_timestamp(as_of).alias("silver_loaded_at"),
    )


# ----------------------------------------------------------- ride operations

def build_silver_ride_operations(bronze: DataFrame, as_of=None, target: DataFrame | None = None,
                                 watermark_rule: str = "ingestion",
                                 wait_rules=C.WAIT_LADDER) -> DataFrame:
    df = _slice("silver_ride_opeartions", bronze, target, watermark_rule)
    d = _latest(df, ["source_record_id"], "ingestion_timestamp", latest_spread)
    c = d.select(
        trimmed("source_record_id").alias("source_record_id"),
        initcap_trim("source_system").alias("source_system"),
        upper_trim("park_code").alias("park_code"),
        upper_trim("source_region").alias("source_region"),
        upper_trim("ride_code").alias("ride_code"),
        initcap_trim("ride_name").alias("ride_name"),
        _ts("poll_datetime").alias("poll_datetime"),
        upper_trim("operational_status").alias("operational_status"),
        *[F.col(m).try_cast("int").alias(m) for m in
          ("current_queue_length", "estimated_wait_min", "riders_last_cycle")],
        C.to_bool_set("safety_interlock_active", C.TRUE_FALSE).alias("safety_interlock_active"),
        trimmed("lead_operator_id").alias("lead_operator_id"),
        _ts("ingestion_timestamp").alias("source_ingested_at"),
        F.col("ingestion_date").cast("date").alias("ingestion_date"),
        trimmed("batch_id").alias("batch_id"),
        lower_trim("pipeline_name").alias("pipeline_name"),
        upper_trim("validation_status").alias("validation_status"),
        C.to_bool_set("is_duplicate", C.TRUE_FALSE).alias("is_duplicate"),
    )
    return c.select(
        "source_record_id",
        uuid_key("ride_code").alias("ride_sk"),
        "source_system", "park_code", "source_region", "ride_code", "ride_name",
        "poll_datetime",
        F.col("poll_datetime").cast("date").alias("poll_date"),
        day_name("poll_datetime").alias("poll_day_of_week"),
        F.hour("poll_datetime").alias("poll_hour"),
        C.time_of_day("poll_datetime").alias("time_of_day"),
        "operational_status", "current_queue_length", "estimated_wait_min", "riders_last_cycle",
        C.wait_time_category("estimated_wait_min", wait_rules).alias("wait_time_category"),
        "safety_interlock_active",
        C.status_label("safety_interlock_active", C.SAFETY_STATUS).alias("safety_status"),
        "lead_operator_id", "source_ingested_at", "ingestion_date", "batch_id",
        "pipeline_name", "validation_status", "is_duplicate",
        as_of_timestamp(as_of).alias("silver_loaded_at"),
    )


# ------------------------------------------------------------------ products

def build_silver_products(bronze: DataFrame, as_of=None, target: DataFrame | None = None,
                          watermark_rule: str = "ingestion", category_groups=None,
                          price_rules=C.PRICE_LADDER) -> DataFrame:
    df = _slice("silver_products", bronze, target, watermark_rule)
    d = _latest(df, ["product_code"], "ingestion_timestamp")
    c = d.select(
        trimmed("product_code").alias("product_code"),
        initcap_trim("description").alias("product_name"),
        upper_trim("category").alias("category"),
        F.col("price").try_cast("double").alias("price"),
        _ts("ingestion_timestamp").alias("source_ingested_at"),
        F.col("ingestion_date").cast("date").alias("ingestion_date"),
        trimmed("batch_id").alias("batch_id"),
        lower_trim("pipeline_name").alias("pipeline_name"),
        upper_trim("validation_status").alias("validation_status"),
        C.to_bool_set("is_duplicate", C.TRUE_FALSE).alias("is_duplicate"),
        upper_trim("source_region").alias("source_region"),
    )
    return c.select(
        uuid_key("product_code").alias("product_sk"),
        "product_code", "product_name", "category", "source_region", "price",
        C.category_group("category", category_groups).alias("category_group"),
        C.price_band("price", price_rules).alias("price_band"),
        "source_ingested_at", "ingestion_date", "batch_id", "pipeline_name",
        "validation_status", "is_duplicate",
        as_of_timestamp(as_of).alias("silver_loaded_at"),
    )


# --------------------------------------------------------------------- staff

def build_silver_staff(bronze: DataFrame, as_of=None, target: DataFrame | None = None,
                       watermark_rule: str = "ingestion") -> DataFrame:
    df = _slice("silver_staff", bronze, target, watermark_rule)
    d = _latest(df, ["source_employee_id"], "ingestion_timestamp")
    c = d.select(
        "source_employee_id", "source_region",
        initcap_trim("department").alias("department"),
        initcap_trim("nationality").alias("nationality"),
        C.to_bool_set("is_active", C.ACTIVE).alias("is_active"),
        _ts("ingestion_timestamp").alias("ingestion_timestamp"),
        F.col("ingestion_date").try_cast("date").alias("ingestion_date"),
        "batch_id", "pipeline_name",
        upper_trim("validation_status").alias("validation_status"),
        C.to_bool_set("is_duplicate", C.DUPLICATE).alias("is_duplicate"),
    )
    return c.select(
        uuid_key("source_employee_id").alias("staff_sk"),
        "source_employee_id", "source_region", "department", "nationality", "is_active",
        "ingestion_timestamp", "ingestion_date", "batch_id", "pipeline_name",
        "validation_status", "is_duplicate",
        C.status_label("is_active", C.STAFF_STATUS).alias("staff_status"),
        as_of_timestamp(as_of).alias("silver_loaded_at"),
    )


SILVER_BUILDERS = {
    "silver_customers": build_silver_customers,
    "silver_transactions": build_silver_transactions,
    "silver_gate_events": build_silver_gate_events,
    "silver_feedback": build_silver_feedback,
    "silver_weather": build_silver_weather,
    "silver_ride_opeartions": build_silver_ride_operations,
    "silver_products": build_silver_products,
    "silver_staff": build_silver_staff,
}

# Which bronze table feeds each silver model.
SILVER_SOURCES = {
    "silver_customers": "raw_customers",
    "silver_transactions": "raw_transactions",
    "silver_gate_events": "raw_gate_events",
    "silver_feedback": "raw_feedback",
    "silver_weather": "raw_weather",
    "silver_ride_opeartions": "raw_ride_operations",
    "silver_products": "raw_products",
    "silver_staff": "raw_staff",
}

__all__ = [n for n in dir() if n.startswith("build_")] + ["UNIQUE_KEYS", "SILVER_BUILDERS",
                                                         "SILVER_SOURCES", "cdc_filter"]
