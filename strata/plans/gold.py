"""Gold models: a Kimball star (SCD type 1), full refresh.

Facts resolve their foreign keys with ``lookup``: mandatory keys are INNER
joins (orphans dropped), optional keys LEFT joins (NULL key kept).  Catalyst
and AQE choose the join strategy per dimension from its size.

Each dimension is projected to its key and the taken columns before the join,
so only those columns are shuffled or broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import DEFAULT_SPINE_END, DEFAULT_SPINE_START, as_of_timestamp, calendar_columns, date_spine
from ..functions.keys import uuid_key
from ..operators.aggregate import dim_from_groups
from ..operators.dedup import latest_per_key
from ..operators.lookup import lookup
from ..operators.staged import Stage, lookups


def _audit(as_of):
    return as_of_timestamp(as_of).alias("gold_loaded_at")


# ------------------------------------------------------------------ dimensions

def build_dim_date(spark: SparkSession, start: str = DEFAULT_SPINE_START,
                   end: str = DEFAULT_SPINE_END) -> DataFrame:
    """One row per calendar day in ``[start, end]``."""
    return date_spine(spark, start, end).select(*calendar_columns("dt"))


def build_dim_date_covering(spans: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """One row per calendar day from the least to the greatest date of some
    columns, so no fact row falls outside; no date at all gives no rows.

    The bounds are one row (partial and final aggregates), the days follow from them.
    """
    bounds = None
    for df, c in spans:
        d = df.agg(F.min(F.col(c)).cast("date").alias("lo"), F.max(F.col(c)).cast("date").alias("hi"))
        bounds = d if bounds is None else bounds.unionAll(d)
    days = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo IS NOT NULL")
    return days.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("dt")).select(*calendar_columns("dt"))


def build_dim_park(spark: SparkSession, parks: Sequence[tuple[int, str, str]]) -> DataFrame:
    """Static park rows ``(park_key, park_code, park_name)`` (a literal UNION ALL)."""
    return spark.createDataFrame(list(parks), "park_key int, park_code string, park_name string")


def build_dim_customer(silver_customers: DataFrame, as_of=None) -> DataFrame:
    return silver_customers.select(
        F.col("customer_sk").alias("customer_key"), "source_customer_id", "full_name",
        "first_name", "last_name", "gender", "date_of_birth", "nationality", "email", "phone",
        "resident_type", "loyalty_tier", "loyalty_card_number", "loyalty_points",
        "app_installed", "email_opt_in", "sms_opt_in", "registration_date", "source_system",
        _audit(as_of))


def build_dim_product(silver_products: DataFrame, as_of=None) -> DataFrame:
    return silver_products.select(
        F.col("product_sk").alias("product_key"), "product_code", "product_name",
        F.col("category").alias("product_category"), F.col("price").alias("list_price"),
        "category_group", "price_band", _audit(as_of))


def build_dim_staff(silver_staff: DataFrame, as_of=None) -> DataFrame:
    return silver_staff.select(
        F.col("staff_sk").alias("staff_key"), "source_employee_id", "department",
        "nationality", "is_active", "staff_status", _audit(as_of))


def build_dim_ride(silver_rides: DataFrame, dim_park: DataFrame, as_of=None) -> DataFrame:
    """Latest poll per ride (its name and park), joined to the park dimension."""
    # few rides, many polls: a hash aggregate per variant of a ride comes first
    # (partial on each map task), so only variants are ranked, not the polls
    seen = (silver_rides.groupBy("ride_sk", "ride_code", "ride_name", "park_code")
            .agg(F.max("poll_datetime").alias("poll_datetime")))
    r = latest_per_key(seen, ["ride_code"], ["poll_datetime"], tiebreak="all")
    r = lookup(r, dim_park, "park_code", ["park_key"], required=True)
    return r.select(F.col("ride_sk").alias("ride_key"), "ride_code", "ride_name", "park_key",
                    _audit(as_of))


def build_dim_gate(silver_gate_events: DataFrame, dim_park: DataFrame, as_of=None) -> DataFrame:
    """Gates per (gate_id, park) with independently picked MAX attributes."""
    g = dim_from_groups(silver_gate_events, ["gate_id", "park_code"],
                        {"gate_location": "max", "zone_code": "max"})
    g = lookup(g, dim_park, "park_code", ["park_key"], required=True)
    return g.select(uuid_key("gate_id", "park_code").alias("gate_key"), "gate_id",
                    "gate_location", "zone_code", "park_key", _audit(as_of))


def build_dim_weather(silver_weather: DataFrame, as_of=None) -> DataFrame:
    w = dim_from_groups(silver_weather.filter(F.col("weather_code").isNotNull()),
                        ["weather_code"], {"weather_description": "max"})
    return w.select(uuid_key("weather_code").alias("weather_key"), "weather_code",
                    "weather_description", _audit(as_of))


# ----------------------------------------------------------------------- facts

def _date(fact, dim_date, col, required=True):
    return lookup(fact, dim_date, {col: "full_date"}, ["date_key"], required=required)


def _park(fact, dim_park):
    return lookup(fact, dim_park, "park_code", ["park_key"], required=True)


def build_fact_transaction(silver_transactions: DataFrame, dim_date: DataFrame,
                           dim_park: DataFrame, dim_product: DataFrame,
                           dim_customer: DataFrame, dim_staff: DataFrame,
                           as_of=None, stage: Stage | None = None,
                           only: Sequence[str] | None = None) -> DataFrame:
    """One row per transaction line: INNER date/park/product, LEFT customer/staff.

    With a ``stage`` the lookups of the three large dimensions run slice by slice where
    the tables are large; ``only`` names the columns that are wanted, no others are carried.
    """
    t = silver_transactions.filter(F.col("transaction_date").isNotNull())
    t = _date(t, dim_date, "transaction_date")
    t = _park(t, dim_park)
    plain = ["date_key", "park_key", "customer_key", "product_key", "staff_key",
             "source_transaction_id", "terminal_id", "booking_reference", "refund_reference_id",
             "payment_method", "transaction_status", "sales_channel", "is_group_booking",
             "group_size", "quantity", "unit_price", "gross_amount", "discount_amount",
             "net_amount", "vat_amount", "total_charged", "calculated_gross_amount", "discount_percentage"]
    made = {"refund_reference_id": F.lit(None).cast("string"),
            "discount_amount": F.coalesce(F.col("discount_amount"), F.lit(0.0)),
            "calculated_gross_amount": F.lit(None).cast("double"),
            "discount_percentage": F.lit(None).cast("double")}
    out = {"transaction_key": F.col("transaction_sk"), **{c: made.get(c, F.col(c)) for c in plain}, "gold_loaded_at": _audit(as_of)}
    out = {c: e for c, e in out.items() if only is None or c in only}
    own = [c for c in ("transaction_sk" if c == "transaction_key" else c for c in out) if c in t.columns and (c not in made or c == "discount_amount")]
    t = lookups(t, [(dim_product, "product_code", ["product_key"], True),
                    (dim_customer, "source_customer_id", ["customer_key"], False),
                    (dim_staff, {"cashier_id": "source_employee_id"}, ["staff_key"], False)], own, stage)
    return t.select(*[e.alias(c) for c, e in out.items()])


def build_fact_gate_event(silver_gate_events: DataFrame, dim_date: DataFrame,
                          dim_park: DataFrame, dim_gate: DataFrame,
                          dim_customer: DataFrame, as_of=None) -> DataFrame:
    """One row per gate scan: INNER date/park/gate (gate by id + resolved park), LEFT customer."""
    g = silver_gate_events.filter(F.col("event_date").isNotNull())
    g = _date(g, dim_date, "event_date")
    g = _park(g, dim_park)
    g = lookup(g, dim_gate, ["gate_id", "park_key"], ["gate_key"], required=True)
    g = lookup(g, dim_customer, "source_customer_id", ["customer_key"], required=False)
    return g.select(
        F.col("gate_event_sk").alias("gate_event_key"), "date_key", "park_key",
        "customer_key", "gate_key", "source_event_id", "ticket_barcode", "event_type",
        "event_datetime", "rejection_reason", "is_entry", "is_rejected",
        F.lit(1).alias("event_count"), _audit(as_of))


def build_fact_ride_operations(silver_rides: DataFrame, dim_date: DataFrame,
                               dim_park: DataFrame, dim_ride: DataFrame,
                               dim_staff: DataFrame, as_of=None) -> DataFrame:
    """One row per ride poll: INNER date/park/ride, LEFT staff (operator)."""
    r = silver_rides.filter(F.col("poll_date").isNotNull())
    r = _date(r, dim_date, "poll_date")
    r = _park(r, dim_park)
    r = lookup(r, dim_ride, "ride_code", ["ride_key"], required=True)
    r = lookup(r, dim_staff, {"lead_operator_id": "source_employee_id"}, ["staff_key"],
               required=False)
    return r.select(
        uuid_key("source_record_id").alias("ride_ops_key"), "date_key", "park_key",
        "ride_key", "staff_key", "source_record_id", "poll_datetime", "operational_status",
        "safety_interlock_active", "safety_status", "wait_time_category",
        "current_queue_length", "estimated_wait_min", "riders_last_cycle", _audit(as_of))


def build_fact_customer_feedback(silver_feedback: DataFrame, dim_date: DataFrame,
                                 dim_park: DataFrame, dim_customer: DataFrame,
                                 as_of=None) -> DataFrame:
    """One row per feedback: INNER park, LEFT date (unparseable allowed), LEFT customer."""
    f = _park(silver_feedback, dim_park)
    f = _date(f, dim_date, "feedback_date", required=False)
    f = lookup(f, dim_customer, "source_customer_id", ["customer_key"], required=False)
    return f.select(
        F.col("feedback_sk").alias("feedback_key"), "date_key", "park_key", "customer_key",
        "source_feedback_id", "overall_score", "nps_raw", "cleanliness_score", "staff_score",
        "avg_score", "nps_category", "overall_score_category", "has_complaint",
        "complaint_text", _audit(as_of))


def build_fact_weather_observation(silver_weather: DataFrame, dim_date: DataFrame,
                                   dim_park: DataFrame, dim_weather: DataFrame,
                                   as_of=None) -> DataFrame:
    """One row per weather poll with a date and a code: INNER date/park/weather."""
    w = silver_weather.select(
        "weather_sk", "park_code", "weather_date", "weather_timestamp", "weather_code",
        "temperature_c", "feels_like_c", "temperature_min_c", "temperature_max_c",
        "temperature_range", "humidity_pct", "wind_speed_ms", "wind_direction_deg",
        "uv_index", "visibility_m", "rainfall_1h_mm", "air_quality_index",
        "temperature_category", "is_raining", "air_quality_status",
    ).filter(F.col("weather_date").isNotNull() & F.col("weather_code").isNotNull())
    w = _date(w, dim_date, "weather_date")
    w = _park(w, dim_park)
    w = lookup(w, dim_weather, "weather_code", ["weather_key"], required=True)
    return w.select(
        F.col("weather_sk").alias("weather_obs_key"), "date_key", "park_key", "weather_key",
        F.col("weather_timestamp").alias("poll_datetime"), "temperature_c", "feels_like_c",
        "temperature_min_c", "temperature_max_c", "temperature_range", "humidity_pct",
        "wind_speed_ms", "wind_direction_deg", "uv_index", "visibility_m", "rainfall_1h_mm",
        "air_quality_index", "temperature_category", "is_raining", "air_quality_status",
        _audit(as_of))
