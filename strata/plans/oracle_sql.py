"""DuckDB SQL oracles for the registered queries.

Written independently of the DataFrame code, in DuckDB's dialect, over the
driver's pre-registered views.  Dialect differences handled here:
``initcap`` is composed from ``string_split``; DuckDB's ``dayofweek`` starts
at 0; date parts and ``hour`` are BIGINT in DuckDB and INT in Spark (cast);
``CAST(x * 0.95 AS BIGINT)`` rounds in DuckDB, so ``trunc`` is used;
``date_sub('year', …)`` counts whole years like Spark's ``DATEDIFF(year, …)``.
"""

from __future__ import annotations

from . import driver_tables as D

AS_OF_TS = f"TIMESTAMP '{D.AS_OF}'"
AS_OF_DATE = f"DATE '{D.AS_OF[:10]}'"
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def up(x: str) -> str:
    return f"upper(trim({x}))"


def low(x: str) -> str:
    return f"lower(trim({x}))"


def sk(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{KEY_NULL}')" for c in cols)
    return (f"regexp_replace(md5(concat_ws('-', {parts})), "
            r"'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5')")


def boolean(x: str, true_set, false_set) -> str:
    t = ", ".join(f"'{v}'" for v in true_set)
    f = ", ".join(f"'{v}'" for v in false_set)
    return f"CASE WHEN {low(x)} IN ({t}) THEN TRUE WHEN {low(x)} IN ({f}) THEN FALSE END"


def null_tok(x: str) -> str:
    return f"CASE WHEN trim({x}) IN ('-', '') THEN NULL ELSE trim({x}) END"


def tod(ts: str) -> str:
    h = f"hour({ts})"
    return (f"CASE WHEN {h} BETWEEN 6 AND 11 THEN 'Morning' WHEN {h} BETWEEN 12 AND 16 "
            f"THEN 'Afternoon' WHEN {h} BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Off-Hours' END")


def latest(name: str, keys: list[str], order: str, where: str | None = None) -> str:
    """Latest row per key over the landing table, with the total tiebreak."""
    rest = [c for c in D.landing_columns(name) if c not in keys]
    tb = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    w = f" WHERE {where}" if where else ""
    return (f"SELECT * FROM ({D.landing_sql(name)}){w} QUALIFY row_number() OVER ("
            f"PARTITION BY {', '.join(keys)} ORDER BY TRY_CAST({order} AS TIMESTAMP) "
            f"DESC NULLS LAST, {tb}) = 1")


TF = (("true",), ("false",))
YN = (("y",), ("n",))
GROUP = (("1", "true", "yes", "y"), ("0", "false", "no", "n"))
ACTIVE = (("1", "true", "yes"), ("0", "false", "no"))
DUP = (("true", "yes", "1"), ("false", "no", "0"))


# --------------------------------------------------------------------- silver

def silver_customers() -> str:
    d = latest("raw_customers", ["source_customer_id", "source_system"], "record_created_at")
    return f"""
SELECT {sk('source_customer_id')} AS customer_sk, source_customer_id, source_system, source_region,
  full_name, first_name, last_name, first_name || ' ' || last_name AS derived_full_name,
  gender, nationality, date_of_birth, date_sub('year', date_of_birth, {AS_OF_DATE}) AS age,
  email, phone, resident_type, loyalty_tier, loyalty_card_number, loyalty_points,
  registration_date, CAST(date_diff('day', registration_date, {AS_OF_DATE}) AS INTEGER) AS tenure_days,
  app_installed, email_opt_in, sms_opt_in,
  CASE WHEN email_opt_in = TRUE OR sms_opt_in = TRUE THEN TRUE ELSE FALSE END AS is_any_opted_in,
  source_created_at, {AS_OF_TS} AS silver_loaded_at
FROM (
  SELECT source_customer_id, source_system, source_region,
    {initcap('full_name')} AS full_name, {initcap('first_name')} AS first_name,
    {initcap('last_name')} AS last_name, {up('gender')} AS gender,
    {initcap('nationality')} AS nationality, TRY_CAST(date_of_birth AS DATE) AS date_of_birth,
    {low('email')} AS email, trim(phone) AS phone, {initcap('resident_type')} AS resident_type,
    {initcap('loyalty_tier')} AS loyalty_tier, loyalty_card_number,
    CAST(loyalty_points AS INTEGER) AS loyalty_points,
    TRY_CAST(registration_date AS DATE) AS registration_date,
    {boolean('app_installed', *TF)} AS app_installed,
    {boolean('email_opt_in', *YN)} AS email_opt_in,
    {boolean('sms_opt_in', *YN)} AS sms_opt_in,
    TRY_CAST(record_created_at AS TIMESTAMP) AS source_created_at
  FROM ({d})
)"""


def silver_transactions(where: str | None = None) -> str:
    d = latest("raw_transactions", ["source_transaction_id", "product_code"], "ingestion_timestamp",
               where)
    return f"""
SELECT {sk('source_transaction_id')} AS transaction_sk, source_transaction_id, product_code,
  {sk('source_customer_id')} AS customer_sk, source_customer_id, cashier_id, terminal_id, park_code,
  transaction_timestamp, transaction_date, product_description, product_category,
  unit_price, quantity, gross_amount, discount_amount, net_amount, vat_amount, total_charged,
  unit_price * quantity AS calculated_gross_amount,
  CASE WHEN total_charged = 0 THEN 0.0 ELSE (discount_amount / NULLIF(gross_amount, 0)) * 100 END
    AS discount_percentage,
  is_group_booking, group_size, booking_reference, payment_method, transaction_status,
  sales_channel, cdc_operation, ingestion_timestamp, ingestion_date, batch_id, pipeline_name,
  validation_status, is_duplicate, source_region, {AS_OF_TS} AS silver_loaded_at
FROM (
  SELECT source_transaction_id, park_code, terminal_id, cashier_id,
    customer_id AS source_customer_id,
    TRY_CAST(transaction_datetime AS TIMESTAMP) AS transaction_timestamp,
    CAST(TRY_CAST(transaction_datetime AS TIMESTAMP) AS DATE) AS transaction_date,
    product_code, {initcap('product_description')} AS product_description,
    {up('product_category')} AS product_category,
    TRY_CAST(unit_price AS DOUBLE) AS unit_price, TRY_CAST(quantity AS INTEGER) AS quantity,
    {initcap('payment_method')} AS payment_method, {up('transaction_status')} AS transaction_status,
    {initcap('sales_channel')} AS sales_channel,
    {boolean('is_group_booking', *GROUP)} AS is_group_booking,
    TRY_CAST(group_size AS INTEGER) AS group_size, booking_reference,
    gross_amount, discount_amount, net_amount, vat_amount, total_charged,
    {up('cdc_operation')} AS cdc_operation, ingestion_timestamp,
    TRY_CAST(ingestion_date AS DATE) AS ingestion_date, batch_id, pipeline_name,
    {up('validation_status')} AS validation_status,
    {boolean('is_duplicate', *DUP)} AS is_duplicate, source_region
  FROM ({d})
)"""


def silver_gate_events() -> str:
    d = latest("raw_gate_events", ["source_event_id", "park_code"], "ingestion_timestamp")
    return f"""
SELECT {sk('source_event_id')} AS gate_event_sk, {sk('source_customer_id')} AS customer_sk,
  source_event_id, source_customer_id, source_system, park_code, source_region, gate_id,
  gate_location, zone_code, event_type, event_datetime, CAST(event_datetime AS DATE) AS event_date,
  strftime(event_datetime, '%A') AS event_day_of_week,
  CAST(hour(event_datetime) AS INTEGER) AS event_hour, {tod('event_datetime')} AS time_of_day,
  CASE WHEN event_type = 'ENTRY' THEN TRUE WHEN event_type = 'EXIT' THEN FALSE END AS is_entry,
  ticket_barcode, rejection_reason, rejection_reason IS NOT NULL AS is_rejected,
  source_ingested_at, {AS_OF_TS} AS silver_loaded_at
FROM (
  SELECT source_event_id, source_system, park_code, source_region, gate_id,
    {initcap('gate_location')} AS gate_location, {up('zone_code')} AS zone_code,
    {up('event_type')} AS event_type, customer_id AS source_customer_id,
    TRY_CAST(event_datetime AS TIMESTAMP) AS event_datetime,
    {up('ticket_barcode')} AS ticket_barcode, {null_tok('rejection_reason')} AS rejection_reason,
    ingestion_timestamp AS source_ingested_at
  FROM ({d})
)"""


def _score(c: str) -> str:
    return f"CASE WHEN CAST({c} AS INTEGER) BETWEEN 0 AND 10 THEN CAST({c} AS INTEGER) END AS {c}"


def silver_feedback() -> str:
    d = latest("raw_feedback", ["source_feedback_id", "park_code"], "ingestion_timestamp")
    return f"""
SELECT {sk('source_feedback_id')} AS feedback_sk, {sk('source_customer_id')} AS customer_sk,
  source_feedback_id, park_code, source_region, source_customer_id, feedback_date,
  overall_score, nps_raw, cleanliness_score, staff_score,
  CAST(round((overall_score + cleanliness_score + staff_score) / 3.0, 2) AS DOUBLE) AS avg_score,
  CASE WHEN nps_raw BETWEEN 9 AND 10 THEN 'Promoter' WHEN nps_raw BETWEEN 7 AND 8 THEN 'Passive'
       WHEN nps_raw BETWEEN 0 AND 6 THEN 'Detractor' END AS nps_category,
  CASE WHEN overall_score BETWEEN 9 AND 10 THEN 'Excellent' WHEN overall_score BETWEEN 7 AND 8
       THEN 'Good' WHEN overall_score BETWEEN 5 AND 6 THEN 'Average'
       WHEN overall_score BETWEEN 0 AND 4 THEN 'Poor' END AS overall_score_category,
  has_complaint, complaint_text, source_ingested_at, {AS_OF_TS} AS silver_loaded_at
FROM (
  SELECT source_feedback_id, park_code, source_region, customer_id AS source_customer_id,
    TRY_CAST(feedback_date AS DATE) AS feedback_date,
    {_score('overall_score')}, {_score('nps_raw')}, {_score('cleanliness_score')},
    {_score('staff_score')},
    {boolean('has_complaint', *TF)} AS has_complaint,
    {null_tok('complaint_text')} AS complaint_text, ingestion_timestamp AS source_ingested_at
  FROM ({d})
)"""


def silver_weather() -> str:
    d = latest("raw_weather", ["park_code", "poll_datetime"], "ingestion_timestamp")
    return f"""
SELECT weather_sk, park_code, weather_timestamp, weather_date, temperature_c, feels_like_c,
  temperature_min_c, temperature_max_c, humidity_pct, wind_speed_ms, wind_direction_deg, uv_index,
  visibility_m, rainfall_1h_mm, air_quality_index, weather_code, weather_description,
  temperature_max_c - temperature_min_c AS temperature_range,
  CASE WHEN temperature_c >= 40 THEN 'EXTREME_HEAT' WHEN temperature_c >= 30 THEN 'HOT'
       WHEN temperature_c >= 20 THEN 'WARM' ELSE 'COOL' END AS temperature_category,
  CASE WHEN rainfall_1h_mm > 0 THEN TRUE ELSE FALSE END AS is_raining,
  CASE WHEN air_quality_index <= 2 THEN 'GOOD' WHEN air_quality_index <= 4 THEN 'MODERATE'
       ELSE 'POOR' END AS air_quality_status,
  http_status_code, api_error_message, ingestion_timestamp, ingestion_date, batch_id,
  pipeline_name, validation_status, is_duplicate, source_region, {AS_OF_TS} AS silver_loaded_at
FROM (
  SELECT {sk('park_code', 'poll_datetime')} AS weather_sk, park_code,
    TRY_CAST(poll_datetime AS TIMESTAMP) AS weather_timestamp,
    CAST(TRY_CAST(poll_datetime AS TIMESTAMP) AS DATE) AS weather_date,
    TRY_CAST(temperature_c AS DOUBLE) AS temperature_c,
    TRY_CAST(feels_like_c AS DOUBLE) AS feels_like_c,
    TRY_CAST(temperature_min_c AS DOUBLE) AS temperature_min_c,
    TRY_CAST(temperature_max_c AS DOUBLE) AS temperature_max_c,
    TRY_CAST(humidity_pct AS INTEGER) AS humidity_pct,
    TRY_CAST(wind_speed_ms AS DOUBLE) AS wind_speed_ms,
    TRY_CAST(wind_direction_deg AS INTEGER) AS wind_direction_deg,
    TRY_CAST(uv_index AS INTEGER) AS uv_index, TRY_CAST(visibility_m AS INTEGER) AS visibility_m,
    TRY_CAST(rainfall_1h_mm AS DOUBLE) AS rainfall_1h_mm, {up('weather_code')} AS weather_code,
    {initcap('weather_description')} AS weather_description,
    TRY_CAST(air_quality_index AS INTEGER) AS air_quality_index,
    TRY_CAST(http_status_code AS INTEGER) AS http_status_code, api_error_message,
    ingestion_timestamp, TRY_CAST(ingestion_date AS DATE) AS ingestion_date, batch_id,
    pipeline_name, {up('validation_status')} AS validation_status,
    {boolean('is_duplicate', *DUP)} AS is_duplicate, source_region
  FROM ({d})
)"""


def silver_ride_operations() -> str:
    d = latest("raw_ride_operations", ["source_record_id"], "ingestion_timestamp")
    return f"""
SELECT source_record_id, {sk('ride_code')} AS ride_sk, source_system, park_code, source_region,
  ride_code, ride_name, poll_datetime, CAST(poll_datetime AS DATE) AS poll_date,
  strftime(poll_datetime, '%A') AS poll_day_of_week, CAST(hour(poll_datetime) AS INTEGER) AS poll_hour,
  {tod('poll_datetime')} AS time_of_day, operational_status, current_queue_length,
  estimated_wait_min, riders_last_cycle,
  CASE WHEN estimated_wait_min >= 60 THEN 'Very High' WHEN estimated_wait_min >= 30 THEN 'High'
       WHEN estimated_wait_min >= 10 THEN 'Medium' ELSE 'Low' END AS wait_time_category,
  safety_interlock_active,
  CASE WHEN safety_interlock_active = TRUE THEN 'Attention Required' ELSE 'Normal' END AS safety_status,
  lead_operator_id, source_ingested_at, ingestion_date, batch_id, pipeline_name,
  validation_status, is_duplicate, {AS_OF_TS} AS silver_loaded_at
FROM (
  SELECT trim(source_record_id) AS source_record_id, {initcap('source_system')} AS source_system,
    {up('park_code')} AS park_code, {up('source_region')} AS source_region,
    {up('ride_code')} AS ride_code, {initcap('ride_name')} AS ride_name,
    TRY_CAST(poll_datetime AS TIMESTAMP) AS poll_datetime,
    {up('operational_status')} AS operational_status,
    TRY_CAST(current_queue_length AS INTEGER) AS current_queue_length,
    TRY_CAST(estimated_wait_min AS INTEGER) AS estimated_wait_min,
    TRY_CAST(riders_last_cycle AS INTEGER) AS riders_last_cycle,
    {boolean('safety_interlock_active', *TF)} AS safety_interlock_active,
    trim(lead_operator_id) AS lead_operator_id, ingestion_timestamp AS source_ingested_at,
    CAST(ingestion_date AS DATE) AS ingestion_date, trim(batch_id) AS batch_id,
    {low('pipeline_name')} AS pipeline_name, {up('validation_status')} AS validation_status,
    {boolean('is_duplicate', *TF)} AS is_duplicate
  FROM ({d})
)"""


def silver_products() -> str:
    d = latest("raw_products", ["product_code"], "ingestion_timestamp")
    groups = " ".join(f"WHEN category = '{k}' THEN '{v}'"
                      for k, v in D.PRODUCT_CATEGORY_GROUPS.items())
    (p1, l1), (p2, l2) = D.PRODUCT_PRICE_RULES
    return f"""
SELECT {sk('product_code')} AS product_sk, product_code, product_name, category, source_region,
  price, CASE {groups} ELSE 'Other' END AS category_group,
  CASE WHEN price < {p1} THEN '{l1}' WHEN price < {p2} THEN '{l2}' ELSE 'High' END AS price_band,
  source_ingested_at, ingestion_date, batch_id, pipeline_name, validation_status, is_duplicate,
  {AS_OF_TS} AS silver_loaded_at
FROM (
  SELECT trim(product_code) AS product_code, {initcap('description')} AS product_name,
    {up('category')} AS category, TRY_CAST(price AS DOUBLE) AS price,
    ingestion_timestamp AS source_ingested_at, CAST(ingestion_date AS DATE) AS ingestion_date,
    trim(batch_id) AS batch_id, {low('pipeline_name')} AS pipeline_name,
    {up('validation_status')} AS validation_status,
    {boolean('is_duplicate', *TF)} AS is_duplicate, {up('source_region')} AS source_region
  FROM ({d})
)"""


def silver_staff() -> str:
    d = latest("raw_staff", ["source_employee_id"], "ingestion_timestamp")
    return f"""
SELECT {sk('source_employee_id')} AS staff_sk, source_employee_id, source_region, department,
  nationality, is_active, ingestion_timestamp, ingestion_date, batch_id, pipeline_name,
  validation_status, is_duplicate,
  CASE WHEN is_active = TRUE THEN 'ACTIVE' ELSE 'INACTIVE' END AS staff_status,
  {AS_OF_TS} AS silver_loaded_at
FROM (
  SELECT source_employee_id, source_region, {initcap('department')} AS department,
    {initcap('nationality')} AS nationality, {boolean('is_active', *ACTIVE)} AS is_active,
    ingestion_timestamp, TRY_CAST(ingestion_date AS DATE) AS ingestion_date, batch_id,
    pipeline_name, {up('validation_status')} AS validation_status,
    {boolean('is_duplicate', *DUP)} AS is_duplicate
  FROM ({d})
)"""


SILVER = {
    "silver_customers": silver_customers,
    "silver_transactions": silver_transactions,
    "silver_gate_events": silver_gate_events,
    "silver_feedback": silver_feedback,
    "silver_weather": silver_weather,
    "silver_ride_opeartions": silver_ride_operations,
    "silver_products": silver_products,
    "silver_staff": silver_staff,
}


# ----------------------------------------------------------------------- gold

def dim_date() -> str:
    spans = " UNION ALL ".join(f"SELECT CAST(min({c}) AS DATE) AS lo, CAST(max({c}) AS DATE) AS hi FROM {t}" for t, c in D.DATED)
    return f"""
SELECT CAST(strftime(dt, '%Y%m%d') AS INTEGER) AS date_key, strftime(dt, '%m/%d/%Y') AS date_iso,
  dt AS full_date, CAST(year(dt) AS INTEGER) AS year, CAST(quarter(dt) AS INTEGER) AS quarter,
  CAST(month(dt) AS INTEGER) AS month, strftime(dt, '%B') AS month_name,
  CAST(day(dt) AS INTEGER) AS day, strftime(dt, '%A') AS weekday_name,
  CAST(dayofweek(dt) + 1 AS INTEGER) AS day_of_week, CAST(dayofyear(dt) AS INTEGER) AS day_of_year,
  strftime(dt, '%A') IN ('Friday', 'Saturday') AS is_weekend
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS dt
  FROM (SELECT min(lo) AS lo, max(hi) AS hi FROM ({spans})))"""


def dim_park() -> str:
    return (f"SELECT CAST(r_regionkey AS INTEGER) AS park_key, {up('r_name')} AS park_code, "
            f"{initcap('r_name')} AS park_name FROM region")


def dim_customer() -> str:
    return f"""
SELECT customer_sk AS customer_key, source_customer_id, full_name, first_name, last_name, gender,
  date_of_birth, nationality, email, phone, resident_type, loyalty_tier, loyalty_card_number,
  loyalty_points, app_installed, email_opt_in, sms_opt_in, registration_date, source_system,
  {AS_OF_TS} AS gold_loaded_at
FROM ({silver_customers()})"""


def dim_product() -> str:
    return f"""
SELECT product_sk AS product_key, product_code, product_name, category AS product_category,
  price AS list_price, category_group, price_band, {AS_OF_TS} AS gold_loaded_at
FROM ({silver_products()})"""


def dim_staff() -> str:
    return f"""
SELECT staff_sk AS staff_key, source_employee_id, department, nationality, is_active,
  staff_status, {AS_OF_TS} AS gold_loaded_at
FROM ({silver_staff()})"""


def dim_ride() -> str:
    return f"""
SELECT r.ride_sk AS ride_key, r.ride_code, r.ride_name, p.park_key, {AS_OF_TS} AS gold_loaded_at
FROM (
  SELECT ride_sk, ride_code, ride_name, park_code, poll_datetime
  FROM ({silver_ride_operations()})
  QUALIFY row_number() OVER (PARTITION BY ride_code ORDER BY poll_datetime DESC NULLS LAST,
    ride_sk ASC NULLS FIRST, ride_name ASC NULLS FIRST, park_code ASC NULLS FIRST) = 1
) r JOIN ({dim_park()}) p ON p.park_code = r.park_code"""


def dim_gate() -> str:
    return f"""
SELECT {sk('g.gate_id', 'g.park_code')} AS gate_key, g.gate_id, g.gate_location, g.zone_code,
  p.park_key, {AS_OF_TS} AS gold_loaded_at
FROM (
  SELECT gate_id, park_code, max(gate_location) AS gate_location, max(zone_code) AS zone_code
  FROM ({silver_gate_events()}) GROUP BY gate_id, park_code
) g JOIN ({dim_park()}) p ON p.park_code = g.park_code"""


def dim_weather() -> str:
    return f"""
SELECT {sk('weather_code')} AS weather_key, weather_code, weather_description,
  {AS_OF_TS} AS gold_loaded_at
FROM (
  SELECT weather_code, max(weather_description) AS weather_description
  FROM ({silver_weather()}) WHERE weather_code IS NOT NULL GROUP BY weather_code
)"""


def fact_transaction() -> str:
    return f"""
SELECT t.transaction_sk AS transaction_key, d.date_key, p.park_key, c.customer_key, pr.product_key,
  s.staff_key, t.source_transaction_id, t.terminal_id, t.booking_reference,
  CAST(NULL AS VARCHAR) AS refund_reference_id, t.payment_method, t.transaction_status,
  t.sales_channel, t.is_group_booking, t.group_size, t.quantity, t.unit_price, t.gross_amount,
  coalesce(t.discount_amount, 0.0) AS discount_amount, t.net_amount, t.vat_amount, t.total_charged,
  CAST(NULL AS DOUBLE) AS calculated_gross_amount, CAST(NULL AS DOUBLE) AS discount_percentage,
  {AS_OF_TS} AS gold_loaded_at
FROM ({silver_transactions()}) t
JOIN ({dim_date()}) d ON d.full_date = t.transaction_date
JOIN ({dim_park()}) p ON p.park_code = t.park_code
JOIN ({dim_product()}) pr ON pr.product_code = t.product_code
LEFT JOIN ({dim_customer()}) c ON c.source_customer_id = t.source_customer_id
LEFT JOIN ({dim_staff()}) s ON s.source_employee_id = t.cashier_id
WHERE t.transaction_date IS NOT NULL"""


def fact_gate_event() -> str:
    return f"""
SELECT g.gate_event_sk AS gate_event_key, d.date_key, p.park_key, c.customer_key, gt.gate_key,
  g.source_event_id, g.ticket_barcode, g.event_type, g.event_datetime, g.rejection_reason,
  g.is_entry, g.is_rejected, 1 AS event_count, {AS_OF_TS} AS gold_loaded_at
FROM ({silver_gate_events()}) g
JOIN ({dim_date()}) d ON d.full_date = g.event_date
JOIN ({dim_park()}) p ON p.park_code = g.park_code
JOIN ({dim_gate()}) gt ON gt.gate_id = g.gate_id AND gt.park_key = p.park_key
LEFT JOIN ({dim_customer()}) c ON c.source_customer_id = g.source_customer_id
WHERE g.event_date IS NOT NULL"""


def fact_ride_operations() -> str:
    return f"""
SELECT {sk('r.source_record_id')} AS ride_ops_key, d.date_key, p.park_key, rd.ride_key, s.staff_key,
  r.source_record_id, r.poll_datetime, r.operational_status, r.safety_interlock_active,
  r.safety_status, r.wait_time_category, r.current_queue_length, r.estimated_wait_min,
  r.riders_last_cycle, {AS_OF_TS} AS gold_loaded_at
FROM ({silver_ride_operations()}) r
JOIN ({dim_date()}) d ON d.full_date = r.poll_date
JOIN ({dim_park()}) p ON p.park_code = r.park_code
JOIN ({dim_ride()}) rd ON rd.ride_code = r.ride_code
LEFT JOIN ({dim_staff()}) s ON s.source_employee_id = r.lead_operator_id
WHERE r.poll_date IS NOT NULL"""


def fact_customer_feedback() -> str:
    return f"""
SELECT f.feedback_sk AS feedback_key, d.date_key, p.park_key, c.customer_key, f.source_feedback_id,
  f.overall_score, f.nps_raw, f.cleanliness_score, f.staff_score, f.avg_score, f.nps_category,
  f.overall_score_category, f.has_complaint, f.complaint_text, {AS_OF_TS} AS gold_loaded_at
FROM ({silver_feedback()}) f
JOIN ({dim_park()}) p ON p.park_code = f.park_code
LEFT JOIN ({dim_date()}) d ON d.full_date = f.feedback_date
LEFT JOIN ({dim_customer()}) c ON c.source_customer_id = f.source_customer_id"""


def fact_weather_observation() -> str:
    return f"""
SELECT w.weather_sk AS weather_obs_key, d.date_key, p.park_key, wd.weather_key,
  w.weather_timestamp AS poll_datetime, w.temperature_c, w.feels_like_c, w.temperature_min_c,
  w.temperature_max_c, w.temperature_range, w.humidity_pct, w.wind_speed_ms, w.wind_direction_deg,
  w.uv_index, w.visibility_m, w.rainfall_1h_mm, w.air_quality_index, w.temperature_category,
  w.is_raining, w.air_quality_status, {AS_OF_TS} AS gold_loaded_at
FROM ({silver_weather()}) w
JOIN ({dim_date()}) d ON d.full_date = w.weather_date
JOIN ({dim_park()}) p ON p.park_code = w.park_code
JOIN ({dim_weather()}) wd ON wd.weather_code = w.weather_code
WHERE w.weather_date IS NOT NULL AND w.weather_code IS NOT NULL"""


GOLD = {
    "dim_date": dim_date, "dim_park": dim_park, "dim_customer": dim_customer,
    "dim_product": dim_product, "dim_staff": dim_staff, "dim_ride": dim_ride,
    "dim_gate": dim_gate, "dim_weather": dim_weather,
    "fact_transaction": fact_transaction, "fact_gate_event": fact_gate_event,
    "fact_ride_operations": fact_ride_operations,
    "fact_customer_feedback": fact_customer_feedback,
    "fact_weather_observation": fact_weather_observation,
}
