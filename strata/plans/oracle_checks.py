"""The declared tests written out for the oracle, apart from the library's own
list: one line a test, ``model kind column [arguments]``."""

from __future__ import annotations

from . import driver_tables as D
from . import oracle_sql as O

BRONZE_TESTS = """
raw_customers not_null source_customer_id
raw_customers not_null gender
raw_customers accepted_values gender 'M','F'
raw_customers not_null loyalty_points
raw_customers accepted_values app_installed 'True','False'
raw_customers accepted_values email_opt_in 'Y','N'
raw_customers accepted_values sms_opt_in 'Y','N'
raw_gate_events not_null source_event_id
raw_products not_null product_code
raw_ride_operations not_null source_record_id
raw_staff not_null source_employee_id
raw_transactions not_null source_transaction_id
raw_feedback not_null source_feedback_id
raw_weather not_null park_code
raw_weather accepted_values park_code 'AFRICA','AMERICA','ASIA','EUROPE','MIDDLE EAST'
"""

GOLD_TESTS = """
dim_date unique_combination date_key,full_date
dim_date matches date_iso ^[0-9]{2}/[0-9]{2}/[0-9]{4}$
dim_date unique date_key
dim_date not_null date_key
dim_date range date_key 19950101 20241231
dim_date unique full_date
dim_date not_null full_date
dim_date unique date_iso
dim_date not_null date_iso
dim_date not_null is_weekend
dim_date accepted_values is_weekend TRUE,FALSE
dim_park unique park_key
dim_park not_null park_key
dim_park accepted_values park_key 0,1,2,3,4
dim_park unique park_code
dim_park not_null park_code
dim_park accepted_values park_code 'AFRICA','AMERICA','ASIA','EUROPE','MIDDLE EAST'
dim_park row_count - 5
dim_customer uuid customer_key
dim_customer at_least_one customer_key
dim_customer unique customer_key
dim_customer not_null customer_key
dim_customer unique source_customer_id
dim_customer not_null source_customer_id
dim_product uuid product_key
dim_product at_least_one product_key
dim_product unique product_key
dim_product not_null product_key
dim_product unique product_code
dim_product not_null product_code
dim_product not_null list_price
dim_product range list_price 0 -
dim_staff uuid staff_key
dim_staff at_least_one staff_key
dim_staff unique staff_key
dim_staff not_null staff_key
dim_staff unique source_employee_id
dim_staff not_null source_employee_id
dim_staff accepted_values staff_status 'ACTIVE','INACTIVE'
dim_ride uuid ride_key
dim_ride unique ride_key
dim_ride not_null ride_key
dim_ride unique ride_code
dim_ride not_null ride_code
dim_ride not_null park_key
dim_ride relationships park_key dim_park park_key
dim_gate uuid gate_key
dim_gate unique_combination gate_id,park_key
dim_gate unique gate_key
dim_gate not_null gate_key
dim_gate not_null gate_id
dim_gate not_null park_key
dim_gate relationships park_key dim_park park_key
dim_weather uuid weather_key
dim_weather unique weather_key
dim_weather not_null weather_key
dim_weather unique weather_code
dim_weather not_null weather_code
fact_transaction unique_combination source_transaction_id
fact_transaction unique transaction_key
fact_transaction not_null transaction_key
fact_transaction not_null date_key
fact_transaction relationships date_key dim_date date_key
fact_transaction range date_key 19950101 20241231
fact_transaction not_null park_key
fact_transaction relationships park_key dim_park park_key
fact_transaction not_null product_key
fact_transaction relationships product_key dim_product product_key
fact_transaction relationships customer_key dim_customer customer_key
fact_transaction relationships staff_key dim_staff staff_key
fact_transaction not_null quantity
fact_transaction not_null total_charged
fact_gate_event unique_combination source_event_id
fact_gate_event unique gate_event_key
fact_gate_event not_null gate_event_key
fact_gate_event not_null date_key
fact_gate_event relationships date_key dim_date date_key
fact_gate_event not_null park_key
fact_gate_event relationships park_key dim_park park_key
fact_gate_event not_null gate_key
fact_gate_event relationships gate_key dim_gate gate_key
fact_gate_event relationships customer_key dim_customer customer_key
fact_gate_event not_null event_count
fact_gate_event accepted_values event_count 1
fact_ride_operations unique_combination source_record_id
fact_ride_operations unique ride_ops_key
fact_ride_operations not_null ride_ops_key
fact_ride_operations not_null date_key
fact_ride_operations relationships date_key dim_date date_key
fact_ride_operations not_null park_key
fact_ride_operations relationships park_key dim_park park_key
fact_ride_operations not_null ride_key
fact_ride_operations relationships ride_key dim_ride ride_key
fact_ride_operations relationships staff_key dim_staff staff_key
fact_ride_operations not_null operational_status
fact_customer_feedback unique feedback_key
fact_customer_feedback not_null feedback_key
fact_customer_feedback not_null park_key
fact_customer_feedback relationships park_key dim_park park_key
fact_customer_feedback relationships date_key dim_date date_key
fact_customer_feedback relationships customer_key dim_customer customer_key
fact_customer_feedback range overall_score 0 10
fact_customer_feedback range nps_raw 0 10
fact_weather_observation unique weather_obs_key
fact_weather_observation not_null weather_obs_key
fact_weather_observation not_null date_key
fact_weather_observation relationships date_key dim_date date_key
fact_weather_observation not_null park_key
fact_weather_observation relationships park_key dim_park park_key
fact_weather_observation not_null weather_key
fact_weather_observation relationships weather_key dim_weather weather_key
fact_weather_observation range temperature_c -20 65
"""

UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def _parse(tests: str) -> list[list[str]]:
    return [line.split(" ", 3) for line in tests.strip().splitlines()]


def _failures(t: str, kind: str, col: str, args: str, tables) -> tuple[str, str]:
    """Label of a test and SQL for the number of its failures."""
    if kind == "not_null":
        return f"not_null({col})", f"SELECT count(*) FROM {t} WHERE {col} IS NULL"
    if kind == "accepted_values":
        return f"accepted_values({col})", f"SELECT count(*) FROM {t} WHERE {col} NOT IN ({args})"
    if kind == "range":
        lo, hi = args.split(" ")
        bad = [f"{col} < {lo}"] + ([f"{col} > {hi}"] if hi != "-" else [])
        return f"accepted_range({col})", f"SELECT count(*) FROM {t} WHERE {' OR '.join(bad)}"
    if kind in ("uuid", "matches"):
        pattern = UUID if kind == "uuid" else args
        return (f"expression_is_true({col} RLIKE '{pattern}')",
                f"SELECT count(*) FROM {t} WHERE NOT regexp_matches({col}, '{pattern}')")
    if kind == "at_least_one":
        return f"at_least_one({col})", f"SELECT CASE WHEN count({col}) = 0 THEN 1 ELSE 0 END FROM {t}"
    if kind == "row_count":
        return "row_count()", f"SELECT CASE WHEN count(*) <> {args} THEN 1 ELSE 0 END FROM {t}"
    if kind == "unique":
        return f"unique({col})", (f"SELECT count(*) FROM (SELECT {col} FROM {t} WHERE {col} IS NOT NULL "
                                  f"GROUP BY {col} HAVING count(*) > 1)")
    if kind == "unique_combination":
        return f"unique_combination({col})", (f"SELECT count(*) FROM (SELECT {col} FROM {t} "
                                              f"GROUP BY {col} HAVING count(*) > 1)")
    parent, pk = args.split(" ")
    return f"relationships({col})", (f"SELECT count(*) FROM {t} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                                     f"(SELECT 1 FROM {tables(parent)} p WHERE p.{pk} = c.{col})")


def _rows(tests: str, tables) -> list[str]:
    out = []
    for model, kind, col, *args in _parse(tests):
        label, sql = _failures(tables(model), kind, col, args[0] if args else "", tables)
        label = label.replace("'", "''")
        out.append(f"SELECT '{model}' AS model, '{label}' AS test, CAST(({sql}) AS BIGINT) AS failures, 'error' AS severity")
    return out


def _with_status(rows: list[str], ctes: str = "") -> str:
    body = "\nUNION ALL ".join(rows)
    return (f"{ctes}SELECT model, test, failures, severity, CASE WHEN failures = 0 THEN 'PASS' "
            f"WHEN severity = 'warn' THEN 'WARN' ELSE 'FAIL' END AS status FROM ({body})")


def _ctes(bronze: bool) -> str:
    parts = [f"{m} AS MATERIALIZED ({O.GOLD[m]()})" for m in O.GOLD]
    if bronze:
        parts += [f"{m} AS MATERIALIZED ({D.landing_sql(m)})" for m in sorted({t[0] for t in _parse(BRONZE_TESTS)})]
    return "WITH " + ",\n".join(parts) + "\n"


def gold_checks_sql() -> str:
    return _with_status(_rows(GOLD_TESTS, lambda m: m), _ctes(False))


def all_checks_sql() -> str:
    rows = _rows(BRONZE_TESTS, lambda m: m) + _rows(GOLD_TESTS, lambda m: m)
    floor = []
    for fact, silver, cond in (
            ("fact_transaction", "silver_transactions", "transaction_date IS NOT NULL"),
            ("fact_gate_event", "silver_gate_events", "event_date IS NOT NULL"),
            ("fact_ride_operations", "silver_ride_opeartions", "poll_date IS NOT NULL"),
            ("fact_customer_feedback", "silver_feedback", "TRUE"),
            ("fact_weather_observation", "silver_weather", "weather_date IS NOT NULL AND weather_code IS NOT NULL")):
        floor.append(f"(CASE WHEN (SELECT count(*) FROM {fact}) < (SELECT CAST(trunc(count(*) * 0.95) AS BIGINT) "
                     f"FROM ({O.SILVER[silver]()}) WHERE {cond}) THEN 1 ELSE 0 END)")
    inactive = [f"(SELECT count(*) FROM {f} f JOIN dim_staff d ON d.staff_key = f.staff_key WHERE d.is_active = FALSE)"
                for f in ("fact_transaction", "fact_ride_operations")]
    late = []
    for f, keys in (("fact_transaction", "date_key park_key product_key"), ("fact_gate_event", "date_key park_key gate_key"),
                    ("fact_ride_operations", "date_key park_key ride_key"),
                    ("fact_weather_observation", "date_key park_key weather_key"), ("fact_customer_feedback", "park_key")):
        late += [f"(CASE WHEN EXISTS (SELECT 1 FROM {f} WHERE {k} IS NULL) THEN 1 ELSE 0 END)" for k in keys.split()]
    for name, severity, parts in (("gold_audit_reconciliation", "warn", floor), ("gold_inactive_staff_in_facts", "warn", inactive),
                                  ("gold_late_arriving_dimensions", "error", late)):
        rows.append(f"SELECT 'singular', '{name}', CAST({' + '.join(parts)} AS BIGINT), '{severity}'")
    return _with_status(rows, _ctes(True))
