"""Hand-made bronze rows in the park warehouse's landing schema (with dirt)."""

import datetime as dt

T1 = dt.datetime(2025, 3, 1, 8, 0)
T2 = dt.datetime(2025, 3, 2, 8, 0)

META = "ingestion_timestamp timestamp, ingestion_date string, batch_id string, pipeline_name string, validation_status string, is_duplicate string, source_region string"


def meta(ts=T1, dup=None, region="SF"):
    return (ts, ts.date().isoformat(), "BATCH-1", "loader", "PENDING", dup, region)


TXN_SCHEMA = ("bronze_id long, source_transaction_id string, source_system string, source_table string, "
              "park_code string, terminal_id string, cashier_id string, customer_id string, "
              "transaction_datetime string, product_code string, product_description string, "
              "product_category string, unit_price double, quantity long, payment_method string, "
              "transaction_status string, sales_channel string, is_group_booking string, group_size long, "
              "booking_reference string, gross_amount double, discount_amount double, net_amount double, "
              "vat_amount double, total_charged double, refund_reference_id string, cdc_operation string, "
              + META)


def txn(i, tid, dtime, prod="SF-SKU-0001", cust="SF-CUST-0000001", cashier="SF-EMP-0001",
        group="Y", park="SF", ts=T1, dup=None, disc=None, total=115.0):
    return (i, tid, "POS", "sales", park, "T1", cashier, cust, dtime, prod, "f&b item-3", "f&b", 50.0,
            2, "creditCard", "success", "gate", group, 1, "BK1", 100.0, disc, 100.0, 15.0, total,
            None, "INSERT") + meta(ts, dup, park)


def transactions(spark):
    return spark.createDataFrame([
        txn(1, "SF-TXN-1", "2025-03-01 10:00:00"),
        txn(2, "SF-TXN-2", "Invalid-Date-String"),                   # dropped by the fact
        txn(3, "SF-TXN-3", "2025-03-01 11:00:00", group="1"),
        txn(4, "SF-TXN-3", "2025-03-01 11:00:00", group="yes", dup="true"),  # exact copy, same ts
        txn(5, "SF-TXN-4", "2025-03-01 12:00:00", cust=None),         # NULL customer kept
        txn(6, "SF-TXN-5", "2025-03-01 12:00:00", prod="SF-SKU-9999"),  # unknown product dropped
        txn(7, "SF-TXN-6", "2024-01-01 12:00:00"),                   # outside calendar dropped
        txn(8, "SF-TXN-7", "2025-03-01 12:00:00", park="XX"),        # unknown park dropped
        txn(9, "SF-TXN-8", "2025-03-01 12:00:00", total=0.0, disc=5.0),
    ], TXN_SCHEMA)


STAFF_SCHEMA = ("bronze_id long, source_employee_id string, department string, nationality string, "
                "is_active string, " + META)


def staff(spark, extra=()):
    return spark.createDataFrame([
        (1, "SF-EMP-0001", "F&B", "saudi", "1") + meta(),
        (2, "SF-EMP-0002", "ops", "expat", "Y") + meta(),     # 'Y' is not an is_active spelling
        (3, "SF-EMP-0003", "retail", "expat", "no") + meta(),
        *extra], STAFF_SCHEMA)


PRODUCT_SCHEMA = "bronze_id long, product_code string, description string, category string, price double, " + META


def products(spark):
    return spark.createDataFrame([
        (1, " SF-SKU-0001 ", "day pass", "admission", 45.0) + meta(dup="true"),
        (2, "SF-SKU-0002", "burger", "F&B", 120.0) + meta(),
        (3, "SF-SKU-0003", "hoodie", "merch", 250.0) + meta(),
        (4, "SF-SKU-0004", "mystery", "other", None) + meta(),
    ], PRODUCT_SCHEMA)


CUSTOMER_SCHEMA = ("bronze_id long, source_customer_id string, source_system string, full_name string, "
                   "gender string, date_of_birth string, nationality string, email string, phone string, "
                   "resident_type string, loyalty_tier string, registration_date string, first_name string, "
                   "last_name string, loyalty_card_number string, loyalty_points long, app_installed string, "
                   "email_opt_in string, sms_opt_in string, cdc_operation string, record_created_at string, "
                   + META)


def customers(spark):
    return spark.createDataFrame([
        (1, "SF-CUST-0000001", "CRM", "ana LOPEZ", "f", "2000-12-31", "saudi", " A@X.COM ", " 5 ",
         "citizen", "gold", "2025-01-01", "ana", "LOPEZ", "SF-LC-0000001", 10, "True", "Y", "n",
         "INSERT", "2025-01-01 00:00:00") + meta(),
        (2, "SF-CUST-0000001", "CRM", "old name", "f", "2000-12-31", "saudi", "a@x.com", "5",
         "citizen", "gold", "2025-01-01", "old", "name", "SF-LC-0000001", 10, "False", "N", "N",
         "INSERT", "2024-01-01 00:00:00") + meta(),
        (3, "SF-CUST-0000002", "CRM", "bo", "m", "bad", "expat", "b@x.com", "6", "tourist", "none",
         "bad", "bo", None, "SF-LC-0000002", 0, "maybe", None, "y", "INSERT", None) + meta(),
    ], CUSTOMER_SCHEMA)


GATE_SCHEMA = ("bronze_id long, source_event_id string, source_system string, park_code string, gate_id string, "
               "gate_location string, zone_code string, event_type string, customer_id string, "
               "event_datetime string, ticket_barcode string, rejection_reason string, " + META)


def gates(spark):
    return spark.createDataFrame([
        (1, "SF-EVT-1", "GATE", "SF", "G-01", "north plaza", "z01", "entry", "SF-CUST-0000001",
         "2025-03-01 07:15:00", "tk1", None) + meta(),
        (2, "SF-EVT-2", "GATE", "SF", "G-01", "south plaza", "Z02", "EXIT", "SF-CUST-0000001",
         "2025-03-01 13:15:00", "tk2", " - ") + meta(),
        (3, "SF-EVT-3", "GATE", "AQ", "G-01", "aqua gate", "Z01", "other", "AQ-CUST-0000017",
         "2025-03-01 18:15:00", "tk3", "INVALID_TICKET") + meta(region="AQ"),
    ], GATE_SCHEMA)


FEEDBACK_SCHEMA = ("bronze_id long, source_feedback_id string, park_code string, customer_id string, "
                   "feedback_date string, overall_score long, nps_raw long, cleanliness_score long, "
                   "staff_score long, has_complaint string, complaint_text string, " + META)


def feedback(spark):
    return spark.createDataFrame([
        (1, "SF-FBK-1", "SF", "SF-CUST-0000001", "2025-03-01", 9, 10, 4, 5, "true", "  queue  ") + meta(),
        (2, "SF-FBK-2", "SF", None, "not a date", 11, -1, 3, 3, "False", "-") + meta(),
    ], FEEDBACK_SCHEMA)


WEATHER_SCHEMA = ("bronze_id long, park_code string, poll_datetime string, temperature_c double, "
                  "feels_like_c double, temperature_min_c double, temperature_max_c double, humidity_pct long, "
                  "wind_speed_ms double, wind_direction_deg long, uv_index long, visibility_m long, "
                  "rainfall_1h_mm double, weather_code string, weather_description string, "
                  "air_quality_index long, http_status_code string, api_error_message string, " + META)


def weather(spark):
    return spark.createDataFrame([
        (1, "SF", "2025-03-01T00:00:00", 41.0, 43.0, 30.0, 44.0, 10, 3.0, 90, 9, 10000, 0.0, "clear",
         "normal", 2, "200", None) + meta(T1),
        (2, "SF", "2025-03-01T00:00:00", 35.0, 36.0, 30.0, 38.0, 10, 3.0, 90, 9, 10000, 1.5, "rain",
         "normal", 5, "200", None) + meta(T2),                      # later load of the same poll wins
        (3, "AQ", "2025-03-01T00:00:00", 15.0, 14.0, 10.0, 18.0, 10, 3.0, 90, 9, 10000, 0.0, None,
         "normal", 3, "200", None) + meta(T1, region="AQ"),        # no code -> not in the fact
    ], WEATHER_SCHEMA)


RIDE_SCHEMA = ("bronze_id long, source_record_id string, source_system string, park_code string, ride_code string, "
               "ride_name string, poll_datetime string, operational_status string, current_queue_length long, "
               "estimated_wait_min long, riders_last_cycle long, safety_interlock_active string, "
               "lead_operator_id string, " + META)


def rides(spark):
    return spark.createDataFrame([
        (1, "SF-OPS-1", "scada", "sf", "sf-ride-01", "falcon", "2025-03-01 09:00:00", "operational",
         10, 65, 20, "true", "SF-EMP-0003") + meta(),
        (2, "SF-OPS-2", "scada", "SF", "SF-RIDE-01", "falcon flight", "2025-03-01 19:00:00", "closed",
         0, 5, 0, "false", "SF-EMP-9999") + meta(),
        (3, "SF-OPS-3", "scada", "SF", "SF-RIDE-02", "tide", "bad", "operational", 1, 30, 2, "x",
         None) + meta(),
    ], RIDE_SCHEMA)


PARKS = [(1, "SF", "Park one"), (2, "AQ", "Park two")]
