import datetime as dt

from pyspark.sql import functions as F

from strata.functions import cases as C
from strata.functions import dates, keys, text


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_surrogate_key_vectors(spark):
    df = spark.createDataFrame(
        [("SF-CUST-0000001", None, None), (None, None, None), ("G-01", "SF", None),
         ("SF", "2025-01-01T00:00:00", None)], "a string, b string, c string")
    got = df.select(keys.uuid_key("a").alias("k1"), keys.uuid_key("a", "b").alias("k2")).collect()
    assert got[0].k1 == "4dba2a05-5fe6-af4d-2531-36284f0f4056"
    assert got[1].k1 == "f14cc5cd-ce04-20f4-a5a6-b6d9d7b85f39"
    assert got[2].k2 == "f8442403-b52c-10b6-588f-23ed556aaae4"
    assert got[3].k2 == "570256f4-d4ff-f24f-0c66-e9e0ab4b724b"


def test_uuid_format_matches_regex_form(spark):
    df = spark.createDataFrame([("x",), ("y",)], "a string")
    h = keys.surrogate_key("a")
    via_regex = F.regexp_replace(h, "^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$",
                                 "$1-$2-$3-$4-$5")
    rows = df.select(keys.uuid_format(h).alias("a"), via_regex.alias("b")).collect()
    assert all(r.a == r.b and len(r.a) == 36 for r in rows)


def test_to_bool_sets_per_column(spark):
    vals = [("1",), ("true",), ("Y",), ("yes",), (" No ",), ("n",), (None,), ("maybe",)]
    s = "x string"
    assert one(spark, C.to_bool_set("x", C.GROUP_BOOKING), vals, s) == \
        [True, True, True, True, False, False, None, None]
    # is_active has no 'y': an injected 'Y' becomes NULL
    assert one(spark, C.to_bool_set("x", C.ACTIVE), vals, s) == \
        [True, True, None, True, False, None, None, None]
    assert one(spark, C.to_bool_set("x", C.YES_NO_LETTER), vals, s) == \
        [None, None, True, None, None, False, None, None]


def test_text_normalisers(spark):
    rows = [("  f&b item-3 ",), ("creditCard",), (None,)]
    assert one(spark, text.initcap_trim("x"), rows, "x string") == ["F&b Item-3", "Creditcard", None]
    assert one(spark, text.upper_trim("x"), rows, "x string") == ["F&B ITEM-3", "CREDITCARD", None]
    assert one(spark, text.null_tokens("x"), [(" - ",), ("",), ("  ",), (" ok ",), (None,)],
               "x string") == [None, None, None, "ok", None]
    assert one(spark, text.concat_words("a", "b"), [("x", "y"), ("x", None)],
               "a string, b string") == ["x y", None]
    assert one(spark, text.scrub_null_text("x"), [("None",), ("nan",), ("NaN",), ("NULL",),
                                                  ("nULl",), ("none",), ("v",)], "x string") == \
        [None, None, None, None, None, "none", "v"]


def test_split_first_rest(spark):
    rows = [("ana maria lopez",), ("single",), (None,)]
    assert one(spark, text.split_first("x"), rows, "x string") == ["ana", "single", None]
    assert one(spark, text.split_rest("x"), rows, "x string") == ["maria lopez", None, None]


def test_ladders_and_bands_null_behaviour(spark):
    s = "x double"
    rows = [(45.0,), (30.0,), (20.0,), (5.0,), (None,)]
    assert one(spark, C.temperature_category("x"), rows, s) == \
        ["EXTREME_HEAT", "HOT", "WARM", "COOL", "COOL"]
    assert one(spark, C.air_quality_status("x"), [(1.0,), (3.0,), (5.0,), (None,)], s) == \
        ["GOOD", "MODERATE", "POOR", "POOR"]
    assert one(spark, C.price_band("x"), [(10.0,), (100.0,), (500.0,), (None,)], s) == \
        ["Low", "Medium", "High", "High"]
    assert one(spark, C.nps_category("x"), [(10,), (7,), (0,), (11,), (None,)], "x int") == \
        ["Promoter", "Passive", "Detractor", None, None]
    assert one(spark, C.score_category("x"), [(9,), (8,), (5,), (4,), (-1,)], "x int") == \
        ["Excellent", "Good", "Average", "Poor", None]


def test_time_of_day_edges(spark):
    ts = [(dt.datetime(2025, 1, 1, h, 30),) for h in (5, 6, 11, 12, 16, 17, 20, 21)] + [(None,)]
    assert one(spark, C.time_of_day("x"), ts, "x timestamp") == \
        ["Off-Hours", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening",
         "Off-Hours", "Off-Hours"]


def test_range_guard_and_discount(spark):
    assert one(spark, C.in_range_or_null("x", 0, 10), [(11,), (-1,), (0,), (10,), (None,)],
               "x long") == [None, None, 0, 10, None]
    df = spark.createDataFrame([(0.0, 5.0, 10.0), (8.0, 5.0, 0.0), (8.0, 2.0, 10.0)],
                               "t double, d double, g double")
    got = [r[0] for r in df.select(C.discount_pct("t", "d", "g")).collect()]
    assert got == [0.0, None, 20.0]


def test_category_map_and_flags(spark):
    rows = [("F&B",), ("MERCH",), ("ADMISSION",), ("FASTPASS",), ("X",), (None,)]
    assert one(spark, C.category_group("x"), rows, "x string") == \
        ["Food & Beverage", "Merchandise", "Tickets", "Fast Track", "Other", "Other"]
    assert one(spark, C.three_valued("x", C.ENTRY_EXIT), [("ENTRY",), ("EXIT",), ("X",)],
               "x string") == [True, False, None]
    assert one(spark, C.status_label("x", C.STAFF_STATUS), [(True,), (False,), (None,)],
               "x boolean") == ["ACTIVE", "INACTIVE", "INACTIVE"]
    assert one(spark, C.any_true("a", "b"), [(True, None), (None, None), (False, True)],
               "a boolean, b boolean") == [True, False, True]


def test_date_spine_and_calendar(spark):
    d = dates.date_spine(spark)
    assert d.count() == 730 == dates.spine_days()
    row = d.select(*dates.calendar_columns("dt")).filter("full_date = DATE'2026-04-03'").first()
    assert row.date_key == 20260403 and row.date_iso == "04/03/2026"
    assert row.weekday_name == "Friday" and row.day_of_week == 6 and row.is_weekend is True
    assert row.quarter == 2 and row.month_name == "April" and row.day_of_year == 93


def test_whole_years(spark):
    df = spark.createDataFrame([(dt.date(2000, 12, 31), dt.date(2001, 1, 1)),
                                (dt.date(2000, 1, 1), dt.date(2010, 1, 1))], "a date, b date")
    got = [r[0] for r in df.select(dates.whole_years_between("a", "b")).collect()]
    assert got == [0, 10]


def test_nan_to_null_and_casts(spark):
    from strata.functions import casts
    df = spark.createDataFrame([(float("nan"), "5.5", "2025-01-01 10:00:00"), (1.5, "7", "bad")],
                               "x double, s string, t string")
    got = df.select(casts.nan_to_null("x").alias("x"), casts.try_cast("s", "int").alias("i"),
                    casts.lenient_date("t").alias("d")).collect()
    assert [(r.x, r.i) for r in got] == [(None, None), (1.5, 7)]
    assert got[0].d == dt.date(2025, 1, 1) and got[1].d is None


def test_write_landing_skips_empty(spark, tmp_root):
    from strata.sources import write_landing
    empty = spark.createDataFrame([], "a string")
    assert write_landing(empty, tmp_root, "sf_x") is False
    df = spark.createDataFrame([("b",), ("a",)], "a string")
    assert write_landing(df, tmp_root, "sf_y", order_by=["a"]) is True
    got = spark.read.parquet(f"{tmp_root}/landing_zone/sf_y").orderBy("bronze_id").collect()
    assert [(r.bronze_id, r.a) for r in got] == [(1, "a"), (2, "b")]
