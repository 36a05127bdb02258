"""Truth tables of single expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import dates, numbers, text
from tidemark.operators import clean, star


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw, number, error", [
    (None, None, "MSISDN is null"),
    ("  ", "", "MSISDN is empty"),
    ("21698765432", "21698765432", None),
    ("+216 98 765 432", "21698765432", None),
    ("98765432", "21698765432", None),
    ("098765432", "21698765432", None),
    ("0987654321", "216987654321", "Invalid length: 12"),
    ("00000000", "2160000000", "Invalid length: 10"),
    ("12345", "12345", "Invalid length: 5"),
    ("12345678901", "12345678901", "Missing prefix 216"),
    ("21612345", "21612345", "Invalid length: 8"),
    ("abc", "", "Invalid length: 0"),
])
def test_msisdn(spark, raw, number, error):
    candidate = one(spark, raw, text.msisdn_candidate)
    assert candidate == number
    assert one(spark, raw, lambda c: text.msisdn_error(c, text.msisdn_candidate(c))) == error
    assert one(spark, raw, lambda c: text.msisdn_valid(text.msisdn_candidate(c))) == (error is None)


@pytest.mark.parametrize("raw, parsed, error", [
    ("1/5/2024 9:3:2", dt.datetime(2024, 1, 5, 9, 3, 2), None),
    ("15/01/2024 10:30:00", dt.datetime(2024, 1, 15, 10, 30), None),
    ("05/03/2024 00:00:00", dt.datetime(2024, 5, 3), None),
    ("05/03/2019 00:00:00", dt.datetime(2019, 5, 3), "Year out of range: 2019"),
    ("2024-02-30 00:00:00", None, "Could not parse date: 2024-02-30 00:00:00"),
    ("2024/1/2 03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5), None),
    ("2024-1/2 03:04:05", None, "Could not parse date: 2024-1/2 03:04:05"),
    ("31-12-2026  23:59:59", dt.datetime(2026, 12, 31, 23, 59, 59), None),
    (" 2024-01-02 24:00:00", None, "Could not parse date: 2024-01-02 24:00:00"),
    ("02/30/2024 00:00:00", None, "Could not parse date: 02/30/2024 00:00:00"),
    ("2024-01-02", None, "Could not parse date: 2024-01-02"),
    ("", None, "Date is empty"),
    (None, None, "Date is null"),
])
def test_date(spark, raw, parsed, error):
    assert one(spark, raw, dates.parse_timestamp) == parsed
    assert one(spark, raw, lambda c: dates.date_error(c, dates.parse_timestamp(c))) == error
    assert one(spark, raw, lambda c: dates.date_valid(dates.parse_timestamp(c))) == (error is None)


@pytest.mark.parametrize("raw", ["l'aouina el-menzah 2eme", "TUNIS", "el  menzah", "a1b2 c", "école d'été", "x_y z", " 'q"])
def test_title_is_python_title(spark, raw):
    assert one(spark, raw, text.title) == raw.title()


@pytest.mark.parametrize("offer, category", [
    ("Office 20", "Pro"), ("promo ete", "Pro"), ("Campaign X", "Promo"), ("villa", "Villa"), ("Gold", "Standard"), ("", "Other"), (None, "Other"),
])
def test_category(spark, offer, category):
    assert one(spark, offer, text.offer_category) == category


def test_category_rules_can_be_reordered(spark):
    rules = [fixed.OFFER_KEYWORDS[2], fixed.OFFER_KEYWORDS[0]]
    assert one(spark, "promo ete", lambda c: text.offer_category(c, rules)) == "Promo"


@pytest.mark.parametrize("raw, code", [("1001", 1001), (" 1001.0 ", 1001), ("10a", None), ("n", None), ("1.5", None), (None, None)])
def test_postal(spark, raw, code):
    assert one(spark, raw, text.postal_code) == code


@pytest.mark.parametrize("lat, lon, error", [
    (None, "9", None), ("36", None, None), ("36", "9", None), ("30", "12", None), ("38.5", "99", "Latitude out of bounds: 38.5"),
    ("36", "6.5", "Longitude out of bounds: 6.5"), ("x", "9", "Invalid coordinate format"), ("36d", "9", "Invalid coordinate format"),
])
def test_coordinates(spark, lat, lon, error):
    df = spark.createDataFrame([(lat, lon)], "a string, b string")
    a, b = numbers.to_double(F.col("a")), numbers.to_double(F.col("b"))
    row = df.select(numbers.coordinate_error(F.col("a"), F.col("b"), a, b).alias("e"), numbers.coordinates_valid(a, b).alias("v")).first()
    assert row["e"] == error
    assert row["v"] == (error is None and lat is not None and lon is not None)


@pytest.mark.parametrize("raw, error", [
    (None, "KIT_CODE is null"), (" ", "KIT_CODE is empty"), ("without x", "Invalid kit code (starts with WITHOUT)"), (" kit1 ", None),
])
def test_kit(spark, raw, error):
    code = lambda c: F.upper(text.strip(c))
    assert one(spark, raw, lambda c: text.kit_error(c, code(c))) == error
    assert one(spark, raw, lambda c: text.kit_valid(code(c))) == (error is None)


def test_holidays_as_written_swaps_day_and_month(spark):
    swapped = star.dim_time(spark, 2024, 2024, holidays_as_written=True).filter("is_holiday")
    assert [str(r["full_date"]) for r in swapped.orderBy("full_date").collect()] == ["2024-01-01", "2024-01-05", "2024-09-04"]
    right = star.dim_time(spark, 2024, 2024).filter("is_holiday")
    assert [(r["full_date"].month, r["full_date"].day) for r in right.orderBy("full_date").collect()] == fixed.YEARLY_HOLIDAYS


def test_whole_record(spark):
    row = ("KIT001", "21698765432", "m18", "Pack Home", "50M", "el menzah", "tunis", "1001", "36.8500", "10.1900", "el menzah", "tunis", "01/15/2024 10:30:00")
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in fixed.LANDING_COLUMNS))
    r = clean.validate(df).first()
    assert (r["msisdn"], r["dealer_id"], r["city"], r["postal_code"], r["is_valid"], r["errors"]) == ("21698765432", "M18", "El Menzah", 1001, True, [])
    assert str(r["latitude"]) == "36.85000000" and r["creation_date"] == dt.datetime(2024, 1, 15, 10, 30)


def test_validity_as_written_keeps_bad_rows(spark):
    df = spark.createDataFrame([(None,) * 13], ", ".join(f"{c} string" for c in fixed.LANDING_COLUMNS))
    assert clean.validate(df).first()["is_valid"] is False
    assert clean.validate(df, "as_written").first()["is_valid"] is True


def test_hashed_normal_is_standard(spark):
    draws = spark.range(20000).select(numbers.hashed_normal(F.lit(1), F.col("id")).alias("z"))
    r = draws.agg(F.avg("z").alias("m"), F.stddev("z").alias("s"), F.count_distinct("z").alias("n")).first()
    assert abs(r["m"]) < 0.03 and abs(r["s"] - 1) < 0.03 and r["n"] > 19900


def test_a_filter_on_the_date_parses_it_once(spark):
    from pyspark.sql import functions as F

    from tidemark.functions import dates

    text = F.concat(F.col("id").cast("string"), F.lit("-05-01 10:00:00"))
    kept = spark.range(2018, 2030).withColumn("d", dates.parse_timestamp(text)).filter(dates.date_valid(F.col("d")))
    assert sorted(r.id for r in kept.select("id").collect()) == list(range(2020, 2027))
    assert kept.select("id")._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1
