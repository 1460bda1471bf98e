"""Column functions against values worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallywharf.functions import clock, shares, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_local_time_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        local = clock.local_time(F.lit(1622208592))
        assert value(spark, clock.day_text(local)) == "2021-05-28"
        assert value(spark, clock.hour_text(local)) == "21"
        assert value(spark, clock.minute_text(local)) == "2021-05-28 21:29"
        # A wall-clock time that the zone of the session skips.
        skipped = clock.wall_clock("2024-03-10 02:30:00")
        assert value(spark, clock.wall_seconds(skipped)) == 1710037800
        assert value(spark, clock.wall_micros(clock.wall_clock("1970-01-01 00:00:01.5"))) == 1500000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hours_are_not_padded(spark):
    assert value(spark, clock.hour_text(clock.local_time(F.lit(1622160000)))) == "8"


def test_out_of_range_seconds_are_null(spark):
    assert value(spark, clock.local_time(F.lit(10**18))) is None


@pytest.mark.parametrize("raw, parsed", [
    ("2021-05-28 21:29:52", dt.datetime(2021, 5, 28, 21, 29, 52)),
    ("2021-02-30 00:00:00", None),
    ("2021-05-28", None),
    ("junk", None),
    (None, None),
])
def test_parse_local(spark, raw, parsed):
    assert value(spark, clock.parse_local(F.lit(raw).cast("string"))) == parsed


@pytest.mark.parametrize("phone, masked", [
    ("13812345678", "138****5678"), ("1234567", "123****4567"), ("123456", "123456"), (None, None),
    ("Customer#000000001", "Cus****omer#000****0001"),
])
def test_mask(spark, phone, masked):
    assert value(spark, text.mask_phone(F.lit(phone).cast("string"))) == masked


@pytest.mark.parametrize("birthday, as_of, age", [
    ("1991-06-01", "2021-06-01 00:00:00", 30),
    # 30 * 365 days after the birthday, and a second before that.
    ("1991-06-01", "2021-05-24 00:00:00", 30),
    ("1991-06-01", "2021-05-23 23:59:59", 29),
    ("2021-06-02", "2021-06-01 00:00:00", 0),
    ("never", "2021-06-01 00:00:00", None),
    (None, "2021-06-01 00:00:00", None),
])
def test_age(spark, birthday, as_of, age):
    assert value(spark, clock.age_years(F.lit(birthday).cast("string"), clock.wall_clock(as_of))) == age


def test_percent_is_half_even(spark):
    assert value(spark, shares.percent(F.lit(1), F.lit(800))) == 0.12
    assert value(spark, shares.percent(F.lit(3), F.lit(800))) == 0.38
    assert value(spark, shares.percent(F.lit(1), F.lit(0))) is None


@pytest.mark.parametrize("age, band", [(19, shares.UNDER_20), (20, shares.FROM_20_TO_29), (29, shares.FROM_20_TO_29),
                                       (30, shares.FROM_30), (None, None)])
def test_age_band(spark, age, band):
    assert value(spark, shares.age_band(F.lit(age).cast("int"))) == band


@pytest.mark.parametrize("gender, band", [("F", shares.FEMALE), ("M", shares.MALE), ("x", shares.MALE), (None, None)])
def test_gender_band(spark, gender, band):
    assert value(spark, shares.gender_band(F.lit(gender).cast("string"))) == band


def test_words(spark):
    assert sorted(value(spark, text.words(F.lit("Red-bolt, RED x1 红色")))) == ["bolt", "red", "x1", "红", "色"]


@pytest.mark.parametrize("name, keyword, score", [
    ("Red bolt", "bolt red bolt", 2), ("Redbolt", "red", 0), ("small ring", "ring", 1), (None, "ring", 0),
    ("ring", "", 0), ("小米手机", "手机", 2),
])
def test_match_score(spark, name, keyword, score):
    assert value(spark, text.match_score(F.lit(name).cast("string"), keyword)) == score


def test_previous_day(spark):
    assert value(spark, clock.previous_day(F.lit("2024-03-01"))) == "2024-02-29"
