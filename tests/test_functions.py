import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintora import functions as fn


def value(spark, column, **inputs):
    df = spark.range(1).select(*[c.alias(n) for n, c in inputs.items()])
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("ms, expected", [
    (None, None), (0.0, None), (-5.0, None),
    (946706400000.0, dt.datetime(2000, 1, 1, 0, 0)),
    (946706400123.0, dt.datetime(2000, 1, 1, 0, 0, 0, 123000)),
])
def test_epoch_ms_to_local(spark, ms, expected):
    assert value(spark, fn.epoch_ms_to_local("x"), x=F.lit(ms).cast("double")) == expected


def test_epoch_round_trip(spark):
    back = value(spark, fn.local_to_epoch_ms(fn.epoch_ms_to_local("x")),
                 x=F.lit(946706400000.0))
    assert back == 946706400000


@pytest.mark.parametrize("text, expected", [
    ("2024-05-01T06:00:00Z", dt.datetime(2024, 5, 1)),
    ("2024-05-01T06:00:00+02:00", dt.datetime(2024, 4, 30, 22)),
    ("No Information", None), ("", None), (None, None), ("2024-13-45", None),
])
def test_iso_to_local(spark, text, expected):
    assert value(spark, fn.iso_to_local("x"), x=F.lit(text).cast("string")) == expected


@pytest.mark.parametrize("text, expected", [
    ("1990-02-03", dt.date(1990, 2, 3)), ("1990-02-03T10:00", dt.date(1990, 2, 3)),
    ("00/00/0000", None), ("2024-13-45", None), ("1899-12-31", None), ("2100-01-02", None),
    (None, None),
])
def test_text_to_date(spark, text, expected):
    assert value(spark, fn.text_to_date("x"), x=F.lit(text).cast("string")) == expected


@pytest.mark.parametrize("text, expected", [
    (" 19.5 ", 19.5), ("", None), ("0", None), ("19,5", None), ("91", None), (None, None),
])
def test_coordinate(spark, text, expected):
    assert value(spark, fn.coordinate("x", 90), x=F.lit(text).cast("string")) == expected


@pytest.mark.parametrize("day, monday, thursday", [
    ("2026-08-14", "2026-08-14", "2026-08-13"),   # Friday
    ("2026-08-15", "2026-08-17", "2026-08-13"),   # Saturday
    ("2026-08-16", "2026-08-17", "2026-08-13"),   # Sunday
    ("2026-08-13", "2026-08-13", "2026-08-13"),   # Thursday
    ("2026-08-12", "2026-08-12", "2026-08-06"),   # Wednesday
])
def test_weekdays(spark, day, monday, thursday):
    x = F.lit(day).cast("date")
    assert str(value(spark, fn.to_monday("x"), x=x)) == monday
    assert str(value(spark, fn.last_thursday("x"), x=x)) == thursday


def test_calendar_months_ignore_the_day(spark):
    a, b = F.lit("2024-01-31").cast("date"), F.lit("2024-02-01").cast("date")
    assert value(spark, fn.months_between("a", "b"), a=a, b=b) == 1
    assert value(spark, fn.months_between("b", "a"), a=a, b=b) == -1


@pytest.mark.parametrize("days, bucket", [
    (None, None), (-3, "Ongoing"), (0, "Ongoing"), (1, "DQ 1-6"), (6, "DQ 1-6"), (7, "DQ 7-14"),
    (14, "DQ 7-14"), (15, "DQ 15-29"), (29, "DQ 15-29"), (30, "DQ 30-59"), (59, "DQ 30-59"),
    (60, "DQ 60-89"), (89, "DQ 60-89"), (90, "DQ 90+"), (500, "DQ 90+"),
])
def test_bucket(spark, days, bucket):
    assert value(spark, fn.delinquency_bucket("x"), x=F.lit(days).cast("int")) == bucket


@pytest.mark.parametrize("days, expected", [(None, None), (0, 0), (6, 0), (7, 200), (15, 400)])
def test_penalty(spark, days, expected):
    assert value(spark, fn.penalty("x", 200), x=F.lit(days).cast("int")) == expected


@pytest.mark.parametrize("x, expected", [(2.5, 2), (3.5, 4), (-2.5, -2), (2.4999999999, 2)])
def test_rounded_long(spark, x, expected):
    assert value(spark, fn.rounded_long("x"), x=F.lit(x)) == expected


def test_keys(spark):
    assert value(spark, fn.int_key("x"), x=F.lit(" 351229")) == 351229
    assert value(spark, fn.int_key("x"), x=F.lit("  ")) is None
    assert value(spark, fn.digits_key("x"), x=F.lit("CP-01020")) == 1020
    assert value(spark, fn.digits_key("x"), x=F.lit("none")) is None


def test_not_in_keeps_null(spark):
    x = F.lit(None).cast("string")
    assert value(spark, fn.not_in_or_null("x", ("A", "B")), x=x) is True


def test_evidence_sign(spark):
    # Inverted on purpose: more bad than good gives a positive weight.
    args = dict(g=F.lit(10), b=F.lit(30), tg=F.lit(100), tb=F.lit(100))
    assert value(spark, fn.woe("g", "b", "tg", "tb"), **args) == pytest.approx(1.0986, abs=1e-3)
    assert value(spark, fn.iv("g", "b", "tg", "tb"), **args) == pytest.approx(0.2197, abs=1e-3)
    args["b"] = F.lit(0)
    assert value(spark, fn.woe("g", "b", "tg", "tb"), **args) == 0


def test_haversine(spark):
    point = dict(a=F.lit(19.0), b=F.lit(-99.0), c=F.lit(20.0), d=F.lit(-99.0))
    assert value(spark, fn.haversine("a", "b", "c", "d"), **point) == pytest.approx(111194.9, abs=1)
    point["c"] = F.lit(None).cast("double")
    assert value(spark, fn.haversine("a", "b", "c", "d"), **point) is None


def test_age_truncates_toward_zero(spark):
    a, b = F.lit("2000-01-01").cast("date"), F.lit("1999-12-22").cast("date")
    assert value(spark, fn.age_years("a", "b"), a=a, b=b) == 0
