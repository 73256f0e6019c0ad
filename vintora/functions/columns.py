"""Column -> Column functions. Local time is UTC-6, held without a zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
OFFSET_MS = 6 * 3600 * 1000
# Fixed value: what counts as text starting with an ISO date.
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stamp(moment: dt.datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{moment:%Y-%m-%d %H:%M:%S.%f}'")


def day(value: dt.date) -> Column:
    return F.lit(value)


# -- time ------------------------------------------------------------------

def epoch_ms_to_local(ms) -> Column:
    """Epoch milliseconds to local time; NULL, zero, negative and beyond 2100 give NULL."""
    ms = col(ms)
    shifted = F.timestamp_add("MILLISECOND", ms.cast("bigint") - OFFSET_MS, F.expr(_EPOCH))
    return F.when((ms > 0) & (ms < 4102444800000), shifted)


def local_to_epoch_ms(ts) -> Column:
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), col(ts)) + OFFSET_MS


def iso_to_local(text) -> Column:
    """ISO text to local time; text that is no date from 1900 to 2100 gives NULL. Needs a UTC
    session."""
    text = col(text)
    parsed = text.try_cast("timestamp").cast("timestamp_ntz")
    inside = parsed.between(stamp(dt.datetime(1900, 1, 1)), stamp(dt.datetime(2100, 1, 1)))
    return F.when(text.rlike(_ISO_DATE) & inside, parsed - F.expr("INTERVAL 6 HOURS"))


def text_to_date(text) -> Column:
    text = col(text)
    parsed = F.substring(text, 1, 10).try_cast("date")
    inside = parsed.between(F.lit(dt.date(1900, 1, 1)), F.lit(dt.date(2100, 1, 1)))
    return F.when(text.rlike(_ISO_DATE) & inside, parsed)


def to_monday(d) -> Column:
    """Move a Saturday or Sunday to the next Monday."""
    d = col(d)
    return (F.when(F.weekday(d) == 5, F.date_add(d, 2))
            .when(F.weekday(d) == 6, F.date_add(d, 1))
            .otherwise(d))


def last_thursday(d) -> Column:
    """The most recent Thursday, the day itself included."""
    d = col(d)
    return F.date_sub(d, (F.weekday(d) + 4) % 7)


def months_between(start, end) -> Column:
    """Calendar months from start to end, ignoring the day of the month."""
    start, end = col(start), col(end)
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def month_start(d) -> Column:
    return F.trunc(col(d), "month")


def month_text(d) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def month_text_to_date(text) -> Column:
    return F.concat(col(text), F.lit("-01")).try_cast("date")


# -- keys, text, numbers ---------------------------------------------------

def has_text(c) -> Column:
    c = col(c)
    return c.isNotNull() & (F.trim(c) != "")


def clean_text(c) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def int_key(c) -> Column:
    return clean_text(c).try_cast("bigint")


def digits_key(c) -> Column:
    """Digits of a text as a number, everything else dropped."""
    return F.nullif(F.regexp_replace(col(c), r"\D", ""), F.lit("")).try_cast("bigint")


def not_in_or_null(c, values) -> Column:
    c = col(c)
    return c.isNull() | ~c.isin(*values)


def coordinate(text, limit: float) -> Column:
    value = clean_text(text).try_cast("double")
    return F.when(value.between(-limit, limit) & (value != 0), value)


def rounded_long(c) -> Column:
    """Double to bigint by rounding half to even, as the databases do.

    Six places first, so that the noise of a sum does not decide a half.
    """
    return F.rint(F.round(col(c), 6)).cast("bigint")


def cents(c) -> Column:
    """Rounded to cents; six places first, so that the noise of a product decides no half."""
    return F.round(F.round(col(c), 6), 2)


def safe_div(a, b) -> Column:
    return col(a) / F.nullif(col(b), F.lit(0))


def rate(c) -> Column:
    return F.round(col(c), 6)


def age_years(birth, at) -> Column:
    days = F.datediff(col(at), col(birth))
    return F.when(days >= 0, F.floor(days / 365)).otherwise(F.ceil(days / 365)).cast("int")


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Metres between two points; NULL if any coordinate is missing."""
    lat1, lon1, lat2, lon2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    half = (F.pow(F.sin((lat2 - lat1) / 2), 2)
            + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2))
    return F.asin(F.sqrt(half)) * 2 * 6371000


# -- credit rules ----------------------------------------------------------

def delinquency_bucket(days) -> Column:
    days = col(days)
    # Upper day of each bucket.
    bucket = F.when(days < 1, "Ongoing")
    for upto, name in ((6, "DQ 1-6"), (14, "DQ 7-14"), (29, "DQ 15-29"),
                       (59, "DQ 30-59"), (89, "DQ 60-89")):
        bucket = bucket.when(days <= upto, name)
    return bucket.when(days.isNotNull(), "DQ 90+")


def penalty(days, per_week: int) -> Column:
    days = col(days)
    return F.when(days <= 0, F.lit(0)).otherwise(F.floor(days / 7) * per_week)


def recognised(paid_at, amount) -> Column:
    """An amount that only counts once the payment has arrived."""
    return F.when(col(paid_at).isNull(), F.lit(0.0)).otherwise(col(amount))


def loan_range(index) -> Column:
    index = col(index)
    return F.when(index == 1, "1").when(index == 2, "2").otherwise("3+")


def loan_index_label(index) -> Column:
    index = col(index)
    return F.when(index <= 3, index.cast("string")).when(index >= 4, "4+")


def age_band(age) -> Column:
    age = col(age)
    return (F.when(age.isNull(), "Unknown").when(age <= 20, "<=20").when(age <= 30, "21-30")
            .when(age <= 40, "31-40").when(age <= 50, "41-50").when(age <= 60, "51-60")
            .otherwise("60+"))


def woe(good, bad, total_good, total_bad) -> Column:
    good, bad = col(good), col(bad)
    odds = (bad / col(total_bad)) / (good / col(total_good))
    return F.when((good > 0) & (bad > 0), F.ln(odds)).otherwise(F.lit(0.0))


def iv(good, bad, total_good, total_bad) -> Column:
    gap = col(bad) / col(total_bad) - col(good) / col(total_good)
    both = (col(good) > 0) & (col(bad) > 0)
    return F.when(both, gap * woe(good, bad, total_good, total_bad)).otherwise(F.lit(0.0))
