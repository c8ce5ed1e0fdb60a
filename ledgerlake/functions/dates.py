"""Period and date helpers.

``period`` is a ``yyyymm`` string and ``ds`` a ``yyyymmdd`` string throughout;
they are parsed only where month arithmetic needs a date.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_period(x) -> Column:
    """strip non-digits, right-pad with '0' to 6, cut to 6 (rpad does both)."""
    return F.rpad(F.regexp_replace(_c(x), r"[^0-9]", ""), 6, "0")


def period_year(period) -> Column:
    return F.substring(_c(period), 1, 4)


def period_month(period) -> Column:
    return F.substring(_c(period), 5, 2)


def period_quarter(period) -> Column:
    """C9: 'Q1'..'Q4' from the month digits; month 00 (blank period) gives 'Q4'
    like the reference (its month→quarter map falls through to Q4)."""
    m = (period_month(period)).try_cast("int")
    return (F.when(m.between(1, 3), F.lit("Q1"))
            .when(m.between(4, 6), F.lit("Q2"))
            .when(m.between(7, 9), F.lit("Q3"))
            .otherwise(F.lit("Q4")))


def add_months_period(period, n: int) -> Column:
    """yyyymm + n months, as yyyymm; NULL where the period is no month (the blank period 000000)."""
    return F.date_format(F.add_months(F.try_to_date(_c(period), "yyyyMM"), n), "yyyyMM")


def serial_or_text_date(x) -> Column:
    """spreadsheet serial day number (days since 1899-12-30) or a date text;
    anything else becomes NULL."""
    num = (_c(x)).try_cast("double")
    days = F.when(num.between(-693593, 2958465), F.floor(num)).try_cast("int")  # years 1 to 9999
    serial = F.date_add(F.lit("1899-12-30").cast("date"), days)
    text = F.coalesce(F.try_to_date(_c(x), "yyyy-MM-dd"), F.try_to_date(_c(x), "yyyy/MM/dd"))
    return F.when(num.isNotNull(), serial).otherwise(text)


def local_time_text(ts, zone: str = "Asia/Taipei", fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """F8: a UTC instant rendered in a named zone."""
    return F.date_format(F.from_utc_timestamp(_c(ts), zone), fmt)


def safe_number(x, dtype: str = "decimal(38,15)") -> Column:
    """lossy parse — thousands separators removed, blank or junk → NULL."""
    cleaned = F.trim(F.regexp_replace(_c(x), ",", ""))
    return (F.when(cleaned != "", cleaned)).try_cast(dtype)


def plain_cast(x, dtype: str) -> Column:
    """strict cast (raises on bad input under ANSI)."""
    return _c(x).cast(dtype)
