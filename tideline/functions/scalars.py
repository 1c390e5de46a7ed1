"""Column functions.  All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def lenient_int(s: Column) -> Column:
    """Every '+' removed, trimmed; what doesn't parse as a whole number, empty and null give 0."""
    return F.coalesce(F.trim(F.replace(s, F.lit("+"), F.lit(""))).try_cast("bigint"), F.lit(0).cast("bigint"))


def _double(s: Column) -> Column:
    return F.when(s.rlike(NUMBER), s.try_cast("double"))


def lenient_float(s: Column) -> Column:
    """Like :func:`lenient_int` for numbers with decimals: 0.0 where nothing parses."""
    return F.coalesce(_double(F.trim(F.replace(s, F.lit("+"), F.lit("")))), F.lit(0.0))


def nullable_float(s: Column) -> Column:
    """Commas removed, trimmed; what doesn't parse gives null.  Forms that only Java reads, such
    as ``1d``, don't parse."""
    return _double(F.trim(F.replace(s, F.lit(","), F.lit(""))))


def nullable_int(s: Column) -> Column:
    """Commas removed; '-', empty, decimals and what doesn't parse give null."""
    clean = F.trim(F.replace(s, F.lit(","), F.lit("")))
    return F.when(clean.rlike(r"^[+-]?\d+$"), clean.try_cast("bigint"))


def nullable_int_trunc(s: Column) -> Column:
    """Commas and double quotes removed; '', '-' and 'N/A' give null, else the number's whole part."""
    value = _double(F.trim(F.regexp_replace(s, '[,"]', "")))
    return F.when(F.abs(value) < 9.2e18, value.try_cast("bigint"))


def signed_int(s: Column) -> Column:
    """Commas and '+' removed, '-' kept; what doesn't parse gives null."""
    clean = F.trim(F.regexp_replace(s, "[,+]", ""))
    return F.when(clean.rlike(r"^-?\d+$"), clean.try_cast("bigint"))


def yoy_growth(current: Column, prior: Column) -> Column:
    """Change against the size of the prior value; null if either is null or the prior is 0."""
    return F.try_divide(current - prior, F.abs(prior))


def approx_trade_value(close: Column, volume: Column) -> Column:
    """Close times volume in millions, rounded half to even."""
    return F.bround(close.cast("double") * volume.cast("double") / 1e6).cast("bigint")


def parse_date(s: Column) -> Column:
    """``YYYYMMDD``, ``YYYY-MM-DD`` or ``YYYY.MM.DD`` as a date; anything else gives null."""
    clean = F.trim(s)
    digits = F.regexp_replace(clean, r"^(\d{4})([-.])(\d{2})\2(\d{2})$", "$1$3$4")
    return F.when(digits.rlike(r"^\d{8}$"), F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date"))


def quarter_of(day: Column) -> Column:
    return F.quarter(day)


def period_of(year: Column, quarter: Column) -> Column:
    """A fiscal period such as ``2020Q1``."""
    return F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string"))


def quarter_end(period: Column) -> Column:
    year, quarter = F.substring(period, 1, 4).cast("int"), F.substring(period, 6, 1).cast("int")
    return F.last_day(F.make_date(year, quarter * 3, F.lit(1)))


def avail_date(period: Column) -> Column:
    """When a period's figures can be known at the latest: 45 days after its end, 90 after a year's."""
    return F.date_add(quarter_end(period), F.when(F.substring(period, 6, 1) == "4", 90).otherwise(45))


def recent_quarters(today: Column, n: int) -> Column:
    """The current and the n - 1 quarters before, newest first."""
    start = F.trunc(today, "quarter")
    starts = F.sequence(start, F.add_months(start, -3 * (n - 1)), F.expr("interval -3 months"))
    return F.transform(starts, lambda d: period_of(F.year(d), F.quarter(d)))


def period_range(first_year: int, last_year: int) -> Column:
    """All quarters of the years, in order."""
    years = F.sequence(F.lit(first_year), F.lit(last_year))
    return F.flatten(F.transform(years, lambda y: F.transform(F.sequence(F.lit(1), F.lit(4)), lambda q: period_of(y, q))))


#: Parameters of a query string that are secrets, and what a value of one ends before.
SECRETS = ("api_key", "apikey", "token")
VALUE_ENDS = r"&\s\"'"


def mask_dsn(text: Column) -> Column:
    """The password in ``scheme://user:password@`` becomes ``***``.  A user has no colon, and neither user
    nor password a slash, an at sign or white space, so a port before a path isn't taken for one."""
    scheme, user, password = r"[A-Za-z][A-Za-z0-9+.-]*", r"[^:/@\s]+", r"[^/@\s]+"
    return F.regexp_replace(text, f"({scheme}://{user}):{password}@", "$1:***@")


def mask_secrets(text: Column) -> Column:
    """Passwords in URLs, and values of secret parameters, in capitals or not, masked; null gives ''.
    A value ends where a query string's value does, or before white space or a quotation mark, which stay."""
    parameter = rf"(?i)\b({'|'.join(SECRETS)})=[^{VALUE_ENDS}]+"
    return F.regexp_replace(mask_dsn(F.coalesce(text, F.lit(""))), parameter, "$1=***")


def mask_options(args: Column) -> Column:
    """In a list of command-line arguments, the one after ``--db`` or ``--dsn`` masked.
    The list is a variable, too: an expression inside ``transform`` would be worked out again for each element."""
    masked = lambda a: F.transform(a, lambda x, i: F.when(F.get(a, i - 1).isin("--db", "--dsn"), F.lit("***")).otherwise(x))
    return F.get(F.transform(F.array(args), masked), F.lit(0))


def stale_threshold(feed: Column, limits: Mapping[str, int], default: int = 2) -> Column:
    """How many unchanged checks in a row make a feed stale."""
    if not limits:
        return F.lit(default)
    table = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
    return F.coalesce(F.try_element_at(table, feed), F.lit(default))


def is_stale(feed: Column, streak: Column, limits: Mapping[str, int], default: int = 2) -> Column:
    """False for a feed that was never checked."""
    return F.coalesce(streak >= stale_threshold(feed, limits, default), F.lit(False))


def size_mb(size: Column) -> Column:
    """Bytes as megabytes with one decimal, as text."""
    return F.format_number(size / 1e6, 1)


def change_percent(now: Column, was: Column) -> Column:
    """Relative change in per cent with one decimal; null if there was nothing."""
    return F.round(F.try_divide(now.cast("double"), was.cast("double")) * 100 - 100, 1)
