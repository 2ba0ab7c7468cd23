"""Display labels as column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillsight.functions.numeric import dround


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def period_label(year: Column | str, month: Column | str) -> Column:
    """``Mon YYYY`` from year and month, e.g. ``Nov 2011``."""
    return F.date_format(F.make_date(_c(year), _c(month), F.lit(1)), "MMM yyyy")


def year_month(ts: Column | str) -> Column:
    """``yyyy-MM`` month key of a timestamp (a monthly period as text)."""
    return F.date_format(_c(ts), "yyyy-MM")


def weekday_name(ts: Column | str) -> Column:
    """English weekday name, e.g. ``Monday``."""
    return F.date_format(_c(ts), "EEEE")


def short_period(period: Column | str) -> Column:
    """Chart tick label: first three letters of the period, newline, 2-digit year."""
    p = _c(period)
    return F.concat(F.substring(p, 1, 3), F.lit("\n"), F.right(p, F.lit(2)))


def customer_label(customer_id: Column | str, country: Column | str) -> Column:
    """``id\\n(country)``."""
    return F.concat(_c(customer_id).cast("string"), F.lit("\n("), _c(country), F.lit(")"))


def customer_name(customer_id: Column | str) -> Column:
    """``Customer <id>``."""
    return F.concat(F.lit("Customer "), _c(customer_id).cast("long").cast("string"))


def ellipsize(text: Column | str, width: int = 28) -> Column:
    """Cut text longer than ``width`` characters to ``width`` plus an ellipsis."""
    t = _c(text)
    return F.when(F.char_length(t) > width, F.concat(F.substring(t, 1, width), F.lit("…"))) \
        .otherwise(t)


def currency_short(value: Column | str) -> Column:
    """``£1.23M`` from one million, ``£4.6K`` from one thousand, else ``£12``.

    Values are rounded half-up before formatting, so the text does not depend on
    how a formatter treats binary halves."""
    v = _c(value).cast("double")
    return (F.when(v >= 1_000_000, F.format_string("£%.2fM", dround(v / 1_000_000, 2)))
            .when(v >= 1_000, F.format_string("£%.1fK", dround(v / 1_000, 1)))
            .otherwise(F.format_string("£%.0f", dround(v, 0))))


def delta_arrow(delta: Column | str) -> Column:
    """``▲ 1.2% vs prev period`` / ``▼ …`` for a signed percentage change."""
    d = _c(delta).cast("double")
    return F.format_string("%s %.1f%% vs prev period",
                           F.when(d >= 0, F.lit("▲")).otherwise(F.lit("▼")),
                           dround(F.abs(d), 1))
