"""Lenient parsers and small scalar functions, as Column expressions. Text that can't be read is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_double(c: Column) -> Column:
    """``(1,234.5)`` -> -1234.5; drops ``, $ %``; else null."""
    t = F.trim(c)
    bare = F.trim(F.regexp_replace(t, r"[,$%()]", ""))
    x = F.when(bare.rlike(NUMBER), bare).try_cast("double")
    return F.when(t.startswith("(") & t.rlike(r"^\(.*\)$"), -x).otherwise(x)


def to_double_or_zero(c: Column) -> Column:
    return F.coalesce(to_double(c), F.lit(0.0))


def first_number(c: Column) -> Column:
    """The first numeric token of a cell, negative in brackets; dashes alone are null."""
    token = F.regexp_extract(c, r"\(?\s*\$?\s*([0-9][0-9,]*\.?[0-9]*)\s*\)?", 1)
    x = F.when(token != "", F.regexp_replace(token, ",", "")).try_cast("double")
    return F.when(c.rlike(r"\(\s*\$?\s*[0-9][0-9,.]*\s*%?\s*\)"), -x).otherwise(x)


def number_text(x: Column) -> Column:
    """A number as text: whole numbers without a point, others with up to six places."""
    return F.regexp_replace(F.regexp_replace(F.format_number(x, 6), ",", ""), r"\.?0+$", "")


def parse_date(c: Column) -> Column:
    """``2024-03-31``, ``3/31/2024`` or ``3/31/24`` (69..99 are of the last century); else null."""
    t = F.trim(c)
    short = F.try_to_date(F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), t), "M/d/yy")
    short = F.when(F.year(short) > 2068, F.add_months(short, -1200)).otherwise(short)
    return F.coalesce(
        F.try_to_date(F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), t), "yyyy-M-d"),
        F.try_to_date(F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), t), "M/d/yyyy"),
        short,
    )


def normalize_date(c: Column) -> Column:
    """Any known spelling as ISO text; ``MM/YYYY`` and ``MM-YYYY`` are the first of the month; others unchanged."""
    t = F.trim(c)
    month = F.regexp_extract(t, r"^(\d{1,2})[/-](\d{4})$", 0)
    d = F.coalesce(
        parse_date(t),
        F.try_to_date(F.when(month != "", F.concat(F.regexp_replace(month, "-", "/"), F.lit("/01"))), "M/yyyy/dd"),
        F.try_to_date(F.when(t.rlike(r"^[A-Z][a-z]+ \d{1,2}, \d{4}$"), t), "MMMM d, yyyy"),
    )
    return F.coalesce(F.date_format(d, "yyyy-MM-dd"), t)


def quarter_end_before(d: Column) -> Column:
    """The latest quarter end on or before a date."""
    return F.date_sub(F.trunc(F.date_add(d, 1), "quarter"), 1)


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string"))


def duration_label(days: Column) -> Column:
    return F.when(days <= 100, "Q").when(days <= 195, "H1").when(days <= 290, "9M").when(days.isNotNull(), "FY")


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, null where either is null or b is zero."""
    return F.try_divide(a, b)


def annualized(value: Column, days: Column) -> Column:
    return F.try_divide(value * 365, days)


def quarterly(value: Column, days: Column) -> Column:
    """A fact of 75 to 110 days as it is, others as a quarter of their annual rate."""
    lo, hi = vocab.QUARTER_DAYS
    return F.when(days.between(lo, hi), value).otherwise(annualized(value, days) / 4)


def half_even(x: Column, places: int) -> Column:
    """x to so many decimal places, exact halves to the even neighbour.

    A half is judged on the exact binary value, not on its shortest text: the product with the power
    of ten is taken with its rounding error, by splitting both factors. Values of 2^52 units and more stay.
    """
    unit = float(10**places)
    scaled = x * unit
    c, u = x * 134217729.0, unit * 134217729.0
    xh, uh = c - (c - x), u - (u - unit)
    xl, ul = x - xh, unit - uh
    error = ((xh * uh - scaled) + xh * ul + xl * uh) + xl * ul
    near = F.rint(scaled)
    gap = scaled - near
    near = F.when((gap == 0.5) & (error > 0), near + 1).when((gap == -0.5) & (error < 0), near - 1).otherwise(near)
    return F.when(F.abs(scaled) < 2.0**52, near / unit).otherwise(x)


def percent_text(c: Column) -> Column:
    """``6.0`` or ``6.0%`` as ``6.0%``, a bare number only within 0..30; else null."""
    x = to_double(c)
    ok = c.contains("%") | x.between(0, 30)
    return F.when(ok & x.isNotNull(), F.concat(F.when(x == F.floor(x), F.format_string("%.1f", x)).otherwise(number_text(x)), F.lit("%")))


def fraction_to_percent(x: Column) -> Column:
    """A rate given as a fraction (under 1) or as a percentage (under 100), as a percentage; else null."""
    return F.when(F.abs(x) < 1, x * 100).when(F.abs(x) < 100, x)
