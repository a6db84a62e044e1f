"""Text keys, cleaning and display formats as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Arrows shown before a change, and the steps of the magnitude format.
ARROW_UP = "⮝"
ARROW_DOWN = "⮟"
MILLION = 1_000_000
THOUSAND = 1_000


def norm_key(c: Column) -> Column:
    """Trimmed upper-case form, the key for case-insensitive grouping and joining."""
    return F.upper(F.trim(c))


def blank_key(c: Column) -> Column:
    """Trimmed text with NULL as the empty string."""
    return F.coalesce(F.trim(c), F.lit(""))


def blank_norm_key(c: Column) -> Column:
    return F.upper(blank_key(c))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def pascal_case(c: Column) -> Column:
    """Each blank-separated word with a capital first letter and the rest in lower case."""
    words = F.filter(F.split(F.trim(c), " "), lambda w: w != "")
    cased = F.transform(
        words,
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))),
    )
    return F.when(F.size(words) > 0, F.array_join(cased, " "))


def or_null_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("NULL"))


def error_text(*parts: Column | str) -> Column:
    """Message from literal pieces and columns; NULL columns read 'NULL'."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else or_null_text(p) for p in parts])


def safe_div(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def fixed(c: Column, places: int) -> Column:
    """Number as text with a fixed number of decimals, halves away from zero."""
    exact = c.cast("decimal(30,8)")
    return F.round(exact, places).cast(f"decimal(30,{places})").cast("string")


def fmt_magnitude(n: Column) -> Column:
    """1234567 -> '1.23M', 1234 -> '1.23K', 12 -> '12.00'."""
    size = F.abs(n)
    return (
        F.when(size >= MILLION, F.concat(fixed(n / MILLION, 2), F.lit("M")))
        .when(size >= THOUSAND, F.concat(fixed(n / THOUSAND, 2), F.lit("K")))
        .when(n.isNotNull(), fixed(n, 2))
    )


def fmt_days(c: Column, places: int = 2) -> Column:
    """'12.30 Days'; a blank value leaves only the unit."""
    return F.concat(F.coalesce(fixed(c, places), F.lit("")), F.lit(" Days"))


def fmt_thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def fmt_percent(c: Column, places: int = 1) -> Column:
    return F.concat(fixed(c * 100, places), F.lit("%"))


def fmt_month_day_year(d: Column) -> Column:
    return F.date_format(d, "MMM dd, yyyy")


def fmt_delta(change: Column, text: Column) -> Column:
    """Arrow by the sign of `change`, then `text` (which shows the size without sign)."""
    return (
        F.when(change > 0, F.concat(F.lit(ARROW_UP + " "), text))
        .when(change < 0, F.concat(F.lit(ARROW_DOWN + " "), text))
        .otherwise(text)
    )
