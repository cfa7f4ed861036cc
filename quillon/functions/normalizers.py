"""Normal forms of field values as Columns; what cannot be read is null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.config import load

_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), 0)


def stripped(value: Column) -> Column:
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def squeezed(value: Column) -> Column:
    return stripped(F.regexp_replace(value, r"(?U)\s+", " "))


def id_upper(value: Column) -> Column:
    return F.upper(F.regexp_replace(value, r"(?U)[\s-]", ""))


def digits_only(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def lower_strip(value: Column) -> Column:
    return F.lower(stripped(value))


def upper_strip(value: Column) -> Column:
    return F.upper(squeezed(value))


def _date(year: Column, month: Column, day: Column) -> Column:
    """A date from strings of digits, null where there is none."""
    text = F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.when(year.rlike("[1-9]"), F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))


def parsed_date(value: Column, dayfirst: bool = True) -> Column:
    """ISO; day and month by slash or dash, two-digit years from 1970 to 2069, the other
    order where this one is impossible; and days with English month names on either side."""
    v = squeezed(F.translate(value, ",", " "))
    # Every form has three parts with one separator between, so they are split once, whichever form it is.
    parts = F.split(v, "[ /-]")
    part = lambda _, i: F.get(parts, i - 1)
    iso, numbers = r"^(\d{4})-(\d{1,2})-(\d{1,2})$", r"^(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})$"
    named, american = r"^(\d{1,2}) ([A-Za-z]{3,9}) (\d{4})$", r"^([A-Za-z]{3,9}) (\d{1,2}) (\d{4})$"
    short = part(numbers, 3)
    year = F.when(F.char_length(short) == 2, F.concat(F.when(short < "70", "20").otherwise("19"), short)).otherwise(short)
    day, month = (1, 2) if dayfirst else (2, 1)
    a, b = F.lpad(part(numbers, day), 2, "0"), F.lpad(part(numbers, month), 2, "0")
    swap = (b > "12") & (a <= "12")
    month_no = lambda name: F.array_position(F.array(*map(F.lit, _MONTHS)), F.lower(F.substring(name, 1, 3))).cast("string")
    return (
        F.when(v.rlike(iso), _date(part(iso, 1), part(iso, 2), part(iso, 3)))
        .when(v.rlike(numbers), _date(year, F.when(swap, a).otherwise(b), F.when(swap, b).otherwise(a)))
        .when(v.rlike(named), _date(part(named, 3), month_no(part(named, 2)), part(named, 1)))
        .when(v.rlike(american), _date(part(american, 3), month_no(part(american, 1)), part(american, 2)))
    )


def date_iso(value: Column, dayfirst: bool = True) -> Column:
    return F.date_format(parsed_date(value, dayfirst), "yyyy-MM-dd")


def decimal_of(value: Column) -> Column:
    """The number that is left when all but digits, points and minus signs go."""
    kept = F.regexp_replace(value, r"[^0-9.\-]", "")
    return F.when(kept.rlike(r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"), kept.try_cast("decimal(38,10)"))


def currency(value: Column) -> Column:
    """Two places, halves to the even neighbour."""
    return F.bround(decimal_of(value), 2).cast("decimal(38,2)").cast("string")


def currency_code(full: Column, start: Column, options: dict | None = None) -> Column:
    """The code of the longest currency symbol shortly before a position, else the default."""
    options = options or load().fields["currency"]
    back = int(options["lookbehind"])
    before = F.lower(F.substr(full, F.greatest(start - back, F.lit(0)) + 1, F.least(start, F.lit(back))))
    code = F.lit(options.get("default"))
    for symbol in sorted(options["symbols"], key=len):
        code = F.when(before.contains(symbol.lower()), options["symbols"][symbol]).otherwise(code)
    return code


NORMALIZERS: dict[str, Callable[[Column], Column]] = {"id_upper": id_upper, "digits_only": digits_only, "lower_strip": lower_strip, "upper_strip": upper_strip, "text_norm": squeezed, "date_iso": date_iso, "currency": currency}


def normalize(name: str | None, value: Column) -> Column:
    """The named normal form; the value itself where the name is none or unknown."""
    form = NORMALIZERS.get(name or "")
    return form(value) if form else value
