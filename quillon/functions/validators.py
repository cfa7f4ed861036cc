"""Validators of field values, each a Column of booleans; null and malformed values are false."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.normalizers import bound, decimal_of, parsed_date, stripped

#: The permutation that Verhoeff's scheme applies once more for each place (fixed value).
_TURN = (1, 5, 7, 6, 2, 8, 3, 0, 9, 4)
#: Holder types in a PAN's fourth place, and GST state codes (fixed values).
PAN_HOLDERS = "ABCEFGHJKLPT"
GST_STATES = [f"{i:02d}" for i in range(1, 39)] + ["97", "99"]
_BASE36 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Validators whose pass is recorded as proof (fixed value).
PROOFS = frozenset({"pan", "aadhaar", "gstin", "ifsc", "luhn"})


def _times(a: int, b: int) -> int:
    """Multiplication in the symmetry group of the pentagon: 0-4 rotate, 5-9 reflect."""
    turn = (a + b if a < 5 else a - b) % 5
    return turn + 5 * ((a < 5) != (b < 5))


def _places() -> list[list[int]]:
    rows = [list(range(10))]
    while len(rows) < 8:
        rows.append([rows[-1][i] for i in _TURN])
    return rows


def _verhoeff(digits: Column, first_place: int) -> Column:
    """The checksum state after all digits, from the right, the last one in ``first_place``."""
    product = F.array(*[F.lit(_times(a, b)) for a in range(10) for b in range(10)])
    place = F.array(*[F.lit(x) for row in _places() for x in row])
    backwards = F.reverse(digits)

    def step(state: Column, i: Column) -> Column:
        digit = F.substr(backwards, i, F.lit(1)).cast("int")
        return F.element_at(product, state * 10 + F.element_at(place, ((i - 1 + first_place) % 8) * 10 + digit + 1) + 1)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), step)


def verhoeff(digits: Column) -> Column:
    return F.when(digits.rlike("^[0-9]+$"), _verhoeff(digits, 0) == 0).otherwise(False)


def verhoeff_digit(payload: Column) -> Column:
    """The digit that completes a payload of digits."""
    inverse = F.array(*[F.lit(next(str(b) for b in range(10) if _times(a, b) == 0)) for a in range(10)])
    return F.when(payload.rlike("^[0-9]+$"), F.element_at(inverse, _verhoeff(payload, 1) + 1))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    digits = _digits(value)
    return F.when(F.char_length(digits).between(12, 19), F.call_function("luhn_check", digits)).otherwise(False)


def pan(value: Column, holders: str = PAN_HOLDERS) -> Column:
    return bound(F.upper(stripped(value)), lambda v: _pan(v, holders))


def _pan(v: Column, holders: str = PAN_HOLDERS) -> Column:
    return v.rlike("^[A-Z]{5}[0-9]{4}[A-Z]$") & F.substring(v, 4, 1).isin(list(holders))


def gstin_digit(head: Column) -> Column:
    """The check character of the first 14 of a GSTIN."""
    total = F.lit(0)
    for i in range(1, 15):
        value = F.instr(F.lit(_BASE36), F.substring(head, i, 1)) - 1
        # The digits, to base 36, of the value once or twice: twice it has two from 18 on.
        total += value if i % 2 else 2 * value - F.when(value >= 18, 35).otherwise(0)
    return F.substr(F.lit(_BASE36), (36 - total % 36) % 36 + 1, F.lit(1))


def gstin(value: Column) -> Column:
    shape = "^[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][0-9A-Z]Z[0-9A-Z]$"  # its PAN has nothing to strip
    right = lambda v: F.when(v.rlike(shape) & F.substring(v, 1, 2).isin(GST_STATES) & _pan(F.substring(v, 3, 10)), gstin_digit(F.substring(v, 1, 14)) == F.substring(v, 15, 1)).otherwise(False)
    return bound(F.upper(stripped(value)), right)


def aadhaar(value: Column) -> Column:
    digits = _digits(value)
    return F.when(digits.rlike("^[2-9][0-9]{11}$"), verhoeff(digits)).otherwise(False)


def ifsc(value: Column) -> Column:
    return F.upper(stripped(value)).rlike("^[A-Z]{4}0[A-Z0-9]{6}$")


def email(value: Column) -> Column:
    """One '@' with something before it, no two dots in a row, a domain with a dot but not first."""
    return stripped(value).rlike(r"^[^@]+@[^@.][^@]*\.[^@]*$") & ~value.contains("..")


def phone_in(value: Column) -> Column:
    return _digits(value).rlike("^(91)?[6-9][0-9]{9}$")


def date_sane(value: Column, dayfirst: bool = True, min_year: int = 1990, max_year: int = 2035) -> Column:
    return F.year(parsed_date(value, dayfirst)).between(min_year, max_year)


def amount_sane(value: Column, least: float = 0, most: float = 10**12) -> Column:
    return decimal_of(value).between(F.lit(least).cast("decimal(30,2)"), F.lit(most).cast("decimal(30,2)"))


def invoice_number(value: Column) -> Column:
    v = stripped(value)
    return F.char_length(v).between(3, 30) & v.rlike("[0-9]")


VALIDATORS: dict[str, Callable[..., Column]] = {f.__name__: f for f in (pan, aadhaar, gstin, ifsc, luhn, email, phone_in, date_sane, amount_sane, invoice_number)}


def validate(name: str | None, value: Column, **options) -> Column:
    """The named validator's verdict; an unknown name or null value is false."""
    check = VALIDATORS.get(name or "")
    return F.coalesce(check(value, **options), F.lit(False)) if check else F.lit(False)
