"""US-locale number reading and exact arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE

# Number shapes. STRICT wants whole thousands groups; LENIENT is the database reader.
STRICT_NUMBER = r"^[+-]?(?:\d+|\d{1,3}(?:,\d{3})+)(?:\.\d+)?\z"
LENIENT_NUMBER = r"^(?:[+-]?(?:\d[\d,]*(?:\.\d*)?|\.\d+)|(?:\d[\d,]*(?:\.\d*)?|\.\d+)[+-])\z"

PARSED = "decimal(38,18)"
MONEY = "decimal(12,2)"
RATE = "decimal(5,4)"
MEASURE = "decimal(28,6)"


# What PARSED holds: digits before and after the point.
WHOLE, FRACTION = 20, 18


def _read(digits: Column) -> Column:
    """Digits with an optional sign and fraction as a number. What PARSED cannot hold exactly becomes a
    neighbour that no model type holds either: a cut fraction ends in a non-zero last place, a number with
    too many whole digits becomes the largest. So nothing is ever rounded to an acceptable value, and
    signs and bounds stay as they are."""
    short = digits.try_cast(PARSED)
    kept = F.regexp_replace(digits, rf"^([+-]?\d*\.\d{{{FRACTION}}})\d+\z", "$1")
    cut = digits.rlike(rf"\.\d{{{FRACTION}}}\d*[1-9]\d*\z")
    marked = F.when(cut & F.endswith(kept, F.lit("0")), F.regexp_replace(kept, r"0\z", "1")).otherwise(kept)
    most = F.lit("9" * WHOLE + "." + "9" * FRACTION).cast(PARSED)
    large = digits.rlike(rf"^[+-]?0*[1-9]\d{{{WHOLE},}}(\.|\z)")
    long = F.when(large, F.when(F.startswith(digits, F.lit("-")), -most).otherwise(most)).otherwise(marked.try_cast(PARSED))
    return F.when(F.length(digits) <= FRACTION, short).otherwise(long)


def is_exact(text: Column) -> Column:
    """Whether a number's text has no more digits than PARSED holds (a percentage has two more)."""
    return (F.length(text) < FRACTION) | ~(
        text.rlike(rf"\.\d{{{FRACTION - 2}}}\d*[1-9]") | F.replace(text, F.lit(","), F.lit("")).rlike(rf"[1-9]\d{{{WHOLE},}}")
    )


def us_number(text: Column) -> Column:
    """Strict reading: optional sign, digits or proper thousands groups, optional fraction."""
    return F.when(text.rlike(STRICT_NUMBER), _read(F.replace(text, F.lit(","), F.lit(""))))


def us_number_lenient(text: Column) -> Column:
    """Reading of a locale-aware database cast: loose grouping, bare points, one sign at either end."""
    digits = F.replace(F.regexp_replace(text, r"[+-]", ""), F.lit(","), F.lit(""))
    size = _read(F.regexp_replace(digits, r"\.\z", ""))
    return F.when(text.rlike(LENIENT_NUMBER), F.when(F.contains(text, F.lit("-")), -size).otherwise(size))


def currency(text: Column) -> Column:
    """Strict number after at most one leading dollar sign."""
    bare = F.when(F.startswith(text, F.lit("$")), F.ltrim(F.substr(text, F.lit(2)), F.lit(WHITESPACE)))
    return us_number(F.coalesce(bare, text))


def percent(text: Column, number=us_number) -> Column:
    """'20%' and '0.20' are the same rate."""
    body = F.rtrim(F.left(text, F.length(text) - 1), F.lit(WHITESPACE))
    read = number(body)
    scaled = (read * F.lit("0.01").cast("decimal(2,2)")).cast(PARSED)
    # Digits that fall off the end leave a mark, as in ``_read``.
    mark = F.lit("0." + "0" * (FRACTION - 1) + "1").cast("decimal(18,18)")
    cut = (read != read.cast(f"decimal({WHOLE + FRACTION - 2},{FRACTION - 2})")) & (scaled == scaled.cast(f"decimal({WHOLE + FRACTION - 1},{FRACTION - 1})"))
    scaled = F.when(cut, (scaled.try_cast(f"decimal(37,{FRACTION})") + mark).cast(PARSED)).otherwise(scaled)
    return F.when(F.endswith(text, F.lit("%")), scaled).otherwise(number(text))


def whole_count(number: Column) -> Column:
    """A positive whole number as int, else NULL."""
    return F.when((number > 0) & (number == F.floor(number)), number.try_cast("int"))


def fits(number: Column, type_name: str) -> Column:
    """True when casting to ``type_name`` neither overflows nor rounds."""
    return F.coalesce(number == number.try_cast(type_name), F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Exact division, NULL for a NULL or zero denominator."""
    return F.try_divide(numerator, denominator)


def money_ratio(numerator: Column, denominator: Column) -> Column:
    """Division of two amounts with 14 fraction digits. Eighteen digits before the point are enough for
    any sum of money, and the room they free goes to the quotient."""
    return F.try_divide(numerator.cast("decimal(24,6)"), denominator.cast("decimal(24,6)"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0))


def within(left: Column, right: Column, tolerance: str = "0.000001") -> Column:
    """Absolute-tolerance comparison on exact decimals."""
    return F.abs(left - right) <= F.lit(tolerance).cast("decimal(18,6)")
