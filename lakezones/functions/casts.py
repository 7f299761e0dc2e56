"""Casts that turn bad values into null instead of failing the batch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakezones.fixed_values import TIMESTAMP_FORMAT, TIMESTAMP_TEXT


# The shape is tested first because a failing cast is caught as an exception, which for a column
# full of such values costs many times the cast itself.
DIGITS = r"^\s*[+-]?\d+\s*$"
NUMBER = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\s*$"
HAS_DIGIT = r"^\s*[+-]?\.?\d"
# Shifts beyond this leave no 64-bit number but zero.
MOST_SHIFT = 400
MOST_DIGITS = 20


def numeric_key(value: Column) -> Column:
    """Text to a 64-bit key. ``1.0`` and ``1e3`` are whole numbers; ``1.5`` and text are null.

    The digits are moved as text, so that no rounding makes a whole number of a fraction.
    """
    text = value.cast("string")
    return F.when(text.rlike(DIGITS), text.try_cast("bigint")).when(text.rlike(NUMBER) & text.rlike(HAS_DIGIT), _shifted(text))


def _shifted(text: Column) -> Column:
    """The value of a number with a point or an exponent, null if it is not whole."""
    sign, before, after, exponent = (F.regexp_extract(text, NUMBER, i) for i in range(1, 5))
    shift = F.when(exponent == "", F.lit(0)).otherwise(
        F.coalesce(exponent.try_cast("int"), F.when(exponent.startswith("-"), F.lit(-MOST_SHIFT)).otherwise(MOST_SHIFT))
    )
    shift = F.greatest(F.least(shift, F.lit(MOST_SHIFT)), F.lit(-MOST_SHIFT))
    digits = F.concat(before, after)
    significant = F.ltrim(digits, F.lit("0"))
    # The place of the point behind the first digit that counts.
    whole = F.length(before) + shift - (F.length(digits) - F.length(significant))
    padded = F.rpad(significant, F.greatest(whole, F.length(significant), F.lit(1)), F.lit("0"))
    fraction = F.when(whole > 0, F.substr(padded, whole + 1)).otherwise(padded)
    number = F.concat(sign, F.when(whole > 0, F.substr(padded, F.lit(1), whole))).try_cast("bigint")
    return F.when(significant == "", F.lit(0).cast("bigint")).when(
        (whole > 0) & (whole <= MOST_DIGITS) & (F.ltrim(fraction, F.lit("0")) == ""), number
    )


def iso_timestamp(value: Column) -> Column:
    """ISO-8601 text to a UTC timestamp; offsets are honoured, bad text is null."""
    return F.try_to_timestamp(value)


def guarded_timestamp(value: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to a timestamp; every other form, also a bare date, is null."""
    return F.when(value.rlike(TIMESTAMP_TEXT), F.try_to_timestamp(value, F.lit(TIMESTAMP_FORMAT)))
