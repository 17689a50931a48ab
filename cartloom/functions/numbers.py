"""Numbers out of raw text. Bad text gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartloom.schemas import AMOUNT, CORRECTED

SMALL = "decimal(18,9)"

_WHOLE = r"^\s*[+-]?\d+\s*$"
_HEX = r"^\s*([+-]?)0[xX]0*([0-9a-fA-F]{1,16})\s*$"


def safe_int(c: Column) -> Column:
    """Whole numbers only, decimal or hexadecimal (``0x1A``); ``2.5`` and numbers beyond 64 bits are NULL."""
    digits = F.conv(F.regexp_extract(c, _HEX, 2), 16, 10).try_cast("decimal(20,0)")
    signed = F.when(F.regexp_extract(c, _HEX, 1) == "-", -digits).otherwise(digits)
    return F.when(c.rlike(_WHOLE), c.try_cast("bigint")).when(c.rlike(_HEX), signed.try_cast("bigint"))


def safe_num(c: Column) -> Column:
    """Amounts at nine decimals, rounded half up."""
    return c.try_cast(AMOUNT)


def magnitude(c: Column) -> Column:
    """Absolute value; the one bigint without a counterpart gives NULL, not an error."""
    return F.when(c < 0, F.try_subtract(F.lit(0).cast("bigint"), c)).otherwise(c)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` of two counts in percent at two decimals, NULL for a zero whole.

    Computed in decimals so that ties round the same way on every engine.
    """
    hundredfold = (part * 100).cast("decimal(22,0)")
    return F.round(F.try_divide(hundredfold, whole.cast("decimal(19,0)")), 2).cast("double")


def ratio_percent(part: Column, whole: Column) -> Column:
    """Ratio of two amounts in percent: quotient at nine decimals, result at two.

    The wider the operands, the fewer decimals Spark leaves a quotient: sums below 10^20 give nine
    and more, larger ones seven.
    """
    def percent_of(amount: Column) -> Column:
        return F.round(F.round(F.try_divide(amount, whole), 9) * 100, 2)

    return F.coalesce(percent_of(part.try_cast("decimal(29,9)")), percent_of(part))


# Decimals have 38 digits at most, and Spark drops decimals of results that might need more. So whole
# and broken parts of amounts are computed apart: no digit is lost, and what does not fit is an error.

def whole_part(c: Column) -> Column:
    return (c - broken_part(c)).cast("decimal(38,0)")


def broken_part(c: Column) -> Column:
    """What follows the point, with the sign of the number."""
    return c % F.lit(1).cast("decimal(1,0)")


def small_expected(quantity: Column, price: Column, discount: Column, stated: Column) -> Column:
    """``quantity * price - discount`` as one exact number, where it and a ``stated`` amount are of everyday size.

    NULL where one of them is not below 10^9 (or missing, but for the stated one): those rows need the parts below, whose
    remainders of wide decimals cost many times as much.
    """
    expected = quantity.try_cast("decimal(10,0)") * price.try_cast(SMALL) - discount.try_cast(SMALL)
    return F.when(stated.isNull() | stated.try_cast(SMALL).isNotNull(), expected)


def small_further_than(stated: Column, expected: Column, tolerance: Column) -> Column:
    """Like :func:`further_than` for a :func:`small_expected` number; NULL where either is."""
    return F.abs(stated.try_cast(SMALL) - expected) > tolerance


def expected_parts(quantity: Column, price: Column, discount: Column) -> dict[str, Column]:
    """``quantity * price - discount`` as a whole number and a rest between -1 and 1 of any sign."""
    units = quantity.cast("decimal(19,0)")
    rest = units * broken_part(price) - broken_part(discount)
    whole = units * whole_part(price).cast("decimal(29,0)") - whole_part(discount)
    return {"_whole": whole + whole_part(rest), "_rest": broken_part(rest)}


def same_sign(whole: Column, rest: Column) -> dict[str, Column]:
    """The parts of a number brought to one sign."""
    one = F.lit(1).cast("decimal(1,0)")
    down, up = (whole > 0) & (rest < 0), (whole < 0) & (rest > 0)
    return {
        "_whole": F.when(down, whole - one).when(up, whole + one).otherwise(whole),
        "_rest": F.when(down, rest + one).when(up, rest - one).otherwise(rest),
    }


def cents(whole: Column, rest: Column) -> Column:
    """Parts of one sign rounded to two decimals, half away from zero."""
    return (whole.cast("decimal(29,0)") + F.round(rest, 2).cast("decimal(4,2)")).cast(CORRECTED)


def further_than(amount: Column, whole: Column, rest: Column, tolerance: Column) -> Column:
    """Whether an amount and a number in parts are further apart than a small tolerance."""
    apart = whole_part(amount) - whole
    small = apart.try_cast("decimal(2,0)")  # null beyond 99: then the rests, below 1 each, do not matter
    exact = F.abs(small + (broken_part(amount) - rest)) > tolerance
    return F.when(apart.isNotNull(), F.coalesce(exact, F.lit(True)))
