"""Exact money and ratio arithmetic.

Money is held as DECIMAL(18,2) inside the engine and published as DOUBLE. Sums of
doubles depend on the order Spark happens to add partial aggregates in, and a
`round(double, 2)` of such a sum can land on either side of a half cent; decimals make
every rounded figure reproducible run to run and against an independent SQL engine.

Ratios that the marts publish rounded (averages, rates, per-day figures) are computed in
integers: for integers N >= 0 and D > 0, `round_half_up(N / D)` equals
`(2*N + D) div (2*D)`. That avoids rounding twice (once at the division's scale, once
at the published scale).
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
PRICE = DecimalType(18, 6)


def parse_price(c: Column) -> Column:
    """Text → exact price; text that is not a number becomes NULL (no ANSI error)."""
    return c.try_cast(PRICE)


def parse_quantity(c: Column) -> Column:
    """Text → int, truncating a fractional quantity ('2.7' → 2) the way a non-ANSI cast
    of the text does; text that is not a number becomes NULL."""
    return c.try_cast("double").try_cast("int")


def line_amount(price: Column, qty: Column) -> Column:
    """price × quantity rounded half-up to cents."""
    return F.round(price * qty, 2).cast(MONEY)


def money_sum(c: Column | str) -> Column:
    return F.sum(c).cast(MONEY)


def cents(c: Column | str) -> Column:
    """DECIMAL(18,2) → exact integer cents."""
    c = F.col(c) if isinstance(c, str) else c
    return (c * F.lit(100)).cast("long")


def int_div(a: Column, b: Column) -> Column:
    """SQL `div`: integer division truncating toward zero."""
    return F.call_function("div", a, b)


def half_up_ratio(num: Column, den: Column, scale: int, num_scale: int = 0) -> Column:
    """round(num / den, scale), half away from zero, as DOUBLE — computed exactly.

    `num` and `den` are integer columns; `num_scale` is the number of decimal places
    `num`'s unit carries relative to `den` (2 when `num` is cents and the ratio is in
    dollars). NULL when either side is NULL or `den` is 0.
    """
    shift = scale - num_scale
    n = F.abs(num).cast("long")
    d = F.nullif(F.abs(den).cast("long"), F.lit(0))  # x div NULL is NULL, never an error
    if shift >= 0:
        n = n * F.lit(10 ** shift)
    else:
        d = d * F.lit(10 ** (-shift))
    units = int_div(n * F.lit(2) + d, d * F.lit(2))
    value = units.cast("double") / F.lit(float(10 ** scale))
    negative = (num < 0) != (den < 0)
    return (F.when(num.isNull() | den.isNull() | (den == 0), F.lit(None).cast("double"))
            .when(negative, -value)
            .otherwise(value))


def money_out(c: Column | str) -> Column:
    """Publish a money column as DOUBLE (the nearest double to the exact decimal)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")
