"""Bit-packed activity over a date list (A13, A14; F12, G12, J9).

The reference builds the mask by cross joining each key with a date series
and summing powers of two. Here the same number is one fold over the
key's own date array: no series, no join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cumulus.functions.columns import col_

WINDOW = 32
# Masks of the 32-bit activity word, today in the top bit.
WEEK_MASK = 0xFE000000   # '11111110000000000000000000000000'
DAY_MASK = 0x80000000    # '10000000000000000000000000000000'


def _date_arg(v) -> Column:
    """A 'yyyy-mm-dd' literal, a date object, or a column (name)."""
    import datetime as _dt
    if isinstance(v, _dt.date):
        return F.lit(v)
    if isinstance(v, str) and v[:1].isdigit():
        return F.to_date(F.lit(v))
    return col_(v)


def datelist_bits(dates, as_of, window: int = WINDOW, since=None) -> Column:
    """Bit ``window-1-(as_of - d)`` set for each date ``d`` in the array
    with ``0 <= as_of - d < window`` (and ``d >= since`` when given).
    Result is a non-negative long (the top bit is 2^31, outside int)."""
    as_of_c = _date_arg(as_of)
    since_c = None if since is None else _date_arg(since)

    def step(acc, d):
        age = F.datediff(as_of_c, d)
        ok = (age >= 0) & (age < window)
        if since_c is not None:
            ok = ok & (d >= since_c)
        # 2^k for k in 0..window-1 is exact in a double.
        return acc.bitwiseOR(F.when(ok, F.pow(F.lit(2.0), window - 1 - age).cast("long"))
                             .otherwise(F.lit(0).cast("long")))

    return F.aggregate(F.coalesce(col_(dates), F.array().cast("array<date>")),
                       F.lit(0).cast("long"), step)


def bits_string(bits, width: int = WINDOW) -> Column:
    """fixed-width binary text of the mask."""
    return F.lpad(F.bin(col_(bits)), width, "0")


def any_bits(bits, mask: int | None = None) -> Column:
    b = col_(bits)
    if mask is not None:
        b = b.bitwiseAND(F.lit(mask).cast("long"))
    return F.bit_count(b) > 0


def activity_flags(bits) -> list[Column]:
    """Monthly (any bit), weekly (top 7 bits), daily (top bit)."""
    return [any_bits(bits).alias("dim_is_monthly_active"),
            any_bits(bits, WEEK_MASK).alias("dim_is_weekly_active"),
            any_bits(bits, DAY_MASK).alias("dim_is_daily_active")]
