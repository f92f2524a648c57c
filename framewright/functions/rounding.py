"""Rounding to decimals by the exact value of a binary double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Splits a double's 53 bits into two halves whose products are exact.
SPLIT = float((1 << 27) + 1)


def _once(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def round_exact(value: Column, digits: int = 0) -> Column:
    """value to the nearest multiple of 10**-digits, ties to even, judged by the double's exact binary value: 2.675 gives 2.67, as it lies below; 0.125 gives 0.12.

    The error of value * 10**digits is found exactly from the halves of both mantissas. digits: 0 to 22. A value whose product is 2**52 or more has no decimals to lose and stays.
    """
    scale = float(10**digits)
    b_high = SPLIT * scale - (SPLIT * scale - scale)
    b_low = scale - b_high

    def of(x: Column) -> Column:
        product = x * F.lit(scale)
        high = F.lit(SPLIT) * x - (F.lit(SPLIT) * x - x)
        low = x - high
        error = low * b_low - (((product - high * b_high) - low * b_high) - high * b_low)  # product + error is exact
        floor = F.floor(product).cast("double")
        part = product - floor
        up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (F.pmod(floor, F.lit(2.0)) == 1.0))))
        return F.when(product < float(1 << 52), (floor + F.when(up, 1.0).otherwise(0.0)) / F.lit(scale)).otherwise(x)

    signed = _once(F.abs(value.cast("double")), of) * F.when(F.signum(value) < 0, -1.0).otherwise(1.0)
    return F.when(F.isnan(value) | value.isNull(), value.cast("double")).otherwise(signed)
