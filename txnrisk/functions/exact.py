"""Column expressions whose results do not depend on how rows are split into tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a double's mantissa in each digit after the binade; 53 in all.
DIGIT_BITS = (9, 22, 22)


def digit_names(bits: Sequence[int] = DIGIT_BITS) -> tuple[str, ...]:
    return tuple(f"order_digit_{i}" for i in range(len(bits)))


DIGITS = digit_names()


def rounded_mean(name: str, digits: int) -> Column:
    """The mean, summed in decimals, so that the order of summation cannot move a tie."""
    return F.round(F.avg(F.col(name).cast("decimal(28,10)")), digits).cast("double")


def order_digits(value: Column, bits: Sequence[int] = DIGIT_BITS) -> list[Column]:
    """Numbers, most significant first, that sort like a double and tell any two of them apart.

    The first takes ``2 ** bits[0]`` values for each of the 2,046 binades, each other one ``2 ** bits[i]``, whatever
    the data. Scaling by powers of two and taking off whole parts are exact.
    """
    cells = 4 << bits[0]
    size, sign = F.abs(value), F.signum(value)
    binade = F.least(F.floor(F.log2(F.greatest(size, F.lit(2.0**-1022)))), F.lit(1023))
    rest = size / F.pow(F.lit(2.0), binade) * float(1 << bits[0])
    whole = F.least(F.floor(rest), F.lit(cells - 1))
    found = [(binade + 1023) * cells + whole]
    for digit_bits in bits[1:]:
        rest = (rest - whole) * float(1 << digit_bits)
        whole = F.floor(rest)
        found.append(whole)
    return [(digit * sign).alias(name) for digit, name in zip(found, digit_names(bits))]
