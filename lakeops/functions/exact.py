"""Exact sums of doubles, whatever the order in which rows and partitions are added.

A double is cut into pieces of LIMB bits at fixed places, each a whole number of its place's unit; a
sum keeps one long per place. Longs add in any order, and what they stand for together is rounded
once, at the end: the same bits under every plan. All of it is arithmetic on primitive values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a piece. Of 2**33 rows a piece's sum still is a long.
LIMB = 30
#: Places: units from 2**-120 on, amounts below 2**60.
PLACES = range(-4, 2)
#: Bits taken at a time when a total is rounded.
_DIGIT = 6


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pieces(x: Column) -> list[Column]:
    """Whole numbers of each place's unit, least place first; remainders and their differences are exact."""
    rest = [x % F.lit(2.0 ** (LIMB * k)) for k in PLACES] + [x]
    return [((rest[i + 1] - rest[i]) / F.lit(2.0 ** (LIMB * k))).cast("long") for i, k in enumerate(PLACES)]


def total(amount: str | Column) -> Column:
    """The sum of a double column, exact and rounded once to the nearest double.

    Nulls do not count; null when nothing counts. NaN and infinite amounts give what they give
    in a plain sum. Finite amounts of 2**60 or more, or with bits below 2**-120, are refused.
    """
    x = _col(amount).cast("double")
    odd = F.isnan(x) | (F.abs(x) == float("inf"))
    beyond = (F.abs(x) >= 2.0**60) | (x % F.lit(2.0 ** (LIMB * PLACES[0])) != 0)
    refused = F.raise_error(F.concat(F.lit("no exact sum of the amount "), x.cast("string"))).cast("double")
    fit = F.when(odd, F.lit(0.0)).when(beyond, refused).otherwise(x)
    sums = [F.sum(p) for p in _pieces(fit)]
    return F.coalesce(F.sum(F.when(odd, x)), _rounded(sums))


def mean(amount: str | Column) -> Column:
    """`total` by the number of amounts that are not null."""
    x = _col(amount)
    return F.try_divide(total(x), F.count(x).cast("double"))


def _rounded(sums: list[Column]) -> Column:
    """The nearest double of sums per place.

    Carries go up until every place but the highest holds LIMB bits. The highest one is then
    followed by the others' bits, a digit at a time, until it has more bits than a double; what is left
    only says whether the total lies above that, which one more odd bit says as well.
    """
    mask, digits, carry = (1 << LIMB) - 1, [], F.lit(0).cast("long")
    for s in sums[:-1]:
        here = s + carry
        low = here.bitwiseAND(F.lit(mask).cast("long"))
        digits = [F.shiftright(low, at).bitwiseAND(F.lit((1 << _DIGIT) - 1).cast("long")) for at in range(LIMB - _DIGIT, -1, -_DIGIT)] + digits
        carry = F.shiftright(here, LIMB)
    top = sums[-1] + carry
    start = F.struct(top.alias("m"), F.lit(float(2.0 ** (LIMB * PLACES[-1]))).alias("unit"), F.lit(False).alias("more"))

    def longer(acc: Column, digit: Column) -> Column:
        open_ = F.abs(acc["m"]) < F.lit(1 << 56)
        return F.struct(
            F.when(open_, acc["m"] * F.lit(1 << _DIGIT).cast("long") + digit).otherwise(acc["m"]).alias("m"),
            F.when(open_, acc["unit"] / F.lit(float(1 << _DIGIT))).otherwise(acc["unit"]).alias("unit"),
            (acc["more"] | (~open_ & (digit != 0))).alias("more"),
        )

    def value(acc: Column) -> Column:
        return F.when(acc["more"], acc["m"].bitwiseOR(F.lit(1).cast("long"))).otherwise(acc["m"]).cast("double") * acc["unit"]

    return F.aggregate(F.array(*digits), start, longer, value)
