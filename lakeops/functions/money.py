"""Order-independent money arithmetic.

Amounts are doubles, and a sum of doubles depends on the order in which partitions
merge. Summing whole minor units as longs gives the same answer for every plan, and
unlike wide decimals it stays on primitive values in generated code. An amount that is no
whole number of units (finer than the scale, NaN or infinite) is an error, not rounded away:
`exact.total` sums such amounts, and a scale of None asks for it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions import exact

#: How far, relative to itself or to one unit, an amount may lie from whole units: what doubles make of decimals.
_SLACK = 1e-9


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minor_units(amount: str | Column, scale: int = 2) -> Column:
    """Whole units of an amount; others than whole ones fail the query."""
    units = _col(amount) * F.lit(float(10**scale))
    whole = F.floor(units + F.lit(0.5)).cast("long")
    # NaN counts as greater than any number here.
    near = (F.abs(units) < F.lit(2.0**62)) & (F.abs(units - whole) <= F.lit(_SLACK) * (F.abs(units) + F.lit(1000.0)))
    refused = F.raise_error(F.concat(F.lit(f"not in whole minor units of scale {scale}: "), _col(amount).cast("string")))
    return F.when(near | units.isNull(), whole).otherwise(refused.cast("long"))


def from_minor(units: str | Column, scale: int = 2) -> Column:
    return _col(units).cast("double") / F.lit(float(10**scale))


def exact_sum(amount: str | Column, scale: int | None = 2) -> Column:
    """The sum in units of the scale, or of any doubles if it is None."""
    if scale is None:
        return exact.total(amount)
    return from_minor(F.sum(minor_units(amount, scale)), scale)


def exact_avg(amount: str | Column, scale: int | None = 2) -> Column:
    """Null amounts do not count; null when nothing counts."""
    if scale is None:
        return exact.mean(amount)
    n = F.count(_col(amount))
    return F.try_divide(
        F.sum(minor_units(amount, scale)).cast("double"), n.cast("double") * F.lit(float(10**scale))
    )


def fee(amount: str | Column, rate: float, digits: int = 2) -> Column:
    return F.round(_col(amount) * F.lit(rate), digits)
