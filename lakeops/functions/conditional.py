"""Banding and frequent conditional shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def banded(value: str | Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose upper bound lies above the value; a null value stays null."""
    c = F.col(value) if isinstance(value, str) else value
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for upper, label in bands:
        expr = expr.when(c < F.lit(upper), F.lit(label))
    return expr.otherwise(F.lit(otherwise))


# The amount bands and age bands of the payments model.
AMOUNT_BANDS = [(1000, "LOW"), (3000, "MID")]
AGE_BANDS = [(25, "Gen Z"), (41, "Millennials"), (56, "Gen X")]


def amount_bucket(amount: str | Column) -> Column:
    return banded(amount, AMOUNT_BANDS, "HIGH")


def age_band(age: str | Column) -> Column:
    return banded(age, AGE_BANDS, "Boomers")
