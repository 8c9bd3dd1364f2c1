"""Aggregates in two steps: partial results per small group, put together per larger one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a function needs from the small groups, and how the large ones put it together.
_STEPS = {"count": ["count"], "sum": ["sum"], "min": ["min"], "max": ["max"], "avg": ["sum", "count"]}
_TOGETHER = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _check(aggs: Mapping[str, tuple[str, str]]) -> None:
    unknown = {how for how, _ in aggs.values()} - _STEPS.keys()
    if unknown:
        raise ValueError(f"no partial results for {sorted(unknown)}")


def partials(aggs: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Aggregates per small group, for `{name: (function, column)}`."""
    _check(aggs)
    out = []
    for name, (how, column) in aggs.items():
        of = F.lit(1) if column == "*" else F.col(column)
        out += [getattr(F, step)(of).alias(f"__{name}_{step}") for step in _STEPS[how]]
    return out


def wholes(aggs: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Aggregates of the partial results: the same values as over all rows at once."""
    _check(aggs)
    out = []
    for name, (how, _) in aggs.items():
        parts = {step: _TOGETHER[step](f"__{name}_{step}") for step in _STEPS[how]}
        value = F.try_divide(parts["sum"].cast("double"), parts["count"]) if how == "avg" else parts[how]
        out.append(value.alias(name))
    return out
