"""Boolean and 0/1 indicator columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from membervane.fixed_values import (
    CHURN_WINDOW_MONTHS,
    MAX_AGE,
    NO_END_PERIOD,
    SENIORITY_MONTHS,
)


def orphan_flag(end_period: Column, period: Column, sentinel: int = NO_END_PERIOD) -> Column:
    """The plan of the member ended before the period, and the end is a real one."""
    return (end_period < period) & (end_period != sentinel)


def seniority_flag(months: Column, window: int = CHURN_WINDOW_MONTHS) -> Column:
    """Still within the first year at the end of the churn window."""
    return months <= SENIORITY_MONTHS - window


def spend_flag(cols: Sequence[Column], null_as_spend: bool = False) -> Column:
    """1 if any amount differs from zero. A missing amount counts as zero unless told otherwise."""
    filler = F.lit(1.0) if null_as_spend else F.lit(0.0)
    hit = F.lit(False)
    for col in cols:
        hit = hit | (F.coalesce(col.cast("double"), filler) != 0)
    return hit.cast("int")


def within(col: Column, low: float, high: float, include_low: bool = True) -> Column:
    """Between two bounds, the upper one included; a missing value is outside."""
    above = col >= low if include_low else col > low
    return F.coalesce(above & (col <= high), F.lit(False))


def eligible(age: Column, complex_6m: Column, claims_2m: Column, max_age: int = MAX_AGE) -> Column:
    """Young enough, no complex diagnosis, no recent claim; a missing value is not eligible."""
    return F.coalesce((age <= max_age) & (complex_6m == 0) & (claims_2m == 0), F.lit(False))


def all_flags(flags: Sequence[Column]) -> Column:
    """1 where every flag holds, else 0."""
    every = F.lit(True)
    for flag in flags:
        every = every & F.coalesce(flag, F.lit(False))
    return every.cast("int")
