"""Numeric columns. NULL stays NULL unless a function says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from membervane.fixed_values import DISCOUNT_RATE, HAIRCUT, INCOME_CAP


def capped_ratio(a: Column, b: Column, cap: float = INCOME_CAP) -> Column:
    """``a / b``, at most ``cap``; NULL if either is NULL or ``b`` is zero."""
    ratio = F.try_divide(a, b)
    return F.when(ratio >= cap, F.lit(float(cap))).otherwise(ratio)


def clamp01(col: Column) -> Column:
    """Cut a value to the range 0 to 1."""
    return F.when(col < 0, F.lit(0.0)).when(col > 1, F.lit(1.0)).otherwise(col)


def zero_if_negative(col: Column) -> Column:
    """Replace negative values by zero."""
    return F.when(col < 0, F.lit(0.0)).otherwise(col)


def discount(rate: float, years: int) -> float:
    """Present value of one unit of money ``years`` from now."""
    return 1.0 / (1.0 + rate) ** years


def margin(income: Column, cost: Column) -> Column:
    """Income minus cost."""
    return income - cost


def haircut(col: Column, share: float = HAIRCUT) -> Column:
    """The promised share of an amount."""
    return col * F.lit(share)


def percent_bucket(p: Column) -> Column:
    """Fraction to whole percent, halves to the even neighbour."""
    return F.rint(p * 100).cast("int")


def nearest_bucket(p: Column) -> Column:
    """The whole percent nearest to a fraction, the lower one on a tie."""
    return F.ceil(p * 100 - 0.5).cast("int")


def row_mean(cols: Sequence[Column]) -> Column:
    """Mean of the values that are present in a row; NULL if none is."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols[1:]), F.coalesce(cols[0], F.lit(0.0)))
    present = sum((c.isNotNull().cast("int") for c in cols[1:]), cols[0].isNotNull().cast("int"))
    return F.when(present > 0, total / present)


def annual_current(col_1to6m: Column, col_7to12m: Column) -> Column:
    """Last twelve months from two half-year monthly averages."""
    return col_1to6m * 6 + col_7to12m * 6


def annual_previous(col_13to24m: Column) -> Column:
    """The twelve months before, from their monthly average."""
    return col_13to24m * 12


def _discounted(terms: Sequence[Column], rate: float) -> Column:
    parts = [F.lit(discount(rate, year)) * term for year, term in enumerate(terms, start=1)]
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out


def lifetime_value(
    margins: Sequence[Column], churns: Sequence[Column], rate: float = DISCOUNT_RATE
) -> Column:
    """Discounted margins, each weighted with the chance that the member stays."""
    return _discounted([m * (1 - c) for m, c in zip(margins, churns, strict=True)], rate)


def lifetime_value_no_churn(margins: Sequence[Column], rate: float = DISCOUNT_RATE) -> Column:
    """Discounted margins of a member who never leaves."""
    return _discounted(list(margins), rate)
