"""Text columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def replace_all(col: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Apply literal replacements in order; each one sees the result of the former."""
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def text_prefix(col: Column) -> Column:
    """Leading part without digits; empty text if there is none, NULL for NULL."""
    return F.regexp_extract(col, r"^\D+", 0)


def region_of(code: Column) -> Column:
    """Region number of a commune code: the code without its last three characters."""
    text = code.cast("string")
    return F.substr(text, F.lit(1), F.length(text) - 3).try_cast("int")


def tier(
    col: Column,
    tiers: Mapping[str, Sequence[str]],
    extra: Mapping[str, Sequence[str]] | None = None,
) -> Column:
    """Name of the first tier that lists the value, NULL if none does."""
    extra = extra or {}
    out = None
    for name, members in tiers.items():
        hit = col.isin(*members, *extra.get(name, ()))
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def label(col: Column, labels: Mapping[int, str]) -> Column:
    """Text for an integer code, NULL for an unknown code."""
    out = None
    for code, text in labels.items():
        out = F.when(col == code, F.lit(text)) if out is None else out.when(col == code, F.lit(text))
    return out


def count_amount_text(count: Column, amount: Column) -> Column:
    """``count | amount`` with the amount in scientific notation."""
    return F.format_string("%d | %.2E", count, amount)
