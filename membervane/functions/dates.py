"""Period and date columns. A period is an int ``YYYYMM``; a period date is its first day."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from membervane.fixed_values import DATE_FORMATS, LEAVER_CODES, MONTH_TAGS


def check_period(period: int | str) -> int:
    """Return a job's period argument as an int, or raise if it is not six digits."""
    text = str(period).strip()
    if not re.fullmatch(r"[0-9]{6}", text):
        raise ValueError(f"period must be YYYYMM, got {period!r}")
    return int(text)


def default_period(today: date) -> int:
    """The period a job scores unless told otherwise: the month before today."""
    last = today.replace(day=1) - timedelta(days=1)
    return last.year * 100 + last.month


def snapshot_name(token: str, period: int) -> str:
    """Name of a period's snapshot, found again by token and by month tag."""
    return f"{token}_{period}_{MONTH_TAGS[period % 100 - 1]}{period // 100 % 100:02d}"


def valid_period(col: Column) -> Column:
    """True where the text is exactly six digits."""
    return F.coalesce(col.cast("string").rlike("^[0-9]{6}$"), F.lit(False))


def period_date(col: Column) -> Column:
    """``YYYYMM`` to the first day of that month; NULL if it is no month."""
    number = col.try_cast("int")
    month = number % 100
    is_month = number.between(100001, 999912) & month.between(1, 12)
    return F.when(is_month, F.make_date(F.floor(number / 100).cast("int"), month, F.lit(1)))


def period_of(day: Column) -> Column:
    """The ``YYYYMM`` int of a date."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def previous_month(day: Column) -> Column:
    """First day of the month before ``day``."""
    return F.trunc(F.add_months(day, -1), "MM")


def next_month(day: Column) -> Column:
    """First day of the month after ``day``."""
    return F.trunc(F.add_months(day, 1), "MM")


def months_back(day: Column, as_of: Column) -> Column:
    """Whole calendar months from ``day`` to ``as_of``, whatever the day of the month."""
    months = (F.year(as_of) - F.year(day)) * 12 + F.month(as_of) - F.month(day)
    return months.cast("int")


def month_number(col: Column, is_date: bool) -> Column:
    """Months since year zero, of a date or of a ``YYYYMM`` int: neighbouring months differ by one."""
    if is_date:
        return (F.year(col) * 12 + F.month(col) - 1).cast("int")
    return (F.floor(col / 100) * 12 + col % 100 - 1).cast("int")


def month_of_number(number: Column, as_date: bool) -> Column:
    """The first day of a numbered month, or its ``YYYYMM`` int."""
    year, month = F.floor(number / 12).cast("int"), (number % 12 + 1).cast("int")
    return F.make_date(year, month, F.lit(1)) if as_date else (year * 100 + month).cast("int")


def period_tag(day: Column) -> Column:
    """Short month tag with a two-digit year, such as ``ene24``."""
    names = F.array(*[F.lit(name) for name in MONTH_TAGS])
    return F.concat(F.element_at(names, F.month(day)), F.date_format(day, "yy"))


_DIGITS = {"yyyy": "[0-9]{4}", "MM": "(0[1-9]|1[0-2])", "dd": "(0[1-9]|[12][0-9]|3[01])"}


def _by_position(pattern: str) -> bool:
    """Whether a format is made of one year, month and day and separators."""
    separators = re.sub("yyyy|MM|dd", "", pattern)
    return not re.search("[A-Za-z]", separators) and all(pattern.count(p) == 1 for p in _DIGITS)


def _iso_text(col: Column, pattern: str) -> Column:
    """The text in ISO order if it has the shape of a format read by position, else NULL."""
    shape = re.sub("yyyy|MM|dd|.", lambda m: _DIGITS.get(m[0], re.escape(m[0])), pattern)
    parts = [F.substring(col, pattern.index(name) + 1, len(name)) for name in ("yyyy", "MM", "dd")]
    return F.when(col.rlike(f"^{shape}$"), F.concat_ws("-", *parts))


def mixed_date(col: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text date in the first format that parses it; NULL if none does.

    Formats read by position are brought into ISO order first, so that a run of them costs one parse, in small
    generated code. Two such formats can only share a text that both read, or that has a day
    no month has in the first and no month in the second.
    """
    found: list[Column] = []
    run: list[Column] = []
    for pattern in [*formats, None]:
        if pattern is not None and _by_position(pattern):
            run.append(_iso_text(col, pattern))
            continue
        if run:
            found.append(F.coalesce(*run).try_cast("date"))
            run = []
        if pattern is not None:
            found.append(F.try_to_date(col, pattern))
    return F.coalesce(*found)


def mixed_date_period(col: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Period of a text date in the first format that parses it; NULL if none does.

    Taken from the date's text, which names the date expression once.
    """
    return F.translate(F.substring(mixed_date(col, formats).cast("string"), 1, 7), "-", "").cast("int")


def shift_leavers(period: Column, code: Column, codes: Sequence[str] = LEAVER_CODES) -> Column:
    """Move the period date of leavers one month back."""
    return F.when(code.isin(*codes), F.add_months(period, -1)).otherwise(period)
