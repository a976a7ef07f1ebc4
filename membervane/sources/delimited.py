"""Delimited files whose types are not known: inferred in one pass over all rows, with the bad rows kept apart.

A first pass reads every field as text and counts, per column, how many values each type could hold. A column takes the narrowest type
that all but a small share of its values fit. The second read casts; a row with a value that does not fit, or with more or fewer fields than
the header, is a bad row: it is in ``bad`` with its reason, not in ``rows``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Types in the order they are tried; text is left for the rest.
TYPES = ("bigint", "double", "date", "timestamp", "boolean")
LINE, REASON = "_line", "_reason"
#: Casts also read a year as a date and cut a time off: these types ask for more.
FORMS = {"date": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "timestamp": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T]|$)"}


@dataclass(frozen=True)
class Inferred:
    """What was read: typed ``rows``, ``bad`` rows as text with ``_reason`` and ``_line``, and the type of each column."""

    rows: DataFrame
    bad: DataFrame
    types: dict[str, str]

    def report(self) -> DataFrame:
        """One row per column: its type, how many good rows have a value, and how many bad rows are so for this column."""
        columns = list(self.types)
        filled = self.rows.agg(*[F.count(c).alias(c) for c in columns])
        reasons = F.split(REASON, ",")
        failed = self.bad.agg(*[F.count_if(F.array_contains(reasons, c)).alias(c) for c in columns])

        def long(df: DataFrame, value: str) -> DataFrame:
            return df.unpivot([], columns, "column", value)

        kinds = self.rows.sparkSession.createDataFrame(list(self.types.items()), "column string, type string")
        return kinds.join(long(filled, "filled"), "column").join(long(failed, "failed"), "column")


def _fits(col: str, kind: str) -> Column:
    fits = F.col(col).try_cast(kind).isNotNull()
    return fits & F.col(col).rlike(FORMS[kind]) if kind in FORMS else fits


def infer_types(texts: DataFrame, columns: Sequence[str], most_bad: float = 0.01, kinds: Sequence[str] = TYPES) -> dict[str, str]:
    """The type of every column of text: one aggregation over all rows. A column without a value is text."""
    counts = []
    for c in columns:
        counts.append(F.count(c).alias(f"{c}\n"))
        counts += [F.count_if(_fits(c, k)).alias(f"{c}\n{k}") for k in kinds]
    found = texts.agg(*counts).first().asDict()
    out = {}
    for c in columns:
        values = found[f"{c}\n"]
        fitting = [k for k in kinds if values and values - found[f"{c}\n{k}"] <= most_bad * values]
        out[c] = fitting[0] if fitting else "string"
    return out


def read_inferred(
    spark: SparkSession,
    path: str,
    separator: str = ",",
    index_column: str | None = None,
    text_columns: Sequence[str] = (),
    most_bad: float = 0.01,
) -> Inferred:
    """Files with a header, plain or gzip, in inferred types.

    ``most_bad`` is the share of a column's values that may be bad before the column counts as text; ``text_columns`` stay text whatever they
    look like (codes with leading zeros). Empty fields are missing values. ``index_column`` names a column of row numbers that is dropped.
    Whole numbers are ``bigint``; nothing is sampled.
    """
    reader = spark.read.option("header", True).option("sep", separator)
    names = reader.csv(path).columns
    schema = ", ".join(f"`{n}` string" for n in [*names, LINE])
    # All columns are parsed whichever are used, or rows with too few fields would pass unseen.
    texts = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).option("columnPruning", False).schema(schema).csv(path)
    columns = [n for n in names if n != index_column]
    whole = texts.where(F.col(LINE).isNull())
    types = infer_types(whole, [c for c in columns if c not in text_columns], most_bad)
    types = {c: types.get(c, "string") for c in columns}
    misfits = [F.when(F.col(c).isNotNull() & ~_fits(c, k), F.lit(c)) for c, k in types.items() if k != "string"]
    # Spark refuses a read that only asks for the line: the first column is always looked at.
    broken = F.col(LINE).isNotNull() | F.coalesce(F.length(columns[0]) < 0, F.lit(False))
    reason = F.when(broken, "fields").otherwise(F.nullif(F.concat_ws(",", *misfits), F.lit("")) if misfits else F.lit(None))
    judged = texts.select(*columns, LINE, reason.alias(REASON))
    rows = judged.where(F.col(REASON).isNull()).select(*[F.col(c).try_cast(k).alias(c) for c, k in types.items()])
    return Inferred(rows, judged.where(F.col(REASON).isNotNull()), types)
