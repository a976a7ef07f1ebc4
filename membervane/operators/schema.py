"""Column names, column sets and column types."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lower_columns(df: DataFrame) -> DataFrame:
    """All column names in lower case."""
    return df.toDF(*[c.lower() for c in df.columns])


def upper_columns(df: DataFrame) -> DataFrame:
    """All column names in upper case."""
    return df.toDF(*[c.upper() for c in df.columns])


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by a map; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(names))


def rename_if(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename one column if it is there."""
    return df.withColumnRenamed(old, new)


def require_columns(df: DataFrame, columns: Iterable[str], name: str) -> DataFrame:
    """Return ``df`` unchanged, or raise with the list of missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks columns: {', '.join(missing)}")
    return df


def resolve_column(df: DataFrame, *candidates: str) -> str | None:
    """Actual name of the first candidate the frame has, whatever its case."""
    by_lower = {c.lower(): c for c in df.columns}
    return next((by_lower[c.lower()] for c in candidates if c.lower() in by_lower), None)


def drop_existing(df: DataFrame, columns: Iterable[str], strict: bool = False) -> DataFrame:
    """Drop the listed columns; ``strict`` raises if one is absent."""
    columns = list(columns)
    if strict:
        require_columns(df, columns, "frame to drop from")
    return df.drop(*columns)


def drop_like(df: DataFrame, fragments: Iterable[str]) -> DataFrame:
    """Drop every column whose name contains one of the fragments."""
    fragments = list(fragments)
    return df.drop(*[c for c in df.columns if any(f in c for f in fragments)])


def keep_like(df: DataFrame, fragments: Iterable[str]) -> DataFrame:
    """Keep only columns whose name contains one of the fragments."""
    fragments = list(fragments)
    return df.select(*[c for c in df.columns if any(f in c for f in fragments)])


def presence_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per expected column: is it there, and how many of its values are filled."""
    have = set(df.columns)
    filled = df.agg(*[F.count(F.col(c)).alias(c) for c in expected if c in have] or [F.count(F.lit(1))])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(c in have).alias("present"),
            (F.col(c) if c in have else F.lit(0).cast("bigint")).alias("filled"),
        )
        for c in expected
    ]
    return filled.select(F.inline(F.array(*rows)))


def used_columns(lists: Sequence[DataFrame]) -> DataFrame:
    """Set union of one-column frames of names."""
    named = [part.toDF("variable").distinct() for part in lists]
    return reduce(DataFrame.unionByName, named).distinct()


def try_cast_columns(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Cast string columns to the given types, bad text to NULL; other columns stay."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.col(c).try_cast(t) for c, t in targets.items() if types.get(c) == "string"}
    )


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double."""
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("double")
            for f in df.schema.fields
            if isinstance(f.dataType, T.DecimalType)
        }
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns to NULL, so that one kind of missing value remains."""
    return df.withColumns(
        {
            f.name: F.when(~F.isnan(f.name), F.col(f.name))
            for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        }
    )


def coerce_inputs(
    df: DataFrame, numeric: Iterable[str] = (), categorical: Iterable[str] = ()
) -> DataFrame:
    """Model inputs as double or string; text that is no number becomes NULL."""
    changes = {c: F.col(c).try_cast("double") for c in numeric}
    changes.update({c: F.col(c).cast("string") for c in categorical})
    return df.withColumns(changes)


def with_constants(df: DataFrame, values: Mapping[str, object], nulls: Mapping[str, str] = {}) -> DataFrame:
    """Add constant columns, and NULL columns of a given type."""
    changes: dict[str, Column] = {c: F.lit(v) for c, v in values.items()}
    changes.update({c: F.lit(None).cast(t) for c, t in nulls.items()})
    return df.withColumns(changes)


def rtrim_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Remove trailing blanks from the listed columns that exist."""
    return df.withColumns({c: F.rtrim(F.col(c)) for c in columns if c in df.columns})


def zero_negatives(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Set negative values of the listed columns that exist to zero."""
    return df.withColumns(
        {c: F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c)) for c in columns if c in df.columns}
    )
