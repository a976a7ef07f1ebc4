"""Member history carried by a state table: a month is added without reading the months before it.

The state has one row per member with the running maxima so far. It is kept in versions (``sources.versions``), each with the
flags of the months that made it, so a month can be run again and two runs of a month cannot mix.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from membervane.operators.history import period_max
from membervane.session import stage
from membervane.sources.versions import Version, commit, versions


def carry_forward(
    state: DataFrame | None, rows: DataFrame, key: str, period: str, columns: Mapping[str, str]
) -> tuple[DataFrame, DataFrame]:
    """The state after further months, and their rows with running maxima: ``{out: source}``, as ``history.ever_flags`` gives them.

    ``rows`` may hold several months, all later than those in ``state`` (key and one column per output; None: no months yet).
    Months are reduced to one row per member and month before anything is joined.
    """
    monthly = stage(period_max(rows, key, period, columns), "carried-months")
    held = monthly.select(key, *columns)
    if state is not None:
        held = state.select(key, *columns).unionByName(held)
    after = held.groupBy(key).agg(*[F.max(out).alias(out) for out in columns])
    frame = Window.partitionBy(key).orderBy(period).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = monthly.select(
        F.col(key).alias("_key"), F.col(period).alias("_period"), *[F.max(out).over(frame).alias(f"_now_{out}") for out in columns]
    )
    if state is not None:
        before = state.select(F.col(key).alias("_member"), *[F.col(out).alias(f"_before_{out}") for out in columns])
        running = running.join(before, F.col("_key").eqNullSafe(F.col("_member")), "left").select(
            "_key", "_period", *[F.greatest(f"_now_{out}", f"_before_{out}").alias(f"_now_{out}") for out in columns]
        )
    same = rows[key].eqNullSafe(running["_key"]) & rows[period].eqNullSafe(running["_period"])
    flagged = rows.join(running, same, "left")
    return after, flagged.select(*[c for c in rows.columns if c not in columns], *[F.col(f"_now_{out}").alias(out) for out in columns])


def advance(
    spark: SparkSession, folder: str, rows: DataFrame, key: str, period: str, columns: Mapping[str, str]
) -> Version:
    """Add months to the history below ``folder`` and commit a version with the tables ``state`` and ``flags``.

    The months must follow those that are carried already, or be the last of them again: then the version before them is built
    upon, and the new one replaces their flags. Of two runs at once one wins, the other raises ``LostRace``.
    """
    first, last = rows.agg(F.min(period), F.max(period)).first()
    if first is None:
        raise ValueError("no months to add")
    known = versions(spark, folder)
    if known and known[-1].period > last:
        raise ValueError(f"{folder} already carries {known[-1].period}, after {last}")
    if known and known[-1].period >= first:
        again = spark.read.parquet(known[-1].paths["flags"]).agg(F.min(period)).first()[0]
        if (again, known[-1].period) != (first, last):
            raise ValueError(f"{folder} carries {again} to {known[-1].period} as one step; {first} to {last} cuts into it")
    # Versions of months that were run again are passed over: the newest one before these months counts.
    earlier = [v for v in known if v.period < first]
    state = spark.read.parquet(earlier[-1].paths["state"]) if earlier else None
    if state is not None and set(state.columns) != {key, *columns}:
        raise ValueError(f"the state has columns {state.columns}")
    after, flagged = carry_forward(state, rows, key, period, columns)
    return commit(folder, {"state": after, "flags": flagged}, last, known[-1].number if known else 0)
