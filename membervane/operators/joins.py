"""Equi-joins between facts, side tables and lookups.

None of them forces a strategy: Spark broadcasts a side when its measured size is below the
broadcast threshold, and otherwise sorts and merges, splitting partitions that one hot key
fills (see ``session.tune``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from membervane.functions.text import region_of
from membervane.operators.schema import require_columns
from membervane.session import tune


def join_side(fact: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join a side table of the same grain on all keys."""
    return fact.join(side, on=list(keys), how="left")


def co_located(spark: SparkSession) -> SparkSession:
    """A session beside ``spark``, on the same tables, for tables stored in the same buckets of one key (``sinks.write_bucketed``).

    There a join on that key and others, and a window per key, read the buckets as they lie. Elsewhere Spark wants rows dealt by all keys
    of a join, which spreads a hot member; so the setting is kept to a session of its own, and a hot member's bucket is one task here.
    """
    beside = tune(spark.newSession())
    beside.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    beside.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return beside


def lookup(
    fact: DataFrame, table: DataFrame, fact_key: str, table_key: str, columns: Sequence[str]
) -> DataFrame:
    """Left join a few columns of a lookup table whose key has another name; keeps the key."""
    require_columns(table, [table_key, *columns], "lookup")
    pruned = table.select(table_key, *columns)
    return fact.join(pruned, fact[fact_key] == pruned[table_key], "left")


def communes(
    socio: DataFrame,
    codes: DataFrame,
    socio_name: str = "comuna",
    code_name: str = "con_comuna_gls",
    code: str = "cod_comuna",
    region: str = "cod_region",
) -> DataFrame:
    """Commune data with the commune code, matched by name, and the region number derived from it."""
    pruned = codes.select(code_name, code)
    return socio.join(pruned, socio[socio_name] == pruned[code_name], "inner").withColumn(
        region, region_of(F.col(code))
    )


def with_region(
    commune_rows: DataFrame, regions: DataFrame, region: str = "cod_region"
) -> DataFrame:
    """Left join regions, one row per region number; rows without a number are ignored.

    Where a region number appears more than once, the row that sorts first wins.
    """
    numbered = regions.withColumn(region, F.col(region).cast("int")).filter(F.col(region).isNotNull())
    others = [c for c in numbered.columns if c != region]
    first = numbered.groupBy(region).agg(F.min(F.struct(*others)).alias("_first"))
    single = first.select(region, "_first.*")
    return commune_rows.join(single, on=region, how="left")


def with_geo(
    fact: DataFrame, geo: DataFrame, fact_code: str = "comuna_cod", geo_code: str = "cod_comuna"
) -> DataFrame:
    """Left join commune data by commune code."""
    return fact.join(geo, fact[fact_code] == geo[geo_code], "left")


def attach_values(scored: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Left join the value table on the member; of equal names the scored column wins.

    Expects at most one row per member on both sides: deduplicate first, which is also what
    keeps a member with very many rows out of the join.
    """
    own = {c.lower() for c in scored.columns if c != key}
    return scored.join(values.select(*[c for c in values.columns if c.lower() not in own]), key, "left")


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose member is in the given population; its copies are dropped before they travel."""
    return df.join(members.select(key).distinct(), key, "left_semi")
