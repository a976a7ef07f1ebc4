"""Preparation: from member-month facts to rows ready for scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membervane import fixed_values as fixed
from membervane.functions.dates import mixed_date_period, period_date, shift_leavers
from membervane.functions.flags import orphan_flag, seniority_flag, spend_flag
from membervane.functions.text import replace_all, tier
from membervane.operators.history import ever_flags
from membervane.operators.joins import communes, join_side, lookup, with_geo, with_region
from membervane.operators.rows import drop_unparsed, nonnegative, with_index
from membervane.operators.schema import (
    drop_existing,
    lower_columns,
    rename_if,
    require_columns,
    resolve_column,
    rtrim_columns,
    try_cast_columns,
    with_constants,
)


@dataclass(frozen=True)
class Lookups:
    """Reference tables of the preparation."""

    category: DataFrame
    regions: DataFrame
    commune_codes: DataFrame
    commune_socio: DataFrame


@dataclass(frozen=True)
class PreparationNames:
    """Column names of the fact table, and the lists that depend on the insurer."""

    member: str = "id_titular"
    period: str = "periodo"
    code: str = "tipo_transac"
    income: str = "renta_imponible"
    seniority: str = "antiguedad"
    complex_flag: str = "cie_complejo"
    spend: Sequence[str] = ("gasto_licencias", "gasto_licencias_excl")
    leaver_codes: Sequence[str] = fixed.LEAVER_CODES
    tiers: Mapping[str, Sequence[str]] = field(default_factory=lambda: fixed.PLAN_TIERS)
    extra_tiers: Mapping[str, Sequence[str]] = field(default_factory=dict)
    replacements: Sequence[tuple[str, str]] = fixed.PREFERRED_REPLACEMENTS


def shape_side(side: DataFrame, member: str = "id_titular", period: str = "periodo") -> DataFrame:
    """Side table: typed keys, end period from mixed date texts, orphan flag, period as a date."""
    side = require_columns(lower_columns(side), [member, period, "fld_termino"], "side table")
    side = drop_existing(side, ["fld_pertermino"])
    side = try_cast_columns(side, {member: "bigint", period: "int", "n_ges_mva_2m": "double"})
    side = side.withColumn("fld_pertermino", mixed_date_period(F.col("fld_termino")))
    side = side.withColumn("huerfano", orphan_flag(F.col("fld_pertermino"), F.col(period)))
    return drop_unparsed(side.withColumn(period, period_date(F.col(period))), "fld_pertermino")


# Spellings of the region table's columns, as they come from its exports.
REGION_COLUMNS = {
    "cod_region": ("COD_REGION", "cod_region"),
    "gls_web_region": ("GLS_WEB_REGION", "gls_web_region"),
    "norte_centro_sur": ("norte_centro_sur", "NORTE_CENTRO_SUR", "Unnamed: 3"),
}


def shape_regions(regions: DataFrame, table: str = "region table") -> DataFrame:
    """The three columns of the region table, found in any of their spellings."""
    found = {out: resolve_column(regions, *names) for out, names in REGION_COLUMNS.items()}
    absent = [out for out, name in found.items() if name is None]
    if absent:
        raise ValueError(f"{table} lacks columns: {', '.join(absent)}")
    return regions.select(*[F.col(f"`{name}`").alias(out) for out, name in found.items()])


def prepare(
    fact: DataFrame,
    side: DataFrame,
    lookups: Lookups,
    announced_increase: int = 0,
    open_exchange: int = 0,
    names: PreparationNames = PreparationNames(),
) -> DataFrame:
    """Join, filter and derive all features; one lazy plan, no index."""
    fact = require_columns(lower_columns(fact), [names.member, names.period], "fact table")
    fact = fact.withColumn(names.period, period_date(F.col(names.period)))
    side = shape_side(side, names.member, names.period)
    own = set(fact.columns) - {names.member, names.period}
    side = side.drop(*[c for c in side.columns if c in own])

    df = join_side(fact, side, [names.period, names.member])
    df = df.withColumn(
        names.period, shift_leavers(F.col(names.period), F.col(names.code), names.leaver_codes)
    )
    df = drop_existing(nonnegative(df, names.income), ["anno", "mes", "fechaingreso"])

    category = lower_columns(lookups.category)
    df = lookup(df, category, "categoria_cod", "cod_categoria", ["preferente"])
    df = df.withColumn("cat_linea_plan", tier(F.col("preferente"), names.tiers, names.extra_tiers))
    df = df.withColumn("preferente", replace_all(F.col("preferente"), names.replacements))

    geo = with_region(
        communes(lower_columns(lookups.commune_socio), lower_columns(lookups.commune_codes)),
        shape_regions(lookups.regions),
    )
    df = with_geo(df, geo)

    df = rename_if(df, "categoria_gls", "categor__a_gls")
    df = drop_existing(df, fixed.DROPPED_AFTER_PREPARATION)
    df = rtrim_columns(df, fixed.TRIMMED_COLUMNS)

    months = fixed.CHURN_WINDOW_MONTHS
    df = with_constants(
        df,
        {f"hay_preges_{months}m": announced_increase, f"hay_ges_{months}m": open_exchange},
        {f"fuga_{months}m": "double"},
    )
    df = df.withColumn("ant_m12_y_ges", seniority_flag(F.col(names.seniority)))
    df = df.withColumn("hay_gasto_licencia", spend_flag([F.col(c) for c in names.spend]))
    return ever_flags(
        df,
        names.member,
        names.period,
        {"hubo_cie_complejo": names.complex_flag, "hubo_licencia": "hay_gasto_licencia"},
    )


def prepared_table(prepared: DataFrame, order: Sequence[str]) -> DataFrame:
    """The prepared rows with a leading row index."""
    return with_index(prepared, order)
