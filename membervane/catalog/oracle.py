"""The same queries as plain SQL for another engine, written from the definitions."""

from __future__ import annotations

import re

from membervane.catalog import standins as st
from membervane.fixed_values import CATEGORICAL_INPUTS, INCOME_CAP, MONTH_TAGS, NUMERIC_INPUTS, SEGMENT_LABELS

AS_OF = f"DATE '{st.AS_OF}'"


def _num(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def _linear(model) -> str:
    intercept, weights = model
    return " + ".join([_num(intercept), *[f"{_num(w)} * {c}" for c, w in weights.items()]])


def _logistic(model) -> str:
    return f"1 / (1 + exp(-({_linear(model)})))"


def _clamped(model) -> str:
    return f"least(greatest({_linear(model)}, 0), 1)"


def _fractions(n: int = 100) -> str:
    return "[" + ", ".join(repr(i / (n - 1)) for i in range(n)) + "]"


def _quantiles(col: str) -> str:
    return f"quantile_cont({col}::DOUBLE, {_fractions()})"


def _rank(v: str, q: str) -> str:
    """Rank of ``v`` on a list of 100 quantiles ``q``."""
    a = f"(len(list_filter({q}, lambda x: x <= {v})) - 1)"
    b = f"(100 - len(list_filter({q}, lambda x: x >= {v})))"
    return (
        f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} <= {q}[1] THEN 0.0 WHEN {v} >= {q}[100] THEN 1.0 "
        f"WHEN {q}[{a} + 1] = {v} THEN ({a} + {b}) / 2.0::DOUBLE / 99 "
        f"ELSE ({a} + ({v} - {q}[{a} + 1]) / ({q}[{b} + 1] - {q}[{a} + 1])) / 99 END::DOUBLE"
    )


def _drift(measure: str) -> str:
    return f"""
  SELECT k.bucket, coalesce(avg(p.{measure}_cur - p.{measure}_prev), 0) AS delta,
         count(p.member_id) AS members
  FROM (SELECT unnest(range(101))::INTEGER AS bucket) k
  LEFT JOIN placed p
    ON round_even(100 * p.perc_{measure}_prev, 0) BETWEEN k.bucket - 2 AND k.bucket + 2
   AND round_even(100 * p.perc_{measure}_cur, 0) BETWEEN k.bucket - 2 AND k.bucket + 2
  GROUP BY k.bucket"""


def _pool(measure: str) -> str:
    return (
        f"SELECT row_number() OVER (ORDER BY {measure}_prev) - 1 AS r, {measure}_prev AS v, "
        f"count(*) OVER () AS n FROM yearly"
    )


def _predicted(measure: str, year: int) -> str:
    return f"""
  SELECT s.member_id, lo.v + (hi.v - lo.v) * (s.pos - floor(s.pos)) + {year} * d.delta AS v
  FROM (SELECT member_id, p_{measure}_{year} AS p,
               p_{measure}_{year} * ((SELECT count(*) FROM yearly) - 1) AS pos FROM scored) s
  JOIN pool_{measure} lo ON lo.r = floor(s.pos)::BIGINT
  JOIN pool_{measure} hi ON hi.r = ceil(s.pos)::BIGINT
  JOIN drift_{measure} d ON d.bucket = ceil(100 * s.p - 0.5)::INTEGER"""


def _band(x: str, q: str) -> str:
    return (
        f"CASE WHEN {x} < {q}[1] OR {x} > {q}[4] THEN NULL WHEN {x} >= {q}[3] THEN 2 "
        f"WHEN {x} >= {q}[2] THEN 1 WHEN {x} >= {q}[1] THEN 0 END"
    )


def _tier(col: str, extra: str = "") -> str:
    out = "CASE"
    for name, members in st.TIERS.items():
        listed = ", ".join(f"'{m}'" for m in members)
        if name == "le":
            listed += extra
        out += f" WHEN {col} IN ({listed}) THEN '{name}'"
    return out + " END"


def _cleaned(col: str) -> str:
    for old, new in st.REPLACEMENTS:
        col = f"replace({col}, '{old}', '{new}')"
    return col


def _tag(col: str) -> str:
    names = ", ".join(f"'{m}'" for m in MONTH_TAGS)
    return f"([{names}])[month({col})] || strftime({col}, '%y')"


def _end_period(col: str) -> str:
    parsed = ", ".join(f"try_strptime({col}, '{f}')" for f in ("%m/%d/%Y", "%d/%m/%Y", "%Y/%m/%d"))
    return f"(year(coalesce({parsed})) * 100 + month(coalesce({parsed})))::INTEGER"


def _segment(features: dict[str, str]) -> str:
    """CASE for the nearest centroid over scaled features."""
    terms = []
    for c in st.MODELS.centroids:
        parts = []
        for (name, col), x in zip(features.items(), c, strict=True):
            mean, std = st.MODELS.scale[name]
            z = f"({col} - {_num(mean)}) / {_num(std)}"
            parts.append(f"({z} - {_num(x)}) * ({z} - {_num(x)})")
        terms.append(" + ".join(parts))
    least = f"least({', '.join(terms)})"
    whens = " ".join(f"WHEN {t} = {least} THEN {i}" for i, t in enumerate(terms, start=1))
    return f"CASE {whens} END::INTEGER"


def _label(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {k} THEN '{v}'" for k, v in SEGMENT_LABELS.items()) + " END"


def _averages_expr(measure: str, lo: int, hi: int) -> str:
    return f"sum(CASE WHEN back BETWEEN {lo} AND {hi} THEN {measure} ELSE 0 END)::DOUBLE / {hi - lo + 1}"


_spans = {"1to6m": (1, 6), "7to12m": (7, 12), "13to24m": (13, 24)}
_measures = ("income", "cost", "margin")
_average_columns = [f"{m}_mva_{s}" for m in _measures for s in _spans]

_categories = ("priority", "status", "segment_name")


def _probability(label: str, condition: str) -> str:
    """Chance that a single boosted tree gives its leaf: the mean of the labels -1 and 1 is half the log-odds."""
    return f"1 / (1 + exp(-2 * (SELECT avg(2 * {label} - 1) FROM trained WHERE {condition})))"


def _tree_outputs() -> str:
    low, dear = "coalesce(priority = '5-LOW', FALSE)", "coalesce(priority IN ('1-URGENT', '2-HIGH'), FALSE)"
    half, quarter = "coalesce(season <= 6, FALSE)", "coalesce(season <= 3, FALSE)"
    out = []

    def mean(label: str, condition: str) -> str:
        return f"(SELECT avg({label}) FROM trained WHERE {condition})"

    for y in (1, 2, 3):
        a, b = f"income_label_{y}", f"cost_label_{y}"
        out.append(f"round(CASE WHEN {half} THEN {mean(a, half)} WHEN {dear} THEN {mean(a, f'NOT {half} AND {dear}')} "
                   f"ELSE {mean(a, f'NOT {half} AND NOT {dear}')} END, 8) AS income_{y}")
        out.append(f"round(CASE WHEN {low} THEN {mean(b, low)} WHEN {quarter} THEN {mean(b, f'NOT {low} AND {quarter}')} "
                   f"ELSE {mean(b, f'NOT {low} AND NOT {quarter}')} END, 8) AS cost_{y}")
        c = f"churn_label_{y}"
        out.append(f"round(CASE WHEN {half} THEN {_probability(c, half)} ELSE {_probability(c, f'NOT {half}')} END, 8) AS churn_{y}")
    out.append(f"round(CASE WHEN {dear} THEN {_probability('campaign_label', dear)} ELSE {_probability('campaign_label', f'NOT {dear}')} END, 8) AS churn_campaign")
    return ", ".join(out)


def _number_distance(name: str, col: str, table: str, old: str) -> str:
    return f"""SELECT * FROM (WITH u AS (SELECT {col}::DOUBLE AS v, {old} AS a FROM {table}), c AS (
  SELECT v, sum(a) OVER (ORDER BY v) / sum(a) OVER () AS fa, sum(b) OVER (ORDER BY v) / sum(b) OVER () AS fb, lead(v) OVER (ORDER BY v) - v AS step
  FROM (SELECT v, sum(a)::DOUBLE AS a, sum(1 - a)::DOUBLE AS b FROM u WHERE v IS NOT NULL GROUP BY v)), g AS (SELECT *, abs(fa - fb) AS gap FROM c)
SELECT '{name}' AS "column", 'number' AS kind, (SELECT count(*) FROM u WHERE v IS NULL AND a = 1) AS missing_a, (SELECT count(*) FROM u WHERE v IS NULL AND a = 0) AS missing_b,
round(sum(gap * step), 6) AS distance, round(max(gap), 6) AS largest_gap, (SELECT v::VARCHAR FROM g ORDER BY round(gap, 12) DESC, v LIMIT 1) AS "at" FROM g)"""


def _category_distance(col: str, table: str, old: str) -> str:
    return f"""SELECT * FROM (WITH u AS (SELECT {col} AS v, {old} AS a FROM {table}), g AS (
  SELECT v, sum(a) AS a, sum(1 - a) AS b, abs(sum(a) / (SELECT sum(a) FROM u)::DOUBLE - sum(1 - a) / (SELECT sum(1 - a) FROM u)::DOUBLE) AS gap FROM u GROUP BY v)
SELECT '{col}' AS "column", 'category' AS kind, coalesce(sum(a) FILTER (v IS NULL), 0)::BIGINT AS missing_a, coalesce(sum(b) FILTER (v IS NULL), 0)::BIGINT AS missing_b,
round(sum(gap) / 2, 6) AS distance, round(max(gap), 6) AS largest_gap, (SELECT v FROM g ORDER BY round(gap, 12) DESC, v NULLS FIRST LIMIT 1) AS "at" FROM g)"""


_level_counts = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS level FROM {{0}}" for c in _categories)

VIEWS: dict[str, str] = {
    "member": """
  SELECT c_custkey AS member_id, c_nationkey AS region_code, c_acctbal AS balance,
         c_mktsegment AS segment_name FROM customer""",
    "order_month": """
  SELECT o_orderkey AS order_id, o_custkey AS member_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period,
         o_orderstatus AS status,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS urgent FROM orders""",
    "panel": """
  SELECT o.member_id, o.month, o.period,
         sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS income,
         sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(l_discount AS DECIMAL(4,2)) + CAST(l_tax AS DECIMAL(4,2)))) AS cost,
         sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - 2 * CAST(l_discount AS DECIMAL(4,2)) - CAST(l_tax AS DECIMAL(4,2)))) AS margin,
         count(DISTINCT o.order_id) AS n_orders, max(o.urgent) AS urgent
  FROM order_month o JOIN lineitem ON l_orderkey = o.order_id GROUP BY 1, 2, 3""",
    "recent": "\n  SELECT member_id, "
    + ", ".join(f"{_averages_expr(m, lo, hi)} AS {m}_mva_{s}" for m in _measures for s, (lo, hi) in _spans.items())
    + f"""
  FROM (SELECT *, datediff('month', month, {AS_OF}) AS back FROM panel)
  WHERE back BETWEEN 1 AND 24 GROUP BY member_id""",
    "averages": "\n  SELECT m.member_id, m.balance / 1000.0::DOUBLE AS balance_k, "
    f"coalesce(datediff('month', l.last_month, {AS_OF}), 99)::DOUBLE AS recency, "
    "(m.segment_name = 'BUILDING')::INTEGER::DOUBLE AS is_building, "
    + ", ".join(f"coalesce(r.{c}, 0)::DOUBLE AS {c}" for c in _average_columns)
    + """
  FROM member m LEFT JOIN recent r USING (member_id)
  LEFT JOIN (SELECT member_id, max(month) AS last_month FROM order_month GROUP BY 1) l USING (member_id)""",
    "yearly": "\n  SELECT *, "
    + ", ".join(
        f"{m}_mva_1to6m * 6 + {m}_mva_7to12m * 6 AS {m}_cur, {m}_mva_13to24m * 12 AS {m}_prev" for m in _measures
    )
    + " FROM averages",
    "yearly_q": "\n  SELECT "
    + ", ".join(f"{_quantiles(f'{m}_{t}')} AS q_{m}_{t}" for m in ("income", "cost") for t in ("prev", "cur"))
    + " FROM yearly",
    "placed": "\n  SELECT y.*, "
    + ", ".join(f"{_rank(f'{m}_{t}', f'q_{m}_{t}')} AS perc_{m}_{t}" for m in ("income", "cost") for t in ("prev", "cur"))
    + " FROM yearly y CROSS JOIN yearly_q",
    "drift_income": _drift("income"),
    "drift_cost": _drift("cost"),
    "pool_income": _pool("income"),
    "pool_cost": _pool("cost"),
    "scored": "\n  SELECT *, "
    + ", ".join(f"{_clamped(m)} AS p_income_{y}" for y, m in enumerate(st.MODELS.income, start=1))
    + ", "
    + ", ".join(f"{_clamped(m)} AS p_cost_{y}" for y, m in enumerate(st.MODELS.cost, start=1))
    + ", "
    + ", ".join(f"{_logistic(m)} AS churn_{y}" for y, m in enumerate(st.MODELS.churn, start=1))
    + f", {_logistic(st.CAMPAIGN_MODEL)} AS churn FROM yearly",
    **{f"pred_{m}_{y}": _predicted(m, y) for m in ("income", "cost") for y in (1, 2, 3)},
    "money": "\n  SELECT s.*, "
    + ", ".join(f"{m}{y}.v AS predicted_{m}_{y}" for m in ("income", "cost") for y in (1, 2, 3))
    + ", "
    + ", ".join(f"income{y}.v - cost{y}.v AS predicted_margin_{y}" for y in (1, 2, 3))
    + "\n  FROM scored s "
    + " ".join(
        f"LEFT JOIN pred_{m}_{y} {m}{y} ON {m}{y}.member_id = s.member_id" for m in ("income", "cost") for y in (1, 2, 3)
    ),
    "ltv": "\n  SELECT *, "
    + " + ".join(f"{_num(1 / 1.1**y)} * (predicted_margin_{y} * (1 - churn_{y}))" for y in (1, 2, 3))
    + " AS ltv_predicted, "
    + " + ".join(f"{_num(1 / 1.1**y)} * predicted_margin_{y}" for y in (1, 2, 3))
    + " AS ltv_no_churn_predicted FROM money",
    "ltv_q": f"\n  SELECT {_quantiles('ltv_predicted')} AS q_ltv, {_quantiles('predicted_margin_1')} AS q_margin FROM ltv",
    "valued": f"""
  SELECT v.*, {_rank('ltv_predicted', 'q_ltv')} AS ltv_predicted_perc,
         {_rank('predicted_margin_1', 'q_margin')} AS predicted_margin_1_perc,
         (predicted_income_3 + predicted_income_2 + predicted_income_1) / 3 AS mean_income,
         (predicted_cost_3 + predicted_cost_2 + predicted_cost_1) / 3 AS mean_cost,
         (churn_3 + churn_2 + churn_1) / 3 AS mean_churn
  FROM ltv v CROSS JOIN ltv_q""",
    "segmented": "\n  SELECT *, "
    + _segment(
        {
            "mean_income": "mean_income",
            "mean_cost": "mean_cost",
            "mean_churn": "mean_churn",
            "ltv_predicted": "ltv_predicted",
            "ltv_no_churn_predicted": "ltv_no_churn_predicted",
        }
    )
    + " AS cluster FROM valued",
    "campaign_inputs": f"""
  SELECT m.member_id, CAST(m.member_id * 7 % 60 + 20 AS INTEGER) AS age, m.segment_name, m.region_code,
         coalesce(r.complex_6m, 0) AS complex_6m, coalesce(r.claims_2m, 0) AS claims_2m
  FROM member m LEFT JOIN (
    SELECT member_id, max(urgent) AS complex_6m,
           count(*) FILTER (WHERE datediff('month', month, {AS_OF}) <= 2) AS claims_2m
    FROM order_month WHERE datediff('month', month, {AS_OF}) BETWEEN 1 AND 6 GROUP BY 1) r USING (member_id)""",
    "campaign": """
  SELECT i.*, s.churn, income_cur - cost_cur AS predicted_margin_1,
         (income_cur - cost_cur) * 2.5 AS ltv_no_churn_predicted
  FROM campaign_inputs i JOIN scored s USING (member_id)""",
    "flagged": """
  SELECT *, value_in_bounds AND is_eligible AND top_churn AS every_flag FROM (
    SELECT *, ltv_no_churn_predicted BETWEEN 0 AND 1e7 AS value_in_bounds,
           predicted_margin_1 > 0 AND predicted_margin_1 <= 1e7 AS strictly_in_bounds,
           age <= 65 AND complex_6m = 0 AND claims_2m = 0 AS is_eligible,
           churn >= (SELECT quantile_cont(churn, 0.8) FROM campaign) AS top_churn FROM campaign)""",
    "campaign_q": """
  SELECT quantile_cont(predicted_margin_1, [0.0, 0.33, 0.66, 1.0]) AS qv,
         quantile_cont(churn, [0.8, 0.9, 0.95, 1.0]) AS qc FROM campaign""",
    "cells": """
  SELECT b.value_band, b.churn_band, count(DISTINCT c.member_id) AS members,
         0.9::DOUBLE * avg(c.predicted_margin_1) AS mean_value,
         coalesce(0.9::DOUBLE * sum(c.predicted_margin_1), 0) AS sum_value
  FROM (SELECT v.i AS value_band, c.i AS churn_band
        FROM (SELECT unnest(range(3)) AS i) v CROSS JOIN (SELECT unnest(range(3)) AS i) c) b
  CROSS JOIN campaign_q q
  LEFT JOIN campaign c
    ON c.predicted_margin_1 BETWEEN q.qv[b.value_band + 1] AND q.qv[b.value_band + 2]
   AND c.churn BETWEEN q.qc[b.churn_band + 1] AND q.qc[b.churn_band + 2]
  GROUP BY 1, 2""",
    "full_campaign": """
  SELECT *, value_in_bounds AND is_eligible AND top_churn AS every_flag FROM (
    SELECT i.*, s.churn, s.predicted_margin_1, s.ltv_no_churn_predicted,
           s.ltv_no_churn_predicted BETWEEN 0 AND 1e7 AS value_in_bounds,
           i.age <= 65 AND i.complex_6m = 0 AND i.claims_2m = 0 AS is_eligible,
           s.churn >= (SELECT quantile_cont(churn, 0.8) FROM ltv) AS top_churn
    FROM campaign_inputs i JOIN ltv s USING (member_id))""",
    "side": """
  SELECT order_id, member_id::VARCHAR AS member_id, period::VARCHAR AS period,
         CASE WHEN order_id % 97 = 0 THEN 'junk' WHEN order_id % 3 = 0 THEN strftime(end_date, '%m/%d/%Y')
              WHEN order_id % 3 = 1 THEN strftime(end_date, '%d/%m/%Y') ELSE strftime(end_date, '%Y/%m/%d') END AS end_text,
         CASE WHEN order_id % 13 = 0 THEN 'x' ELSE (order_id % 4)::VARCHAR END AS claims
  FROM (SELECT *, CASE WHEN order_id % 11 = 0 THEN DATE '1900-01-01'
                  ELSE CAST(month + to_months((order_id % 5 - 2)::INTEGER) + to_days((order_id % 28)::INTEGER) AS DATE) END AS end_date
        FROM order_month QUALIFY row_number() OVER (PARTITION BY member_id, period ORDER BY order_id) = 1)""",
    "located": """
  SELECT m.*, (n_regionkey + 1) * 1000 + n_nationkey AS comuna_cod, n_name AS comuna, n_regionkey + 1 AS cod_region,
         r_name AS gls_web_region,
         CASE WHEN r_regionkey < 2 THEN 'norte' WHEN r_regionkey = 2 THEN 'centro' ELSE 'sur' END AS norte_centro_sur,
         (n_nationkey * 100 + 50)::DOUBLE AS avg_income
  FROM member m JOIN nation ON n_nationkey = m.region_code JOIN region ON r_regionkey = n_regionkey""",
    "listing": f"""
  SELECT event_id, ts AS modified,
         CASE event_id % 3 WHEN 0 THEN 'ltv' WHEN 1 THEN 'ready' ELSE 'score_LTV' END || '_' ||
         {_tag("(CAST(ts AS DATE) + to_months((event_id % 12)::INTEGER))")} || '.gz' AS name FROM events""",
}


VIEWS |= {
    "contracts": f"""
  SELECT *, (order_id % 10 < CASE WHEN coalesce(priority IN ('1-URGENT', '2-HIGH'), FALSE) THEN 7 ELSE 2 END)::INTEGER AS campaign_label,
         {", ".join(f"(income + order_id % 7 + {y}) / 100.0::DOUBLE AS income_label_{y}, (cost + order_id % 5 + {y}) / 100.0::DOUBLE AS cost_label_{y}, (order_id % 10 < leaving + {y})::INTEGER AS churn_label_{y}" for y in (1, 2, 3))}
  FROM (SELECT *, CASE WHEN season <= 6 THEN 20 WHEN priority IN ('1-URGENT', '2-HIGH') THEN 50 ELSE 80 END AS income,
               CASE WHEN priority = '5-LOW' THEN 90 WHEN season <= 3 THEN 10 ELSE 40 END AS cost, CASE WHEN season <= 6 THEN 2 ELSE 6 END AS leaving
        FROM (SELECT order_id, period, status, segment_name, CASE WHEN order_id % 13 <> 0 THEN month(month) END AS season,
                     CASE WHEN order_id % 17 <> 0 THEN o_orderpriority END AS priority
              FROM order_month JOIN orders ON o_orderkey = order_id JOIN (SELECT member_id, segment_name FROM member) USING (member_id)
              WHERE period >= {st.TRAINED_TO} OR (o_orderpriority <> '3-MEDIUM' AND segment_name <> 'MACHINERY')))""",
    "trained": f"SELECT * FROM contracts WHERE period < {st.TRAINED_TO}",
    "compared": f"SELECT *, CASE WHEN order_id % 11 <> 0 THEN cost_label_1 END AS cost_known, (period < {st.TRAINED_TO})::INTEGER AS old FROM contracts",
    "later": f"SELECT * FROM contracts WHERE period >= {st.TRAINED_TO}",
    "trained_levels": f"""
  SELECT column_name, level, (row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, level) - 1)::INTEGER AS position, count(*) AS held
  FROM ({_level_counts.format("trained")}) WHERE level IS NOT NULL GROUP BY column_name, level""",
    "later_levels": f"SELECT column_name, level, count(*) AS held FROM ({_level_counts.format('later')}) GROUP BY column_name, level",
}


def _with(body: str) -> str:
    """Prefix a query with the views it uses, directly or through other views."""
    used: set[str] = set()

    def visit(sql: str) -> None:
        for name in set(re.findall(r"[a-z_0-9]+", sql)) & VIEWS.keys():
            if name not in used:
                used.add(name)
                visit(VIEWS[name])

    visit(body)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in used)
    return f"WITH {ctes}\n{body}" if ctes else body


def _rounded(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


_distance = """
WITH u AS ({union}), c AS (
  SELECT v, sum(a) OVER (ORDER BY v) / sum(a) OVER () AS fa, sum(b) OVER (ORDER BY v) / sum(b) OVER () AS fb,
         lead(v) OVER (ORDER BY v) - v AS step
  FROM (SELECT v, sum(a)::DOUBLE AS a, sum(1 - a)::DOUBLE AS b FROM u GROUP BY v))
SELECT {out} FROM (SELECT sum(abs(fa - fb) * step) AS d FROM c)"""

_score = "1 / (1 + exp(-(-1.0::DOUBLE + -0.2::DOUBLE * ({col} / 1000.0::DOUBLE))))"

_value_columns = [
    *[f"predicted_{m}_{y}" for m in ("income", "cost", "margin") for y in (1, 2, 3)],
    "ltv_predicted", "ltv_no_churn_predicted", "ltv_predicted_perc", "predicted_margin_1_perc",
]

_segment_features = {
    "mean_income": "income_cur",
    "mean_cost": "cost_cur",
    "mean_churn": "churn",
    "ltv_predicted": "((income_cur - cost_cur) * 2)",
    "ltv_no_churn_predicted": "((income_cur - cost_cur) * 2.5)",
}

BODIES: dict[str, str] = {
    "scan_table": "SELECT * FROM customer",
    "scan_period": "SELECT order_id, member_id, period AS periodo, status FROM order_month WHERE period = 199803",
    "scan_period_range": "SELECT period, count(*) AS n FROM order_month WHERE period BETWEEN 199803 AND 199805 GROUP BY 1",
    "csv_roundtrip": "SELECT * FROM customer",
    "table_roundtrip": """SELECT order_id, member_id, CASE WHEN period = 199803 THEN lower(status) ELSE status END AS status, period
FROM order_month""",
    "publish_tables": f"""SELECT 'members' AS table_name, {st.AS_OF_PERIOD} AS period, (SELECT count(*) FROM customer) AS row_count
UNION ALL SELECT 'orders', {st.AS_OF_PERIOD}, (SELECT count(*) FROM orders)
UNION ALL SELECT 'categories', {st.AS_OF_PERIOD}, (SELECT count(*) FROM part)""",
    "latest_snapshot": """SELECT event_id, name, contains(name, 'mar24') AS in_period FROM listing
WHERE contains(lower(name), 'ltv') AND NOT contains(lower(name), 'score')
ORDER BY in_period DESC, modified DESC, name LIMIT 1""",
    "latest_snapshot_fallback": """SELECT event_id, name, false AS in_period FROM listing
WHERE contains(name, 'ready') ORDER BY modified DESC, name LIMIT 1""",
    "used_columns": """SELECT event_type AS variable FROM events UNION SELECT c_mktsegment FROM customer
UNION SELECT p_type FROM part""",
    "upper_lower_columns": "SELECT * FROM customer",
    "rename_map": """SELECT c_custkey AS member_id, c_name AS full_name, c_nationkey, c_acctbal AS balance, c_mktsegment
FROM customer""",
    "schema_shape": f"SELECT member_id, {_rounded(['recency', 'income_mva_1to6m'])} FROM averages",
    "presence_report": """SELECT * FROM (SELECT 'member_id' AS "column", true AS present, count(member_id) AS filled FROM order_month
UNION ALL SELECT 'period', true, count(period) FROM order_month
UNION ALL SELECT 'leaver', true, count(*) FILTER (WHERE status = 'F') FROM order_month
UNION ALL SELECT 'status', true, count(status) FROM order_month
UNION ALL SELECT 'absent', false, 0)""",
    "try_cast_columns": """SELECT order_id, try_cast(member_id AS BIGINT) AS member_id, try_cast(period AS INTEGER) AS period,
try_cast(claims AS DOUBLE) AS claims FROM side""",
    "decimals_to_double": """SELECT member_id, period, round(income::DOUBLE, 6) AS income, round(cost::DOUBLE, 6) AS cost,
round(margin::DOUBLE, 6) AS margin FROM panel""",
    "coerce_inputs": "SELECT order_id, try_cast(claims AS DOUBLE) AS claims, period FROM side",
    "constants": """SELECT *, 0 AS announced_5m, 0 AS exchange_5m, NULL::DOUBLE AS churned_5m FROM member""",
    "row_index": 'SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS "index", o_orderkey, o_custkey FROM orders',
    "row_index_ties": """SELECT o_orderstatus, min(i) AS first_index, max(i) AS last_index, count(DISTINCT i) AS n
FROM (SELECT o_orderstatus, row_number() OVER (ORDER BY o_orderstatus) - 1 AS i FROM orders) GROUP BY 1""",
    "orphan_flag": f"""SELECT order_id, end_period < period::INTEGER AND end_period <> 190001 AS orphan
FROM (SELECT *, {_end_period('end_text')} AS end_period FROM side) WHERE end_period IS NOT NULL""",
    "filter_nonnegative": "SELECT * FROM member WHERE balance >= 0",
    "shift_period": """SELECT order_id, month::VARCHAR AS month,
(CASE WHEN status = 'F' THEN CAST(month - INTERVAL 1 MONTH AS DATE) ELSE month END)::VARCHAR AS shifted,
status IN ('F', 'P') AS listed FROM order_month""",
    "seniority_flag": f"""SELECT order_id, datediff('month', month, {AS_OF})::INTEGER AS months,
datediff('month', month, {AS_OF}) <= 7 AS is_new FROM order_month""",
    "spend_flag": """SELECT l_returnflag, l_linestatus, count(*) AS n,
count(*) FILTER (WHERE l_discount <> 0 OR l_tax <> 0) AS with_spend,
count(*) FILTER (WHERE l_discount = 0 OR l_discount <> 0 OR l_tax <> 0) AS with_spend_or_missing
FROM lineitem GROUP BY 1, 2""",
    "valid_period": """SELECT order_id, text, regexp_full_match(text, '[0-9]{6}') AS is_valid FROM (
SELECT order_id, CASE WHEN order_id % 10 = 0 THEN substr(period::VARCHAR, 3, 4)
  WHEN order_id % 10 = 1 THEN period::VARCHAR || 'a' ELSE period::VARCHAR END AS text FROM order_month)""",
    "top_quantile": "SELECT member_id, balance FROM member WHERE balance >= (SELECT quantile_cont(balance, 0.8) FROM member)",
    "eligibility": """SELECT member_id, value_in_bounds, strictly_in_bounds, is_eligible, top_churn,
every_flag::INTEGER AS meets_filters FROM flagged""",
    "flag_counts": """SELECT count(*) AS rows, 13 AS columns, count(*) FILTER (WHERE value_in_bounds) AS value_in_bounds,
count(*) FILTER (WHERE is_eligible) AS is_eligible, count(*) FILTER (WHERE top_churn) AS top_churn,
count(*) FILTER (WHERE every_flag) AS meets_filters FROM flagged""",
    "join_two_key": """SELECT p.member_id, p.period, p.n_orders, s.claims, s.end_text FROM panel p LEFT JOIN (
  SELECT member_id::BIGINT AS member_id, period::INTEGER + (order_id % 7 = 0)::INTEGER AS period,
         try_cast(claims AS DOUBLE) AS claims, end_text FROM side
  QUALIFY row_number() OVER (PARTITION BY member_id, period::INTEGER + (order_id % 7 = 0)::INTEGER ORDER BY order_id) = 1) s
ON p.member_id = s.member_id AND p.period = s.period""",
    "join_category": """SELECT p_brand AS preferente, count(*) AS n, count(p_partkey) AS matched
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "geo_chain": """SELECT member_id, comuna_cod, comuna, cod_region, gls_web_region, norte_centro_sur, avg_income FROM located""",
    "join_scores": """SELECT o.member_id, o.order_id, round((o.order_id % 100) / 100.0::DOUBLE, 2) AS score, m.balance
FROM (SELECT * FROM order_month QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY order_id) = 1) o
LEFT JOIN member m ON m.member_id = o.member_id AND m.balance >= 0""",
    "semi_members": """SELECT order_id, member_id, period FROM order_month
WHERE member_id IN (SELECT member_id FROM member WHERE balance > 5000)""",
    "distinct_members": "SELECT count(DISTINCT member_id) AS members FROM order_month",
    "uniqueness_check": """SELECT count(*) AS rows, count(DISTINCT member_id) AS members,
count(*) = count(DISTINCT member_id) AS is_unique, 'before' AS step FROM order_month
UNION ALL SELECT count(DISTINCT member_id), count(DISTINCT member_id), true, 'after' FROM order_month""",
    "score_stats": """SELECT round(avg(churn), 6) AS mean, round(min(churn), 6) AS min, round(max(churn), 6) AS max,
round(stddev_samp(churn), 6) AS std FROM scored""",
    "profile": "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c})::DOUBLE, 4) AS mean,
round(stddev_samp({c}), 4) AS std, round(min({c})::DOUBLE, 4) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25,
round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75,
round(max({c})::DOUBLE, 4) AS max FROM customer"""
        for c in ("c_custkey", "c_nationkey", "c_acctbal")
    ),
    "null_report": """SELECT * FROM (SELECT 'discount' AS "column", count(*) FILTER (WHERE l_discount = 0) AS nulls FROM lineitem
UNION ALL SELECT 'flag', count(*) FILTER (WHERE l_returnflag = 'R') FROM lineitem) WHERE nulls > 0""",
    "distinct_values": "SELECT DISTINCT event_type FROM events",
    "simplify_category": r"""SELECT count(DISTINCT raw) AS before, count(DISTINCT regexp_extract(raw, '^\D+')) AS after
FROM (SELECT CASE WHEN p_partkey % 7 = 0 THEN p_size::VARCHAR || p_type ELSE p_brand END AS raw FROM part)""",
    "text_prefix": r"""SELECT p_partkey, CASE WHEN raw IS NULL THEN NULL ELSE regexp_extract(raw, '^\D+') END AS prefix
FROM (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN p_size::VARCHAR WHEN 1 THEN '' WHEN 2 THEN NULL
ELSE p_brand END AS raw FROM part)""",
    "quantile_cuts": """SELECT 'balance' AS "column", f AS fraction, round(v, 6) AS value FROM (
SELECT unnest([0.0, 0.33, 0.66, 1.0, 0.8, 0.9, 0.95, 1.0])::DOUBLE AS f,
unnest(quantile_cont(balance, [0.0, 0.33, 0.66, 1.0, 0.8, 0.9, 0.95, 1.0])) AS v FROM member)""",
    "row_mean": """SELECT member_id, round((a + b + c) / nullif((a <> 0)::INTEGER + (b <> 0)::INTEGER + (c <> 0)::INTEGER, 0), 8) AS mean_income
FROM (SELECT member_id, income_mva_1to6m AS a, income_mva_7to12m AS b, income_mva_13to24m AS c FROM averages)""",
    "validate": """SELECT *, violations = 0 AS success FROM (
SELECT 'not_null' AS expectation, 'o_custkey' AS "column", count(*) FILTER (WHERE o_custkey IS NULL) AS violations FROM orders
UNION ALL SELECT 'not_null', 'note', count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders
UNION ALL SELECT 'range', 'o_totalprice', count(*) FILTER (WHERE NOT o_totalprice BETWEEN 1000 AND 400000) FROM orders
UNION ALL SELECT 'in_set', 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
UNION ALL SELECT 'type', 'o_custkey', 0
UNION ALL SELECT 'type', 'o_totalprice', 1
UNION ALL SELECT 'unique', 'o_orderkey', count(o_orderkey) - count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'unique', 'o_custkey', count(o_custkey) - count(DISTINCT o_custkey) FROM orders)""",
    "validate_failures": """SELECT *, false AS success FROM (
SELECT 'range' AS expectation, 'c_acctbal' AS "column", count(*) FILTER (WHERE c_acctbal > 9000) AS violations FROM customer
UNION ALL SELECT 'in_set', 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) FROM customer)
WHERE violations > 0""",
    "history_flags": """SELECT order_id, member_id, month::VARCHAR AS month,
max(urgent) OVER w AS had_urgent, max((status = 'O')::INTEGER) OVER w AS had_late
FROM (SELECT * REPLACE (CASE WHEN status = 'F' THEN CAST(month - INTERVAL 1 MONTH AS DATE) ELSE month END AS month) FROM order_month)
WINDOW w AS (PARTITION BY member_id ORDER BY month RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "history_12": """SELECT order_id, month::VARCHAR AS month, max(urgent) OVER (PARTITION BY member_id ORDER BY m
RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS had_urgent
FROM (SELECT *, dense_rank() OVER (ORDER BY month) AS m FROM order_month)""",
    "history_100": """SELECT order_id, month::VARCHAR AS month, max(urgent) OVER (PARTITION BY member_id ORDER BY m
RANGE BETWEEN 99 PRECEDING AND CURRENT ROW) AS had_urgent
FROM (SELECT *, dense_rank() OVER (ORDER BY month) AS m FROM order_month)""",
    "republish_empty": "SELECT order_id, member_id, status, period FROM order_month WHERE period = 199803",
    "snapshot_roundtrip": "SELECT order_id, member_id, status, period FROM order_month WHERE period = 199803",
    "replace_table_roundtrip": """SELECT o_orderkey AS "O_ORDERKEY", lower(o_orderstatus) AS "STATUS" FROM orders""",
    "validate_result": """SELECT *, violations = 0 AS success FROM (
SELECT 'range' AS expectation, 'o_totalprice' AS "column", count(*) FILTER (WHERE NOT o_totalprice BETWEEN 1000 AND 400000) AS violations FROM orders
UNION ALL SELECT 'unique', 'o_custkey', count(o_custkey) - count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'not_null', 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders)""",
    "validate_suite": """SELECT 'range' AS expectation, 'c_nationkey' AS "column", count(*) FILTER (WHERE c_nationkey <= 0 OR c_nationkey >= 24) AS violations,
count(*) FILTER (WHERE c_nationkey <= 0 OR c_nationkey >= 24) = 0 AS success FROM customer
UNION ALL SELECT 'range', 'c_acctbal', count(*) FILTER (WHERE c_acctbal < 0), avg((c_acctbal >= 0)::INTEGER) >= 0.5 FROM customer
UNION ALL SELECT 'range', 'c_acctbal', count(*) FILTER (WHERE c_acctbal < 5000), avg((c_acctbal >= 5000)::INTEGER) >= 0.9 FROM customer
UNION ALL SELECT 'unique', 'c_custkey', count(*) - count(DISTINCT c_custkey), count(*) = count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'not_null', 'c_phone', NULL, false""",
    "quantile_cuts_lines": """SELECT f AS fraction, round(v, 6) AS value FROM (
SELECT unnest(list_transform(range(21), lambda i: i / 20.0::DOUBLE)) AS f,
unnest(quantile_cont(l_extendedprice, [0.0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0])) AS v FROM lineitem)""",
    "wasserstein_lines": _distance.format(
        union="SELECT l_extendedprice AS v, 1 AS a FROM lineitem WHERE l_returnflag = 'R' "
        "UNION ALL SELECT l_extendedprice, 0 FROM lineitem WHERE l_returnflag <> 'R'",
        out="round(d, 6) AS distance",
    ),
    "segment_kmeans": f"""SELECT member_id, cluster, {_label('cluster')} AS category
FROM (SELECT member_id, {_segment(_segment_features)} AS cluster FROM scored)""",
    "segment_fitted": "SELECT member_id, TRUE AS is_nearest, 5 AS n_centres FROM scored",
    "period_max": "SELECT member_id, period, max(urgent) AS urgent FROM order_month GROUP BY 1, 2",
    "rolling_max": """SELECT member_id, period, CASE WHEN count(x) OVER w >= 3 THEN max(x) OVER w END AS n_max FROM (
SELECT member_id, period, lag(n_orders) OVER (PARTITION BY member_id ORDER BY period) AS x FROM panel)
WINDOW w AS (PARTITION BY member_id ORDER BY period ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
    "window_averages": f"SELECT member_id, {_rounded(_average_columns)} FROM recent",
    "dedup_first": """SELECT member_id, order_id, status FROM order_month
QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY order_id) = 1""",
    "dedup_last": """SELECT member_id, period, order_id, urgent FROM order_month
QUALIFY row_number() OVER (PARTITION BY member_id, period ORDER BY urgent DESC, order_id DESC) = 1""",
    "latest_row": """SELECT member_id, period, order_id, urgent FROM order_month WHERE period = 200105
QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY urgent DESC, order_id DESC) = 1""",
    "top_members": "SELECT * FROM member ORDER BY member_id LIMIT 5",
    "append_history": """SELECT order_id, member_id, period, CASE WHEN period >= 200101 THEN urgent END AS urgent FROM order_month""",
    "period_dates": """SELECT order_id, month::VARCHAR AS start, CAST(month - INTERVAL 1 MONTH AS DATE)::VARCHAR AS previous,
CAST(month + INTERVAL 1 MONTH AS DATE)::VARCHAR AS next FROM order_month""",
    "period_tag": f"""SELECT order_id, {_tag('month')} AS tag, {_tag("(month - INTERVAL 1 MONTH)")} AS previous_tag FROM order_month""",
    "parse_mixed_dates": f"SELECT order_id, end_text, {_end_period('end_text')} AS end_period FROM side",
    "clean_text": f"SELECT p_partkey, p_type, {_cleaned('p_brand')} AS cleaned FROM part",
    "plan_tier": f"""SELECT p_partkey AS cod_categoria, {_tier('p_brand', ", 'Brand#17'")} AS tier FROM part""",
    "campaign_input_report": f"""SELECT * FROM (WITH names AS (SELECT unnest({[*CATEGORICAL_INPUTS, *NUMERIC_INPUTS]!r}) AS "column"), m AS (
SELECT count(DISTINCT member_id) AS n FROM order_month WHERE period = 199803), filled AS (
SELECT count(*) FILTER (WHERE order_id % 5 <> 0) AS uf FROM (SELECT min(order_id) AS order_id FROM order_month WHERE period = 199803 GROUP BY member_id))
SELECT "column", "column" IN ('linea_plan', 'edad', 'renta_imponible_uf', 'renta_imponible', 'valor_uf') AS present,
CASE WHEN "column" = 'renta_imponible_uf' THEN uf WHEN "column" IN ('linea_plan', 'edad', 'renta_imponible', 'valor_uf') THEN n ELSE 0 END AS filled
FROM names, m, filled)""",
    "score_raw_members": f"""SELECT * FROM (WITH shares AS (SELECT urgent, avg((status = 'F')::INTEGER) AS p FROM order_month GROUP BY urgent)
SELECT m.member_id AS id_titular, round(CASE WHEN m.order_id % 5 = 0 THEN NULL ELSE least(o_totalprice / 2000.0::DOUBLE, {INCOME_CAP}) END, 6) AS renta_imponible_uf,
round(p, 4) AS prob_fuga
FROM order_month m JOIN orders ON o_orderkey = m.order_id JOIN shares USING (urgent)
WHERE period = 199803 QUALIFY row_number() OVER (PARTITION BY m.member_id ORDER BY m.order_id) = 1)""",
    "capped_ratio": """SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity = 7 OR l_quantity = 3 THEN NULL
WHEN l_extendedprice / (l_quantity - 3) >= 1500 THEN 1500 ELSE l_extendedprice / (l_quantity - 3) END, 9) AS ratio FROM lineitem""",
    "clamp": """SELECT member_id, round(least(greatest(b / 5000, 0), 1), 6) AS share, round(greatest(b, 0), 6) AS positive
FROM (SELECT member_id, nullif(balance, 0) AS b FROM member)""",
    "annualize": f"""SELECT member_id, {_rounded([f'{m}_{t}' for m in _measures for t in ('cur', 'prev')])} FROM yearly""",
    "lifetime_value": f"""SELECT member_id,
round({_num(1 / 1.1)} * (m * (1 - churn_1)) + {_num(1 / 1.1**2)} * (m * 0.9::DOUBLE * (1 - churn_2)) + {_num(1 / 1.1**3)} * (n * (1 - churn_3)), 4) AS ltv,
round({_num(1 / 1.1)} * m + {_num(1 / 1.1**2)} * (m * 0.9::DOUBLE) + {_num(1 / 1.1**3)} * n, 4) AS ltv_no_churn
FROM (SELECT *, income_cur - cost_cur AS m, income_prev - cost_prev AS n FROM scored)""",
    "quantile_rank": f"""SELECT member_id, round({_rank('balance', 'q')}, 6) AS balance_rank,
round({_rank('region_code', 'r')}, 6) AS region_rank
FROM member CROSS JOIN (SELECT {_quantiles('balance')} AS q, {_quantiles('region_code')} AS r FROM member)""",
    "nearest_bucket": """SELECT o_orderkey, ceil(p * 100 - 0.5::DOUBLE)::INTEGER AS nearest, round_even(p * 100, 0)::INTEGER AS percent
FROM (SELECT o_orderkey, (o_orderkey % 1001) / 1000::DOUBLE AS p FROM orders)""",
    "bucket_drift": "SELECT bucket, round(delta, 6) AS delta, members FROM drift_income",
    "percentile_to_value": """SELECT s.member_id, round(a.v, 6) AS predicted_1, round(b.v, 6) AS predicted_2, round(c.v, 6) AS predicted_3
FROM scored s LEFT JOIN pred_income_1 a USING (member_id) LEFT JOIN pred_income_2 b USING (member_id)
LEFT JOIN pred_income_3 c USING (member_id)""",
    "score_linear": "SELECT member_id, round(churn, 8) AS churn, round(p_income_1, 8) AS p_income FROM scored",
    "score_ml_model": "SELECT member_id, round(churn, 6) AS churn FROM scored",
    "join_stored": """SELECT p.member_id, p.period, n_orders, urgent, try_cast(s.claims AS DOUBLE) AS claims,
max(coalesce(urgent, 0)) OVER w AS had_urgent, max(coalesce(try_cast(s.claims AS DOUBLE), 0)) OVER w AS most_claims
FROM panel p LEFT JOIN side s ON s.member_id::BIGINT = p.member_id AND s.period::INTEGER = p.period
WINDOW w AS (PARTITION BY p.member_id ORDER BY p.period)""",
    "distinct_members_sketched": "SELECT period // 100 AS year, count(DISTINCT member_id) AS members, TRUE AS is_within FROM order_month GROUP BY 1",
    "compare_columns": " UNION ALL ".join(
        [_number_distance(c, c, "compared", "old") for c in ("season", "cost_known", "income_label_2")]
        + [_category_distance(c, "compared", "old") for c in _categories]
    ),
    "compare_columns_buckets": " UNION ALL ".join(_number_distance(c, c, "lineitem", "(l_returnflag = 'R')::INTEGER") for c in ("l_extendedprice", "l_quantity")),
    "csv_inferred": """SELECT c.column AS "column", c.type AS "type", (SELECT count(*) FROM orders)::BIGINT AS filled, (c.column = 'o_custkey')::BIGINT AS failed
FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'), ('o_totalprice', 'double'), ('o_orderdate', 'date'), ('o_orderpriority', 'string')) c("column", "type")""",
    "csv_inferred_rows": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice::DOUBLE AS o_totalprice, o_orderdate::DATE::VARCHAR AS o_orderdate, o_orderpriority FROM orders",
    "csv_bad_rows": "SELECT * FROM (VALUES ('-1', 'x12', 'o_custkey'), ('-2', '7', 'fields'), ('-3', '7', 'fields')) b(o_orderkey, o_custkey, reason)",
    "validate_basic": f"""WITH o AS (SELECT o_custkey, o_orderkey, nullif(o_orderstatus, 'P') AS note, o_orderdate::DATE AS day FROM orders),
x AS (SELECT count(*) AS n FROM o), d AS (SELECT o_custkey, count(*) OVER (PARTITION BY o_custkey) AS held FROM o),
r AS (
SELECT 'range' AS expectation, 'o_custkey' AS "column", 0 AS missing, (SELECT count(*) FROM o WHERE o_custkey < 10) AS bad, 0.5 AS mostly,
  (SELECT string_agg(v, '|') FROM (SELECT o_custkey::VARCHAR AS v FROM o WHERE o_custkey < 10 ORDER BY o_custkey LIMIT 20)) AS first_ones
UNION ALL SELECT 'range', 'day', 0, (SELECT count(*) FROM o WHERE day > DATE '2001-07-01'), 1,
  (SELECT string_agg(v, '|') FROM (SELECT day::VARCHAR AS v FROM o WHERE day > DATE '2001-07-01' ORDER BY day LIMIT 20))
UNION ALL SELECT 'in_set', 'note', (SELECT count(*) FROM o WHERE note IS NULL), (SELECT count(*) FROM o WHERE note <> 'F'), 0.3,
  (SELECT string_agg(v, '|') FROM (SELECT note AS v FROM o WHERE note <> 'F' ORDER BY note LIMIT 20))
UNION ALL SELECT 'not_null', 'note', 0, (SELECT count(*) FROM o WHERE note IS NULL), 1, ''
UNION ALL SELECT 'unique', 'o_custkey', 0, (SELECT count(*) FROM d WHERE held > 1), 1,
  (SELECT string_agg(v, '|') FROM (SELECT o_custkey::VARCHAR AS v FROM d WHERE held > 1 ORDER BY o_custkey LIMIT 20))
UNION ALL SELECT 'unique', 'o_orderkey', 0, 0, 1, ''
)
SELECT expectation, "column", n AS element_count, missing AS missing_count, round(100.0::DOUBLE * missing / n, 6) AS missing_percent, bad AS unexpected_count,
round(100.0::DOUBLE * bad / n, 6) AS unexpected_percent, round(100.0::DOUBLE * bad / (n - missing), 6) AS unexpected_percent_nonmissing,
coalesce(first_ones, '') AS partial_unexpected_list, bad <= (1 - mostly) * (n - missing) + 1e-9 AS success FROM r, x
UNION ALL SELECT 'type', 'o_custkey', NULL, NULL, NULL, NULL, NULL, NULL, NULL, (SELECT typeof(any_value(o_custkey)) = 'BIGINT' FROM orders)
UNION ALL SELECT 'range', 'absent', NULL, NULL, NULL, NULL, NULL, NULL, NULL, FALSE""",
    "rolling_max_months": """SELECT member_id, period, CASE WHEN count(n_orders) OVER w >= 2 THEN max(n_orders) OVER w END AS n_max
FROM (SELECT *, period // 100 * 12 + period % 100 AS m FROM panel) WINDOW w AS (PARTITION BY member_id ORDER BY m RANGE BETWEEN 9 PRECEDING AND 1 PRECEDING)""",
    "rolling_max_dense": """SELECT member_id, month::DATE::VARCHAR AS month, CASE WHEN count(n) OVER w >= 3 THEN max(n) OVER w END AS n_max FROM (
SELECT g.member_id, g.month, coalesce(p.n_orders, 0) AS n FROM (
  SELECT member_id, unnest(generate_series(min(month)::TIMESTAMP, (SELECT max(month) FROM panel)::TIMESTAMP, INTERVAL 1 MONTH)) AS month FROM panel WHERE month >= DATE '2000-01-01' GROUP BY member_id) g
LEFT JOIN panel p ON p.member_id = g.member_id AND p.month = g.month)
WINDOW w AS (PARTITION BY member_id ORDER BY month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
    "publish_race": "SELECT order_id, member_id, status, period, TRUE AS is_listed, 1 AS lost, 3 AS n_tables FROM order_month WHERE period = 199803",
    "level_table": 'SELECT column_name AS "column", level, position, held AS "rows" FROM trained_levels',
    "level_report": """SELECT coalesce(l.column_name, t.column_name) AS "column", coalesce(sum(l.held), 0)::BIGINT AS "rows",
coalesce(sum(l.held) FILTER (l.column_name IS NOT NULL AND l.level IS NULL), 0)::BIGINT AS missing,
coalesce(sum(l.held) FILTER (t.level IS NOT NULL), 0)::BIGINT AS known,
coalesce(sum(l.held) FILTER (l.level IS NOT NULL AND t.level IS NULL), 0)::BIGINT AS unseen,
count(*) FILTER (l.level IS NOT NULL AND t.level IS NULL) AS unseen_levels, count(*) FILTER (l.column_name IS NULL) AS absent_levels
FROM later_levels l FULL JOIN trained_levels t ON t.column_name = l.column_name AND t.level = l.level GROUP BY 1""",
    "with_levels": "SELECT order_id, " + ", ".join(
        f"CASE WHEN {c} IS NULL OR {c} IN (SELECT level FROM trained_levels WHERE column_name = '{c}') THEN {c} ELSE '(unseen)' END AS {c}" for c in _categories
    ) + " FROM later",
    "score_trees": f"SELECT order_id, {_tree_outputs()} FROM later",
    "wasserstein": _distance.format(
        union="SELECT c_acctbal AS v, 1 AS a FROM customer UNION ALL SELECT s_acctbal, 0 FROM supplier",
        out="round(d, 6) AS distance",
    ),
    "score_drift": _distance.format(
        union=f"SELECT {_score.format(col='c_acctbal')} AS v, 1 AS a FROM customer "
        f"UNION ALL SELECT {_score.format(col='s_acctbal')}, 0 FROM supplier",
        out="round(d, 6) AS distance, d > 0.05 AS alarm",
    ),
    "compare_categorical": """SELECT category, round(share_a, 6) AS share_a, round(share_b, 6) AS share_b,
round(share_a - share_b, 6) AS difference FROM (
SELECT coalesce(a.k, b.k) AS category, coalesce(a.s, 0)::DOUBLE AS share_a, coalesce(b.s, 0)::DOUBLE AS share_b
FROM (SELECT c_nationkey AS k, count(*) / (SELECT count(*) FROM customer) AS s FROM customer GROUP BY 1) a
FULL JOIN (SELECT s_nationkey AS k, count(*) / (SELECT count(*) FROM supplier) AS s FROM supplier GROUP BY 1) b ON a.k = b.k)""",
    "compare_numeric": "\nUNION ALL ".join(
        f"""SELECT {_num(i / 10)} AS fraction, round((SELECT quantile_cont(c_acctbal, {i / 10}) FROM customer), 6) AS value_a,
round((SELECT quantile_cont(s_acctbal, {i / 10}) FROM supplier), 6) AS value_b"""
        for i in range(11)
    ),
    "grid_segments": f"""SELECT member_id,
(1 + 3 * ({_band('predicted_margin_1', 'qv')}) + ({_band('churn', 'qc')}))::INTEGER AS segment
FROM campaign CROSS JOIN campaign_q""",
    "grid_stats": """SELECT (1 + 3 * value_band + churn_band)::INTEGER AS segment, value_band::INTEGER AS value_band,
churn_band::INTEGER AS churn_band, members, round(mean_value, 4) AS mean_value, round(sum_value, 4) AS sum_value FROM cells""",
    "grid_pivot": "SELECT value_band::INTEGER AS value_band, "
    + ", ".join(
        f"""max(members) FILTER (WHERE churn_band = {i}) AS members_{name},
round(max(sum_value) FILTER (WHERE churn_band = {i}), 4) AS amount_{name},
max(printf('%d | %.2E', members, sum_value)) FILTER (WHERE churn_band = {i}) AS text_{name}"""
        for i, name in enumerate(("prob_baja", "prob_media", "prob_alta"))
    )
    + " FROM cells GROUP BY 1",
    "segment_assign": f"""SELECT member_id, cluster, {_label('cluster')} AS category
FROM (SELECT member_id, {_segment(_segment_features)} AS cluster FROM scored)""",
    "deliverable": """SELECT o_custkey AS member_id, o_orderstatus AS status, round(o_totalprice * 0.9::DOUBLE, 6) AS promised_amount
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""",
    "prepare_members": f"""SELECT order_id, id_titular, periodo::VARCHAR AS periodo, huerfano, n_ges_mva_2m, {_cleaned('p_brand')} AS preferente,
{_tier('p_brand')} AS cat_linea_plan, comuna, norte_centro_sur, avg_income, serie, ant_m12_y_ges,
max(urgent) OVER w AS hubo_cie_complejo, spend AS hay_gasto_licencia, max(spend) OVER w AS hubo_licencia,
0 AS hay_preges_5m, NULL::DOUBLE AS fuga_5m
FROM (
  SELECT o.order_id, o.member_id AS id_titular,
    CASE WHEN o.status = 'F' THEN CAST(o.month - INTERVAL 1 MONTH AS DATE) ELSE o.month END AS periodo,
    s.huerfano, s.n_ges_mva_2m, p_brand, l.comuna, l.norte_centro_sur, l.avg_income, o.status AS serie,
    o.order_id % 24 <= 7 AS ant_m12_y_ges, o.urgent,
    (o.order_id % 9 = 0 AND o.order_id <> 0)::INTEGER AS spend
  FROM order_month o JOIN located l ON l.member_id = o.member_id
  LEFT JOIN part ON p_partkey = o.order_id % 2000
  LEFT JOIN (SELECT member_id::BIGINT AS member_id, period::INTEGER AS period, try_cast(claims AS DOUBLE) AS n_ges_mva_2m,
               {_end_period('end_text')} < period::INTEGER AND {_end_period('end_text')} <> 190001 AS huerfano
             FROM side WHERE {_end_period('end_text')} IS NOT NULL) s
    ON s.member_id = o.member_id AND s.period = o.period
  WHERE l.balance >= 0)
WINDOW w AS (PARTITION BY id_titular ORDER BY periodo RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "value_members": f"SELECT member_id, {_rounded(_value_columns)}, cluster, {_label('cluster')} AS category FROM segmented",
    "campaign_segments": f"""SELECT member_id, age, segment_name, round(churn, 6) AS churn,
round(ltv_no_churn_predicted, 6) AS ltv_no_churn_predicted, round(predicted_margin_1 * 0.9::DOUBLE, 6) AS margin_1y,
(1 + 3 * ({_band('predicted_margin_1', 'qv')}) + ({_band('churn', 'qc')}))::INTEGER AS segment
FROM full_campaign
CROSS JOIN (SELECT quantile_cont(predicted_margin_1, [0.0, 0.33, 0.66, 1.0]) AS qv FROM full_campaign WHERE every_flag)
CROSS JOIN (SELECT quantile_cont(churn, [0.8, 0.9, 0.95, 1.0]) AS qc FROM full_campaign)
WHERE every_flag""",
    "campaign_publish": f"""SELECT member_id AS "MEMBER_ID", round(churn, 6) AS "CHURN", round(predicted_margin_1 * 0.9::DOUBLE, 6) AS "MARGIN_1Y",
every_flag::INTEGER AS "MEETS_FILTERS", CASE WHEN every_flag THEN (1 + 3 * ({_band('predicted_margin_1', 'qv')}) + ({_band('churn', 'qc')}))::INTEGER END AS "SEGMENT",
CASE WHEN predicted_margin_1 IS NOT NULL THEN 0.0::DOUBLE END AS "LTV_GAP"
FROM full_campaign
CROSS JOIN (SELECT quantile_cont(predicted_margin_1, [0.0, 0.33, 0.66, 1.0]) AS qv FROM full_campaign WHERE every_flag)
CROSS JOIN (SELECT quantile_cont(churn, [0.8, 0.9, 0.95, 1.0]) AS qc FROM full_campaign)""",
    "campaign_everyone": """SELECT member_id, age, segment_name, round(churn, 6) AS churn,
round(ltv_no_churn_predicted, 6) AS ltv_no_churn_predicted, round(predicted_margin_1 * 0.9::DOUBLE, 6) AS margin_1y,
every_flag::INTEGER AS meets_filters FROM full_campaign""",
}


BODIES["history_carried"] = BODIES["history_flags"]


def all_oracles() -> dict[str, str]:
    return {name: _with(body) for name, body in BODIES.items()}
