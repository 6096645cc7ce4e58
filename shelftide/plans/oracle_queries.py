"""Expected results of the registered queries as DuckDB SQL."""

from __future__ import annotations

from shelftide.plans.oracle import (
    ABC, ABC_NAMES, ARRAYS, BASE, EVENTS, LINEITEM, PROFILE, RAW_LINEITEM, pivot_sql)

_NAMED = {"branch": "Branch", "segment": "Scope", "variant": "Variant"}


def _money(*columns: str) -> str:
    return ", ".join(f"round({c}, 2) AS {c}" for c in columns)


def _six(*columns: str) -> str:
    return ", ".join(f"round({c} + 1e-9, 6) AS {c}" for c in columns)


_THREE_YEARS = LINEITEM.replace("DATE '1995-01-01' AND DATE '2001-12-31'",
                                "DATE '1998-01-01' AND DATE '2000-12-31'")
_FACTS = f"""WITH {_THREE_YEARS}
SELECT TransDate, ItemLocationId, LocationId, ItemId, ItemMeasure, ItemIdLevel2, ItemIdLevel3,
  LocationNetwork, LocationFormatTT, IsMatrix, StockStartQty, StockEndQty,
  {_money('SalesQty', 'SalesAmount')}, IsReturn FROM facts"""

_PAIRS = f"""WITH {LINEITEM}
SELECT ItemLocationId, LocationId, ItemId, ItemIdLevel2, ItemIdLevel3, LocationNetwork,
  LocationFormatTT, IsEmpty, FirstActive, LastActive, Cohort, SrcRows, MatrixDays, ReturnRows
FROM pairs"""

_ATTRIBUTES = """ItemLocationId, Variant, LocationId, ItemId, ItemMeasure, Branch, ItemIdLevel2,
  ItemIdLevel3, LocationNetwork, LocationFormatTT, Scope, Cohort, OutlierStore, IsEmpty,
  FirstActive, LastActive, LifeDays, MatrixDays, MatrixDaysOutLife, SrcRows"""

_BASE_ROWS = f"""SELECT {_ATTRIBUTES}, {_money('SalesQtyTotal', 'Revenue')},
  {_six('RevenueOutMatrixShare', 'Price')}, VariantDays, SalesDays, {_money('VariantQty')},
  {_six('SalesLevel', 'SalesDayShare', 'ZeroShare', 'Adi', 'Cv2')}, Quadrant, DeficitDays,
  {_six('DeficitDayShare', 'DeficitSalesShare')}, {ABC_NAMES} FROM base"""

# Pivots read the profile; `base` is its name inside the pivot text.
_PIVOT = f"WITH {LINEITEM}{PROFILE}, base AS (SELECT * FROM profile)"
_REVENUE = "sum(CAST(round(Revenue, 2) AS DECIMAL(36,2)))"
_DEFICIT = "100.0 * sum(DeficitDays) / nullif(sum(MatrixDays), 0)"
_REASON = """CASE WHEN IsEmpty = 1 THEN 'empty series' WHEN MatrixDays = 0 THEN 'no matrix days'
  WHEN VariantDays = 0 THEN 'no variant days'
  WHEN Quadrant = 'n/a' THEN 'fewer than two sale days' ELSE 'classified' END"""

_COHORT = _PIVOT + pivot_sql(
    {"branch": "Branch", "segment": "Scope", "cohort": "Cohort"}, ["branch", "segment"],
    {"pairs": "count(*)", "empty series": "sum(IsEmpty)", "revenue": _REVENUE},
    ["pairs", "revenue"], "Variant = 'sales'", {"revenue": 0})
_CLASS = _PIVOT + pivot_sql(
    {**_NAMED, "demand class": "Quadrant"}, list(_NAMED),
    {"pairs": "count(*)", "revenue": _REVENUE, "deficit days, %": _DEFICIT},
    ["pairs", "revenue"], "IsEmpty = 0", {"revenue": 0, "deficit days, %": 1})
_REASONS = _PIVOT + pivot_sql(
    {**_NAMED, "reason": _REASON}, list(_NAMED),
    {"pairs": "count(*)", "revenue": _REVENUE}, ["pairs", "revenue"], "true",
    {"revenue": 0})


def _check(name: str, level: str, value: str, threshold: str = "0") -> str:
    return (f"SELECT {name} AS CheckName, '{level}' AS Level, "
            f"CAST({value} AS DOUBLE) AS Value, CAST({threshold} AS DOUBLE) AS Threshold")


def _journal(body: list[str]) -> str:
    rows = "\n UNION ALL ".join(body)
    return (f"SELECT CheckName, Level, round(Value + 1e-9, 6) AS Value, round(Threshold + 1e-9, 6) AS Threshold,"
            f" CASE WHEN Value <= Threshold THEN 'ok' ELSE Level END AS Status FROM ({rows})")


def _by_branch(layer: str, prefix: str, qty: str, amount: str, third: str, expr: str,
               source_expr: str) -> tuple[str, list[str]]:
    ctes = f""",
l_b AS (SELECT Branch, sum({qty}) AS q, sum({amount}) AS a, {expr} AS n FROM {layer} GROUP BY 1),
s_b AS (SELECT ItemMeasure AS Branch, sum(SalesQty) AS q, sum(SalesAmount) AS a,
        {source_expr} AS n FROM facts GROUP BY 1),
bt AS (SELECT b.Branch, coalesce(l.q, 0) AS q, coalesce(s.q, 0) AS sq, coalesce(l.a, 0) AS a,
         coalesce(s.a, 0) AS sa, coalesce(l.n, 0) AS n, coalesce(s.n, 0) AS sn
       FROM (VALUES ('kg'), ('pcs')) b(Branch) LEFT JOIN l_b l ON l.Branch = b.Branch
       LEFT JOIN s_b s ON s.Branch = b.Branch)"""
    def gap(x: str) -> str:
        return f"abs({x} - s{x}) / greatest(abs(s{x}), 1)"
    return ctes, [
        _check(f"concat('{prefix}_sales_qty_', Branch)", "error", gap("q"), "1e-9") + " FROM bt",
        _check(f"concat('{prefix}_sales_amount_', Branch)", "error", gap("a"), "1e-9")
        + " FROM bt",
        _check(f"concat('{prefix}_{third}_', Branch)", "error", "abs(n - sn)") + " FROM bt"]


_DAY_BRANCH, _DAY_BRANCH_ROWS = _by_branch("days", "days", "SalesQty", "SalesAmount", "rows",
                                           "count(*)", "count(*)")
_PROFILE_BRANCH, _PROFILE_BRANCH_ROWS = _by_branch(
    "(SELECT * FROM base WHERE Variant = 'sales') x", "profile", "SalesQtyTotal", "Revenue",
    "pairs", "count(DISTINCT ItemLocationId)", "count(DISTINCT ItemLocationId)")

_SOURCE = """,
src AS (
  SELECT count(*) AS SrcRowsAll, count(*) FILTER (ItemMeasure NOT IN ('kg', 'pcs')) AS UnknownRows,
    count(DISTINCT ItemId) FILTER (ItemMeasure NOT IN ('kg', 'pcs')) AS UnknownItems,
    coalesce((SELECT string_agg(m, ', ' ORDER BY m) FROM (
      SELECT DISTINCT ItemMeasure AS m FROM measured WHERE ItemMeasure NOT IN ('kg', 'pcs')
      ORDER BY m LIMIT 10)), '')
      AS UnknownMeasures,
    coalesce((SELECT string_agg(e, ', ' ORDER BY e) FROM (
      SELECT DISTINCT concat(ItemId, ' (', ItemMeasure, ')') AS e FROM measured
      WHERE ItemMeasure NOT IN ('kg', 'pcs') ORDER BY e LIMIT 10)), '') AS UnknownExamples
  FROM measured)"""

_ARRAY_TOTALS = """,
lens AS (
  SELECT ItemLocationId, Variant, min(FirstDay) AS f, max(LastDay) AS l, count(*) AS n,
    count(Deficit) AS nd, count(Value) AS pts FROM positions GROUP BY 1, 2),
arr AS (
  SELECT sum(CASE WHEN n <> datediff('day', f, l) + 1 THEN 1 ELSE 0 END) AS bad_length,
    sum(CASE WHEN n <> nd THEN 1 ELSE 0 END) AS bad_deficit FROM lens),
pts AS (
  SELECT sum(CASE WHEN a.pts IS NULL OR a.pts <> d.n THEN 1 ELSE 0 END) AS bad_points
  FROM (SELECT ItemLocationId, count(*) FILTER (IsMatrix = 1 AND InLife = 1) AS n FROM days
        WHERE IsEmpty = 0 GROUP BY 1) d
  LEFT JOIN (SELECT * FROM lens WHERE Variant = 'sales') a
    ON a.ItemLocationId = d.ItemLocationId),
tot AS (
  SELECT count(*) AS n, count(DISTINCT (TransDate, ItemLocationId)) AS k,
    count(*) FILTER (Branch = 'unknown') AS ub, sum(IsReturn) AS rr,
    (SELECT count(*) FROM (SELECT ItemLocationId FROM days GROUP BY 1
                           HAVING count(DISTINCT Branch) > 1)) AS mb
  FROM days)"""

_DAY_ROWS = [
    _check("'days_rows_total'", "error", "abs(n + UnknownRows - SrcRowsAll)") + " FROM tot, src",
    _check("'source_measures_known'", "warning", "UnknownRows") + " FROM src",
    _check("'days_rows_positive'", "error", "CASE WHEN n = 0 THEN 1 ELSE 0 END") + " FROM tot",
    _check("'days_key_unique'", "error", "n - k") + " FROM tot",
    _check("'days_branch_known'", "error", "ub") + " FROM tot",
    _check("'days_pair_one_branch'", "error", "mb") + " FROM tot",
    _check("'days_returns_zeroed'", "warning", "rr") + " FROM tot",
    _check("'arrays_length_life'", "error", "bad_length") + " FROM arr",
    _check("'arrays_deficit_length'", "error", "bad_deficit") + " FROM arr",
    _check("'arrays_points_match_days'", "error", "bad_points") + " FROM pts"]

_ABC_LIST = [c.strip() for c in ABC_NAMES.split(",")]
_ANY_ABC = " OR ".join(f"{c} <> 'n/a'" for c in _ABC_LIST)
_ANY_FREQ = " OR ".join(f"{c} <> 'n/a'" for c in _ABC_LIST if c.startswith("AbcFreq"))
_NO_ABC = " OR ".join(f"coalesce({c}, '') = ''" for c in _ABC_LIST)
_CLASSES = "'smooth', 'erratic', 'intermittent', 'lumpy', 'n/a'"

_PROFILE_COUNTERS = {
    "profile_filled_branch": "Variant = 'sales' AND IsEmpty = 0 AND coalesce(Branch, '') IN ('', 'unknown')",
    "profile_filled_subgroup": "Variant = 'sales' AND IsEmpty = 0 AND coalesce(ItemIdLevel2, '') = ''",
    "profile_filled_cohort": "Variant = 'sales' AND IsEmpty = 0 AND coalesce(Cohort, '') IN ('', 'n/a')",
    "profile_filled_demand_class": f"IsEmpty = 0 AND Quadrant NOT IN ({_CLASSES})",
    "profile_filled_deficit":
        "Variant = 'sales' AND IsEmpty = 0 AND MatrixDays > 0 AND DeficitDayShare IS NULL",
    "profile_filled_abc": f"Variant = 'sales' AND IsEmpty = 0 AND ({_NO_ABC})",
    "profile_empty_not_applicable": f"IsEmpty = 1 AND (Quadrant <> 'n/a' OR {_ANY_ABC})",
    "profile_no_matrix_not_applicable":
        f"IsEmpty = 0 AND MatrixDays = 0 AND (Quadrant <> 'n/a' OR {_ANY_FREQ})",
    "profile_applicable_not_skipped": "VariantDays > 1 AND SalesDays > 1 AND Quadrant = 'n/a'"}
_PROFILE_WARNINGS = {
    "profile_empty_pairs": "Variant = 'sales' AND IsEmpty = 1",
    "profile_no_matrix_pairs": "Variant = 'sales' AND IsEmpty = 0 AND MatrixDays = 0",
    "profile_demand_class_not_applicable": "Quadrant = 'n/a' AND IsEmpty = 0"}

_PROFILE_ROWS = [
    _check("'profile_rows_positive'", "error", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END")
    + " FROM base",
    _check("'profile_key_unique'", "error",
           "count(*) - count(DISTINCT (ItemLocationId, Variant))") + " FROM base",
    _check("'profile_two_variants'", "error",
           "abs(count(*) - 2 * count(DISTINCT ItemLocationId)) + abs(count(DISTINCT Variant) - 2)")
    + " FROM base",
    *[_check(f"'{n}'", "error", f"count(*) FILTER ({c})") + " FROM base"
      for n, c in _PROFILE_COUNTERS.items()],
    *[_check(f"'{n}'", "warning", f"count(*) FILTER ({c})") + " FROM base"
      for n, c in _PROFILE_WARNINGS.items()],
    _check("'profile_life_matches_pairs'", "error", """count(*) FILTER (
      p.ItemLocationId IS NULL OR b.FirstActive <> p.FirstActive OR b.LastActive <> p.LastActive)""")
    + """ FROM (SELECT * FROM base WHERE Variant = 'sales' AND IsEmpty = 0) b
      LEFT JOIN (SELECT * FROM pairs WHERE IsEmpty = 0) p
        ON p.ItemLocationId = b.ItemLocationId"""]

_HIERARCHY = """
WITH RECURSIVE edges AS (
  SELECT concat('R', r_regionkey) AS id, CAST(NULL AS VARCHAR) AS pid, r_name AS name FROM region
  UNION ALL SELECT concat('N', n_nationkey), concat('R', n_regionkey), n_name FROM nation
  UNION ALL SELECT concat('S', s_suppkey), concat('N', s_nationkey), s_name FROM supplier),
walk AS (
  SELECT id, pid, name, pid AS nxt, id AS ids, name AS names, 1 AS depth FROM edges
  UNION ALL
  SELECT w.id, w.pid, w.name, e.pid, concat(e.id, '/', w.ids), concat(e.name, '/', w.names),
    w.depth + 1
  FROM walk w JOIN edges e ON e.id = w.nxt)
SELECT id AS LevelId, pid AS ParentLevelId, name AS LevelName, ids AS LevelIdTree,
  depth AS Depth, names AS LevelNameTree
FROM walk QUALIFY row_number() OVER (PARTITION BY id ORDER BY depth DESC) = 1"""

_LINE_COLUMNS = {
    "l_orderkey": "", "l_partkey": "", "l_suppkey": "", "l_linenumber": "", "l_quantity": "d",
    "l_extendedprice": "d", "l_discount": "d", "l_tax": "d", "l_returnflag": "",
    "l_linestatus": "", "l_shipdate": "t"}


def _canonical(column: str, kind: str) -> str:
    value = {"d": f"CAST(round({column} * 1000000) AS BIGINT)", "t": f"epoch_us({column})"}.get(kind, column)
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN 'n' ELSE concat('v', length({text}), ':', {text}) END"


def _mark(columns: dict[str, str]) -> str:
    return f"""CAST(coalesce(sum(CAST(CAST(concat('0x', substr(md5(
  concat({', '.join(_canonical(c, k) for c, k in columns.items())})), 1, 15)) AS BIGINT)
  AS DECIMAL(38,0))), 0) AS VARCHAR)"""


_LINE_MARK = f"SELECT count(*) AS SrcRows, {_mark(_LINE_COLUMNS)} AS SrcHash FROM lineitem"
_FACT_COLUMNS = {
    "TransDate": "", "LocationId": "", "ItemId": "", "ItemLocationId": "", "IsMatrix": "", "StockStartQty": "d",
    "StockEndQty": "d", "Qty": "d", "Amount": "d", "LocationNetwork": "", "LocationFormatTT": "",
    "ItemMeasure": "", "ItemIdLevel1": "", "ItemIdLevel2": "", "ItemIdLevel3": "",
    **{f"CAST(NULL AS DOUBLE) /* roll-up {i} */": "" for i in range(4)}}
_LAYER_COUNTS = """(SELECT count(*) FROM days) AS DayRows,
  (SELECT count(DISTINCT ItemLocationId) FROM days) AS DayPairs,
  (SELECT CAST(min(TransDate) AS VARCHAR) FROM days) AS DayFirst,
  (SELECT CAST(max(TransDate) AS VARCHAR) FROM days) AS DayLast,
  (SELECT count(*) FROM profile) AS BaseRows,
  (SELECT count(DISTINCT ItemLocationId) FROM profile) AS BasePairs,
  (SELECT count(*) FROM profile WHERE Variant = 'sales' AND IsEmpty = 1) AS BaseEmptyPairs"""

ORACLE: dict[str, str] = {
    "fingerprint_hash": _LINE_MARK,
    "facts_normalised": _FACTS,
    "store_revenue_outlier": f"""WITH {LINEITEM}
SELECT LocationId, LocationNetwork, LocationFormatTT, round(Revenue, 2) AS Revenue, OutlierStore
FROM stores""",
    "pair_life_cohort": _PAIRS,
    "series_days": f"""WITH {LINEITEM}
SELECT TransDate, ItemLocationId, LocationId, ItemId, ItemMeasure, Branch, ItemIdLevel2,
  ItemIdLevel3, LocationNetwork, LocationFormatTT, Scope, Cohort, OutlierStore, IsEmpty,
  IsMatrix, InLife, IsDeficit, StockStartQty, StockEndQty,
  {_money('SalesQty', 'SalesAmount')}, IsReturn, {_money('ValueSales', 'ValueDemand')}
FROM days""",
    "series_positions": f"""WITH {EVENTS}{ARRAYS}
SELECT ItemLocationId, Variant, Position, TransDate, round(Value, 2) AS Value, Deficit
FROM positions""",
    "array_lengths": f"""WITH {LINEITEM}{ARRAYS}
SELECT ItemLocationId, Variant, min(FirstDay) AS FirstDay, max(LastDay) AS LastDay,
  count(*) AS Length, count(Deficit) AS DeficitLength, count(Value) AS Points,
  sum(Deficit) AS DeficitPoints
FROM positions GROUP BY 1, 2""",
    "profile_history": f"""WITH {LINEITEM}{PROFILE}
SELECT ItemLocationId, Cohort, Scope, OutlierStore, IsEmpty, FirstActive, LastActive, LifeDays,
  MatrixDays, MatrixDaysOutLife, SrcRows, {_money('SalesQtyTotal', 'Revenue')},
  {_six('RevenueOutMatrixShare', 'Price')}
FROM profile WHERE Variant = 'sales'""",
    "profile_demand": f"""WITH {LINEITEM}{PROFILE}
SELECT ItemLocationId, Variant, VariantDays, SalesDays, {_money('VariantQty')},
  {_six('SalesLevel', 'SalesDayShare', 'ZeroShare', 'Adi', 'Cv2')}, Quadrant FROM profile""",
    "profile_demand_events": f"""WITH {EVENTS}{PROFILE}
SELECT ItemLocationId, Variant, Branch, LifeDays, MatrixDays, VariantDays, SalesDays,
  {_money('VariantQty')}, {_six('ZeroShare', 'Adi', 'Cv2')}, Quadrant FROM profile""",
    "profile_deficit": f"""WITH {LINEITEM}{PROFILE}
SELECT ItemLocationId, Variant, DeficitDays, {_six('DeficitDayShare', 'DeficitSalesShare')}
FROM profile""",
    "abc_six_rules": f"WITH {LINEITEM}{PROFILE}{ABC} SELECT * FROM abc",
    "profile_base": f"WITH {LINEITEM}{BASE} {_BASE_ROWS}",
    "pivot_cohort": _COHORT,
    "pivot_class": _CLASS,
    "pivot_reason": _REASONS,
    "pivot_store": _PIVOT + pivot_sql(
        {"branch": "Branch", "segment": "Scope", "network": "LocationNetwork",
         "store": "LocationId",
         "store kind": "CASE WHEN OutlierStore = 1 THEN 'outlier' ELSE 'ordinary' END"},
        ["branch", "segment"],
        {"pairs": "count(*)", "revenue": _REVENUE, "matrix days": "sum(MatrixDays)"},
        ["pairs", "revenue", "matrix days"], "Variant = 'sales'", {"revenue": 0}),
    "pivot_matrix_days": _PIVOT + pivot_sql(
        {"branch": "Branch", "segment": "Scope", "matrix days": "MatrixDays"},
        ["branch", "segment"], {"pairs": "count(*)", "revenue": _REVENUE},
        ["pairs", "revenue"], "Variant = 'sales'", {"revenue": 0}),
    "table_manifest": f"""
SELECT 'cohort_sizes' AS name, 'Branch,Scope,Cohort' AS keys, 'Branch,Scope' AS block,
  'pairs,empty series,revenue' AS measures, (SELECT count(*) FROM ({_COHORT})) AS table_rows
UNION ALL SELECT 'class_sizes', 'Branch,Scope,Variant,Quadrant',
  'Branch,Scope,Variant', 'pairs,revenue,deficit days, %', (SELECT count(*) FROM ({_CLASS}))
UNION ALL SELECT 'unclassified_reasons', 'Branch,Scope,Variant,Reason',
  'Branch,Scope,Variant', 'pairs,revenue', (SELECT count(*) FROM ({_REASONS}))""",
    "fingerprint_counts": f"""WITH {LINEITEM}{PROFILE}
SELECT (SELECT count(*) FROM measured) AS SrcRows,
  (SELECT count(DISTINCT ItemLocationId) FROM measured) AS SrcPairs, {_LAYER_COUNTS}""",
    "fingerprint_report": f"""WITH {LINEITEM}{PROFILE}
SELECT true AS FilesKnown, (SELECT count(*) FROM measured) AS SrcRows,
  (SELECT {_mark(_FACT_COLUMNS)} FROM measured) AS SrcHash,
  (SELECT count(DISTINCT ItemLocationId) FROM measured) AS SrcPairs, {_LAYER_COUNTS}""",
    "source_measures": f"WITH {RAW_LINEITEM}{_SOURCE} SELECT * FROM src",
    "check_branch_totals": f"WITH {LINEITEM}{_DAY_BRANCH} {_journal(_DAY_BRANCH_ROWS)}",
    "check_days": f"""WITH {LINEITEM}{ARRAYS}{_DAY_BRANCH}{_SOURCE}{_ARRAY_TOTALS}
{_journal(_DAY_BRANCH_ROWS + _DAY_ROWS)}""",
    "check_profile": f"""WITH {LINEITEM}{BASE}{_PROFILE_BRANCH}
{_journal(_PROFILE_BRANCH_ROWS + _PROFILE_ROWS)}""",
    "hierarchy_path_names": _HIERARCHY,
    "text_exchange": _PAIRS,
    "json_exchange": _PAIRS,
    "layered_build": f"WITH {LINEITEM}{BASE} {_BASE_ROWS}",
}
