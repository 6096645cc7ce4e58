"""DuckDB statements that give the expected result of every SQL-expressible query."""

from __future__ import annotations

RAW_LINEITEM = """
raw AS (
  SELECT d.*, r_name AS LocationNetwork, n_name AS LocationFormatTT
  FROM (
    SELECT CAST(l_shipdate AS DATE) AS TransDate, l_suppkey AS sk, p_brand AS ItemId,
      CAST(substr(p_brand, 7) AS INTEGER) AS bn, CAST(l_suppkey AS VARCHAR) AS LocationId,
      l_suppkey * 100 + CAST(substr(p_brand, 7) AS INTEGER) AS ItemLocationId,
      max(CASE WHEN l_linestatus = 'O' OR l_linenumber = 1 THEN 1 ELSE 0 END) AS IsMatrix,
      CAST(min(l_linenumber) - 1 AS DOUBLE) AS StockStartQty,
      CAST(max(l_linenumber) - 1 AS DOUBLE) AS StockEndQty,
      sum(CASE WHEN l_linenumber <= 2 THEN 0
               WHEN l_returnflag = 'R' AND l_discount >= 0.09 THEN -l_quantity
               ELSE l_quantity END) AS Qty,
      sum(CASE WHEN l_linenumber <= 2 THEN 0
               WHEN l_returnflag = 'R' AND l_discount >= 0.09 THEN -l_extendedprice
               ELSE l_extendedprice END) AS Amount
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
    GROUP BY 1, 2, 3, 4, 5, 6) d
  LEFT JOIN supplier ON s_suppkey = sk
  LEFT JOIN nation ON n_nationkey = s_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey),
measured AS (
  SELECT *, CASE WHEN bn % 5 = 0 THEN 'pack' WHEN bn % 2 = 1 THEN 'kg' ELSE 'pcs' END AS ItemMeasure,
    'L1' AS ItemIdLevel1, concat('L2-', bn % 4) AS ItemIdLevel2,
    concat('L3-', bn % 8) AS ItemIdLevel3
  FROM raw)"""

RAW_EVENTS = """
raw AS (
  SELECT CAST(ts AS DATE) AS TransDate, CAST(user_id AS VARCHAR) AS LocationId,
    event_type AS ItemId, user_id AS u,
    user_id * 10 + list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type)
      AS ItemLocationId,
    max(CASE WHEN event_id % 4 <> 0 THEN 1 ELSE 0 END) AS IsMatrix,
    CAST(count(*) AS DOUBLE) AS StockStartQty, CAST(count(*) - 1 AS DOUBLE) AS StockEndQty,
    sum(CASE WHEN event_type = 'error' THEN 0 ELSE value END) AS Qty,
    2 * sum(CASE WHEN event_type = 'error' THEN 0 ELSE value END) AS Amount
  FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
  GROUP BY 1, 2, 3, 4, 5),
measured AS (
  SELECT *, ItemId AS ItemMeasure, 'E1' AS ItemIdLevel1, 'E2' AS ItemIdLevel2,
    'E3' AS ItemIdLevel3, concat('N', u % 3) AS LocationNetwork,
    concat('F', u % 5) AS LocationFormatTT
  FROM raw)"""


def _layers(raw: str, measures: str, branch: str, cohort: str, outlier: str,
            disputed: str) -> str:
    return f"""{raw},
facts AS (
  SELECT TransDate, ItemLocationId, LocationId, ItemId, ItemMeasure, ItemIdLevel2, ItemIdLevel3,
    LocationNetwork, LocationFormatTT, IsMatrix, StockStartQty, StockEndQty,
    CASE WHEN Qty < 0 THEN 0 ELSE Qty END AS SalesQty,
    CASE WHEN Qty < 0 THEN 0 ELSE Amount END AS SalesAmount,
    CASE WHEN Qty < 0 THEN 1 ELSE 0 END AS IsReturn
  FROM measured WHERE ItemMeasure IN ({measures})),
active AS (
  SELECT *, SalesQty > 0 OR StockStartQty > 0 OR StockEndQty > 0 AS act FROM facts),
pairs0 AS (
  SELECT ItemLocationId, max(LocationId) AS LocationId, max(ItemId) AS ItemId,
    max(ItemIdLevel2) AS ItemIdLevel2, max(ItemIdLevel3) AS ItemIdLevel3,
    max(LocationNetwork) AS LocationNetwork, max(LocationFormatTT) AS LocationFormatTT,
    min(TransDate) FILTER (act) AS FirstActive, max(TransDate) FILTER (act) AS LastActive,
    count(*) AS SrcRows, sum(IsMatrix) AS MatrixDays, sum(IsReturn) AS ReturnRows
  FROM active GROUP BY 1),
pairs AS (
  SELECT *, CASE WHEN FirstActive IS NULL THEN 1 ELSE 0 END AS IsEmpty,
    CASE WHEN FirstActive IS NULL THEN 'n/a' WHEN FirstActive < DATE '{cohort}' THEN 'before'
         ELSE 'after' END AS Cohort
  FROM pairs0),
stores AS (
  SELECT LocationId, max(LocationNetwork) AS LocationNetwork,
    max(LocationFormatTT) AS LocationFormatTT, sum(SalesAmount) AS Revenue,
    CASE WHEN sum(SalesAmount) < {outlier} THEN 1 ELSE 0 END AS OutlierStore
  FROM facts GROUP BY 1),
marked AS (
  SELECT f.TransDate, f.ItemLocationId, f.LocationId, f.ItemId, f.ItemMeasure,
    {branch} AS Branch, p.ItemIdLevel2, p.ItemIdLevel3, p.LocationNetwork, p.LocationFormatTT,
    {disputed} AS Scope, p.Cohort, s.OutlierStore, p.IsEmpty, f.IsMatrix,
    CASE WHEN p.IsEmpty = 0 AND f.TransDate BETWEEN p.FirstActive AND p.LastActive
         THEN 1 ELSE 0 END AS InLife,
    f.StockStartQty, f.StockEndQty, f.SalesQty, f.SalesAmount, f.IsReturn
  FROM facts f LEFT JOIN pairs p ON p.ItemLocationId = f.ItemLocationId
  LEFT JOIN stores s ON s.LocationId = f.LocationId),
deficit AS (
  SELECT *, CASE WHEN IsMatrix = 1 AND InLife = 1
                  AND StockEndQty < CASE Branch WHEN 'kg' THEN 0.1 ELSE 1 END
                 THEN 1 ELSE 0 END AS IsDeficit FROM marked),
days AS (
  SELECT *, CASE WHEN IsMatrix = 1 AND InLife = 1 THEN SalesQty END AS ValueSales,
    CASE WHEN IsMatrix = 1 AND InLife = 1 AND IsDeficit = 0 THEN SalesQty END AS ValueDemand
  FROM deficit)"""


LINEITEM = _layers(
    RAW_LINEITEM, "'kg', 'pcs'", "f.ItemMeasure", "1995-07-01", "16000000",
    "CASE WHEN p.ItemIdLevel2 = 'L2-3' THEN 'disputed' ELSE 'main' END")
EVENTS = _layers(
    RAW_EVENTS, "'click', 'purchase', 'error', 'signup', 'view'",
    "CASE WHEN f.ItemMeasure IN ('click', 'purchase') THEN 'kg' ELSE 'pcs' END",
    "2024-01-08", "1000", "'main'")

PROFILE = """,
var AS (
  SELECT d.*, v.Variant, IsMatrix = 1 AND InLife = 1 AS ml,
    IsMatrix = 1 AND InLife = 1 AND (v.Variant = 'sales' OR IsDeficit = 0) AS inv
  FROM days d CROSS JOIN (VALUES ('sales'), ('demand')) v(Variant)),
agg AS (
  SELECT ItemLocationId, Variant, max(LocationId) AS LocationId, max(ItemId) AS ItemId,
    max(ItemMeasure) AS ItemMeasure, max(Branch) AS Branch, max(ItemIdLevel2) AS ItemIdLevel2,
    max(ItemIdLevel3) AS ItemIdLevel3, max(LocationNetwork) AS LocationNetwork,
    max(LocationFormatTT) AS LocationFormatTT, max(Scope) AS Scope, max(Cohort) AS Cohort,
    max(OutlierStore) AS OutlierStore, max(IsEmpty) AS IsEmpty,
    min(TransDate) FILTER (InLife = 1) AS FirstActive,
    max(TransDate) FILTER (InLife = 1) AS LastActive,
    count(*) FILTER (ml) AS MatrixDays,
    CASE WHEN max(IsEmpty) = 1 THEN 0
         ELSE count(*) FILTER (IsMatrix = 1 AND InLife = 0) END AS MatrixDaysOutLife,
    count(*) AS SrcRows, sum(SalesQty) AS SalesQtyTotal, sum(SalesAmount) AS Revenue,
    coalesce(sum(SalesAmount) FILTER (IsMatrix = 0), 0) / nullif(sum(SalesAmount), 0)
      AS RevenueOutMatrixShare,
    sum(SalesAmount) FILTER (SalesQty > 0) / nullif(sum(SalesQty) FILTER (SalesQty > 0), 0)
      AS Price,
    count(*) FILTER (inv) AS VariantDays, count(*) FILTER (inv AND SalesQty > 0) AS SalesDays,
    sum(SalesQty) FILTER (inv) AS VariantQty,
    var_samp(SalesQty) FILTER (inv AND SalesQty > 0)
      / pow(avg(SalesQty) FILTER (inv AND SalesQty > 0), 2) AS Cv2,
    count(*) FILTER (ml AND IsDeficit = 1) AS DeficitDays,
    coalesce(sum(SalesQty) FILTER (ml AND IsDeficit = 1), 0)
      / nullif(sum(SalesQty) FILTER (ml), 0) AS DeficitSalesShare
  FROM var GROUP BY 1, 2),
ratios AS (
  SELECT *, datediff('day', FirstActive, LastActive) + 1 AS LifeDays,
    VariantQty / nullif(VariantDays, 0) AS SalesLevel,
    SalesDays / nullif(VariantDays, 0) AS SalesDayShare,
    1 - SalesDays / nullif(VariantDays, 0) AS ZeroShare,
    VariantDays / nullif(SalesDays, 0) AS Adi,
    DeficitDays / nullif(MatrixDays, 0) AS DeficitDayShare
  FROM agg),
profile AS (
  SELECT *, CASE WHEN Adi IS NULL OR Cv2 IS NULL THEN 'n/a'
                 WHEN Adi >= 1.32 AND Cv2 >= 0.49 THEN 'lumpy'
                 WHEN Adi >= 1.32 THEN 'intermittent' WHEN Cv2 >= 0.49 THEN 'erratic'
                 ELSE 'smooth' END AS Quadrant
  FROM ratios)"""

# name, metric, partition, needs matrix days
ABC_RULES = (
    ("AbcRevenueStore", "Revenue", "LocationId", False),
    ("AbcRevenueSubgroup", "Revenue", "LocationId, ItemIdLevel2", False),
    ("AbcQtyStore", "SalesQtyTotal", "LocationId, Branch", False),
    ("AbcQtySubgroup", "SalesQtyTotal", "LocationId, ItemIdLevel2, Branch", False),
    ("AbcFreqStore", "SalesDays", "LocationId", True),
    ("AbcFreqSubgroup", "SalesDays", "LocationId, ItemIdLevel2", True))


def abc_sql(source: str, prefix: str = "", extra: str = "") -> str:
    """CTEs `{prefix}abc` with the six classes from one row per pair of `source`."""
    metrics, sums, classes = [], [], []
    for name, metric, keys, matrix in ABC_RULES:
        applies = "IsEmpty = 0" + (" AND MatrixDays > 0" if matrix else "")
        metrics.append(f"CASE WHEN {applies} THEN CAST({metric} AS DECIMAL(38,10)) ELSE 0 END "
                       f"AS m_{name}, {applies} AS a_{name}")
        over = (f"PARTITION BY {extra}{keys} ORDER BY m_{name} DESC, rev DESC, ItemLocationId "
                "ROWS BETWEEN UNBOUNDED PRECEDING AND")
        sums.append(f"sum(m_{name}) OVER ({over} CURRENT ROW) AS c_{name}, "
                    f"sum(m_{name}) OVER ({over} UNBOUNDED FOLLOWING) AS t_{name}")
        share = (f"CAST(c_{name} - m_{name} AS DOUBLE) / CAST(t_{name} AS DOUBLE)")
        classes.append(f"CASE WHEN NOT a_{name} THEN 'n/a' WHEN t_{name} <= 0 OR m_{name} <= 0 "
                       f"THEN 'C' WHEN {share} < 0.80 THEN 'A' WHEN {share} < 0.95 THEN 'B' "
                       f"ELSE 'C' END AS {name}")
    return f""",
{prefix}abc_m AS (
  SELECT *, CAST(Revenue AS DECIMAL(38,10)) AS rev, {', '.join(metrics)} FROM {source}),
{prefix}abc_s AS (SELECT *, {', '.join(sums)} FROM {prefix}abc_m),
{prefix}abc AS (SELECT {extra}ItemLocationId, {', '.join(classes)} FROM {prefix}abc_s)"""


ABC = abc_sql("(SELECT * FROM profile WHERE Variant = 'sales') s")
ABC_NAMES = ", ".join(r[0] for r in ABC_RULES)
BASE = PROFILE + ABC + f""",
base AS (
  SELECT p.*, {', '.join('a.' + r[0] for r in ABC_RULES)}
  FROM profile p LEFT JOIN abc a ON a.ItemLocationId = p.ItemLocationId)"""

ARRAYS = """,
span AS (
  SELECT ItemLocationId, min(TransDate) AS FirstDay, max(TransDate) AS LastDay
  FROM days WHERE IsEmpty = 0 AND InLife = 1 GROUP BY 1),
grid AS (
  SELECT ItemLocationId, FirstDay, LastDay,
    CAST(unnest(generate_series(FirstDay, LastDay, INTERVAL 1 DAY)) AS DATE) AS TransDate
  FROM span),
positions AS (
  SELECT g.ItemLocationId, v.Variant, g.FirstDay, g.LastDay, g.TransDate,
    datediff('day', g.FirstDay, g.TransDate) AS Position,
    CASE v.Variant WHEN 'sales' THEN d.ValueSales ELSE d.ValueDemand END AS Value,
    coalesce(d.IsDeficit, 0) AS Deficit
  FROM grid g CROSS JOIN (VALUES ('sales'), ('demand')) v(Variant)
  LEFT JOIN days d ON d.ItemLocationId = g.ItemLocationId AND d.TransDate = g.TransDate)"""


def pivot_sql(keys: dict[str, str], block: list[str], measures: dict[str, str],
              shares: list[str], where: str, digits: dict[str, int]) -> str:
    """Pivot over `base`: header -> key expression, header -> aggregate."""
    extra = [h for h in keys if h not in block]
    names = ", ".join(f'"{h}"' for h in keys)
    blocks = ", ".join(f'"{h}"' for h in block)
    columns = ", ".join(f'{e} AS "{h}"' for h, e in keys.items())
    aggregates = ", ".join(f'{e} AS "{h}"' for h, e in measures.items())
    total = f'"{extra[0]}"'
    out = [f'"{h}" AS "{h}"' if h in block else
           f'CASE WHEN it = 1 THEN \'total\' ELSE CAST("{h}" AS VARCHAR) END AS "{h}"'
           for h in keys]
    for h in measures:
        out.append(f'round("{h}", {digits[h]}) AS "{h}"' if h in digits else f'"{h}"')
        if h in shares:
            out.append(f'round(100.0 * "{h}" / nullif("t_{h}", 0), 1) AS "{h}, %"')
    totals = "".join(f', sum(CASE WHEN it = 1 THEN "{h}" END) OVER (PARTITION BY {blocks}) '
                     f'AS "t_{h}"' for h in shares)
    return f""",
r AS (SELECT *, {columns} FROM base WHERE {where}),
g AS (SELECT {names}, grouping({total}) AS it, {aggregates} FROM r
      GROUP BY GROUPING SETS (({names}), ({blocks}))),
s AS (SELECT *{totals} FROM g)
SELECT {', '.join(out)} FROM s"""
