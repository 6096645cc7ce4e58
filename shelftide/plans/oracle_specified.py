"""Expected results of the queries behind the specified (later-stage) analyses."""

from __future__ import annotations

from shelftide.plans.oracle import (
    ABC_RULES, ARRAYS, BASE, EVENTS, LINEITEM, PROFILE, RAW_LINEITEM, abc_sql)
from shelftide.plans.oracle_queries import _check, _journal, _six

_VOLUME = """,
volume AS (
  SELECT TransDate, count(*) AS n, count(DISTINCT LocationId) AS s, count(DISTINCT ItemId) AS i
  FROM measured GROUP BY 1),
medians AS (
  SELECT TransDate, n / median(n) OVER w AS rn, s / median(s) OVER w AS rs,
    i / median(i) OVER w AS ri
  FROM volume WINDOW w AS (ORDER BY TransDate RANGE BETWEEN INTERVAL 28 DAY PRECEDING
                           AND INTERVAL 1 DAY PRECEDING)),
outside AS (
  SELECT TransDate FROM medians
  WHERE rn NOT BETWEEN 0.5 AND 1.5 OR rs NOT BETWEEN 0.5 AND 1.5 OR ri NOT BETWEEN 0.5 AND 1.5)"""

_CONTRACT = f"""WITH {RAW_LINEITEM}{_VOLUME},
cal AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31',
                                           INTERVAL 1 DAY)) AS DATE) AS d),
c AS (
  SELECT
    (SELECT count(*) FROM (SELECT 1 FROM measured GROUP BY TransDate, LocationId, ItemId
                           HAVING count(*) > 1)) AS dup,
    (SELECT count(*) FROM (SELECT 1 FROM measured GROUP BY LocationId, ItemId
                           HAVING count(DISTINCT ItemLocationId) > 1)) AS ids,
    (SELECT count(*) FROM (SELECT 1 FROM measured GROUP BY ItemLocationId
                           HAVING count(DISTINCT (LocationId, ItemId)) > 1)) AS places,
    (SELECT count(*) FROM cal WHERE d NOT IN (SELECT TransDate FROM measured)) AS days,
    (SELECT count(DISTINCT date_trunc('month', d)) FROM cal
     WHERE date_trunc('month', d) NOT IN (SELECT date_trunc('month', TransDate) FROM measured))
      AS months,
    (SELECT count(*) FROM (
       SELECT TransDate, StockStartQty, lag(StockEndQty) OVER w AS e, lag(TransDate) OVER w AS p
       FROM measured WINDOW w AS (PARTITION BY ItemLocationId ORDER BY TransDate))
     WHERE datediff('day', p, TransDate) = 1 AND abs(StockStartQty - e) > 1e-6) AS breaks,
    (SELECT count(*) FROM outside) AS vol,
    (SELECT count(*) FROM measured WHERE ItemMeasure NOT IN ('kg', 'pcs')) AS unknown,
    (SELECT count(*) FROM measured WHERE Qty < 0) AS neg,
    (SELECT count(*) FROM measured WHERE (Qty > 0) <> (Amount > 0)) AS odd)
{_journal([_check(f"'contract_{n}'", level, v) + ' FROM c' for n, level, v in (
    ("schema", "error", "0"), ("key_unique", "error", "dup"), ("key_filled", "error", "0"),
    ("pair_id", "error", "ids + places"), ("calendar", "error", "days + months"),
    ("top_group", "error", "0"), ("stock_continuity", "error", "breaks"),
    ("stock_not_negative", "error", "0"), ("attributes_filled", "error", "0"),
    ("item_constant", "warning", "0"), ("store_constant", "warning", "0"),
    ("measure_known", "warning", "unknown"), ("qty_not_negative", "warning", "neg"),
    ("qty_and_amount", "warning", "odd"), ("store_rollup", "warning", "0"),
    ("daily_volume", "warning", "vol"))])}"""

_FRONTIER = """,
obs AS (
  SELECT ItemLocationId, 'sales' AS Variant, Branch, ValueSales AS v FROM days
  WHERE ValueSales IS NOT NULL
  UNION ALL SELECT ItemLocationId, 'demand', Branch, ValueDemand FROM days
  WHERE ValueDemand IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ItemLocationId, Variant ORDER BY v) AS rn,
    count(*) OVER (PARTITION BY ItemLocationId, Variant) AS n FROM obs),
orders_q AS (
  SELECT ItemLocationId, Variant, q.q AS Q, min(v) FILTER (rn >= q.q * n) AS o
  FROM ranked CROSS JOIN (VALUES (0.40::DECIMAL(3,2)), (0.50), (0.60), (0.70), (0.80), (0.90),
                          (0.95)) q(q)
  GROUP BY 1, 2, 3),
frontier AS (
  SELECT r.ItemLocationId, r.Variant, Q, o AS OrderQty,
    count(*) FILTER (o - v >= CASE Branch WHEN 'kg' THEN 0.1 ELSE 1 END) AS AvailableDays,
    count(*) AS Days, sum(greatest(o - v, 0)) AS Leftover, o * count(*) AS Output,
    1 AS Lookahead
  FROM ranked r JOIN orders_q q ON q.ItemLocationId = r.ItemLocationId AND q.Variant = r.Variant
  GROUP BY r.ItemLocationId, r.Variant, Q, o)"""


def _curve(keys: str) -> str:
    return f"""
  SELECT {keys}, f.Variant, Q, sum(AvailableDays) AS AvailableDays, sum(Days) AS Days,
    sum(Leftover) AS Leftover, sum(Output) AS Output,
    sum(AvailableDays) / sum(Days) AS Availability,
    sum(Leftover) / nullif(sum(Output), 0) AS LeftoverShare
  FROM frontier f JOIN (SELECT * FROM base WHERE Variant = 'sales') b
    ON b.ItemLocationId = f.ItemLocationId
  GROUP BY ALL"""


_CUTS = "\n UNION ALL ".join(
    f"SELECT '{name}' AS Cut, * FROM ({_curve(f'b.Branch, {value} AS CutValue')})"
    for name, value in [("total", "CAST(NULL AS VARCHAR)"), *[(r[0], f"b.{r[0]}") for r in ABC_RULES],
                        ("ItemIdLevel2", "b.ItemIdLevel2"), ("LocationFormatTT", "b.LocationFormatTT")])

_OVERLAP = "\n UNION ALL ".join(
    f"SELECT Branch, '{a[0]}' AS RuleA, '{b[0]}' AS RuleB, "
    f"count(*) FILTER ({a[0]} = 'A' AND {b[0]} = 'A') AS \"Both\", "
    f"count(*) FILTER ({a[0]} = 'A' OR {b[0]} = 'A') AS Either "
    "FROM base WHERE Variant = 'sales' GROUP BY 1"
    for i, a in enumerate(ABC_RULES) for b in ABC_RULES[i + 1:])

_QUARTERS = f"""WITH {LINEITEM},
quarters AS (
  SELECT CAST(date_trunc('quarter', TransDate) AS DATE) AS Quarter, ItemLocationId,
    max(LocationId) AS LocationId, max(ItemIdLevel2) AS ItemIdLevel2, max(Branch) AS Branch,
    max(IsEmpty) AS IsEmpty, sum(SalesAmount) AS Revenue, sum(SalesQty) AS SalesQtyTotal,
    count(*) FILTER (IsMatrix = 1 AND InLife = 1) AS MatrixDays,
    count(*) FILTER (IsMatrix = 1 AND InLife = 1 AND SalesQty > 0) AS SalesDays
  FROM days GROUP BY 1, 2){abc_sql('quarters', 'q', 'Quarter, ')},
moves AS (
  SELECT a.AbcRevenueStore AS f, b.AbcRevenueStore AS t, a.AbcQtyStore AS fq, b.AbcQtyStore AS tq
  FROM qabc a JOIN qabc b ON b.ItemLocationId = a.ItemLocationId
    AND b.Quarter = a.Quarter + INTERVAL 3 MONTH)"""

SPECIFIED: dict[str, str] = {
    "raw_contract": _CONTRACT,
    "daily_volume_outliers": f"WITH {RAW_LINEITEM}{_VOLUME} SELECT * FROM outside",
    "order_frontier": f"""WITH {LINEITEM}{_FRONTIER}
SELECT ItemLocationId, Variant, Q, AvailableDays, Days, Lookahead,
  {_six('OrderQty', 'Leftover', 'Output')} FROM frontier""",
    "frontier_curve": f"""WITH {LINEITEM}{BASE}{_FRONTIER},
curve AS ({_curve('b.Branch, b.AbcRevenueStore')})
SELECT Branch, AbcRevenueStore, Variant, Q, AvailableDays, Days,
  {_six('Leftover', 'Output', 'Availability', 'LeftoverShare')} FROM curve""",
    "frontier_cuts": f"""WITH {LINEITEM}{BASE}{_FRONTIER},
cuts AS ({_CUTS})
SELECT Branch, Cut, CutValue, Variant, Q, AvailableDays, Days,
  {_six('Leftover', 'Output', 'Availability', 'LeftoverShare')} FROM cuts""",
    "frontier_actual": f"""WITH {LINEITEM},
a AS (
  SELECT Branch, LocationNetwork, count(*) AS Days,
    count(*) FILTER (StockEndQty >= CASE Branch WHEN 'kg' THEN 0.1 ELSE 1 END) AS AvailableDays,
    sum(StockEndQty) AS Leftover, sum(SalesQty + StockEndQty) AS Output
  FROM days WHERE IsMatrix = 1 AND InLife = 1 GROUP BY 1, 2),
p AS (SELECT *, AvailableDays / Days AS Availability,
        Leftover / nullif(Output, 0) AS LeftoverShare FROM a)
SELECT Branch, LocationNetwork, Days, AvailableDays,
  {_six('Leftover', 'Output', 'Availability', 'LeftoverShare')} FROM p""",
    "frontier_targets": f"""WITH {LINEITEM}{PROFILE}, base AS (SELECT * FROM profile){_FRONTIER},
curve AS ({_curve('b.Branch, b.Scope')}),
best AS (
  SELECT Branch, Scope, Variant, t.t AS Target, min(Q) FILTER (Availability >= t.t) AS Q,
    arg_min(LeftoverShare, Q) FILTER (Availability >= t.t) AS LeftoverShare
  FROM curve CROSS JOIN (VALUES (0.35::DOUBLE), (0.50), (0.75), (0.80)) t(t)
  GROUP BY 1, 2, 3, 4)
SELECT Branch, Scope, Variant, {_six('Target')}, Q, {_six('LeftoverShare')} FROM best""",
    "abc_top_overlap": f"""WITH {LINEITEM}{BASE}, o AS ({_OVERLAP}),
j AS (SELECT *, "Both" / nullif(Either, 0) AS Jaccard FROM o)
SELECT Branch, RuleA, RuleB, "Both", Either, {_six('Jaccard')} FROM j""",
    "abc_store_agreement": f"""WITH {LINEITEM}{BASE},
k AS (SELECT ItemId, AbcRevenueStore AS c, CAST(count(*) AS DOUBLE) AS n FROM base
      WHERE Variant = 'sales' AND AbcRevenueStore <> 'n/a' GROUP BY 1, 2),
e AS (SELECT ItemId, CAST(sum(n) AS BIGINT) AS Stores, max(n) / sum(n) AS ModalShare,
        log2(sum(n)) - sum(n * log2(n)) / sum(n) AS Entropy FROM k GROUP BY 1)
SELECT ItemId, Stores, {_six('ModalShare', 'Entropy')} FROM e""",
    "abc_quarter_transitions": f"""{_QUARTERS}
SELECT f AS FromClass, t AS ToClass, count(*) AS Pairs FROM moves
WHERE f <> 'n/a' AND t <> 'n/a' GROUP BY 1, 2""",
    "abc_quarter_association": f"""{_QUARTERS},
x AS (SELECT fq, tq, count(*) AS n FROM moves WHERE fq <> 'n/a' AND tq <> 'n/a' GROUP BY 1, 2),
y AS (SELECT *, sum(n) OVER (PARTITION BY fq) AS r, sum(n) OVER (PARTITION BY tq) AS c FROM x),
z AS (SELECT sum(n) AS Pairs,
        sqrt((sum(n * n / (r * c)) - 1)
             / nullif(least(count(DISTINCT fq), count(DISTINCT tq)) - 1, 0)) AS CramersV FROM y)
SELECT Pairs, {_six('CramersV')} FROM z""",
}

# Exact quantile of a sorted list: the element at position floor(q * n), counted from 0.
def _pick(values: str, q: float) -> str:
    return f"{values}[least(CAST(floor({q} * len({values})) AS INTEGER) + 1, len({values}))]"


_BACKTEST = f""",
origins AS (SELECT k, DATE '2024-01-18' + CAST(k AS INTEGER) AS Origin
            FROM generate_series(0, 9) g(k)),
targets AS (SELECT h FROM generate_series(1, 7) g(h)),
hist AS (
  SELECT s.ItemLocationId, v.Variant, o.Origin,
    list_sort(coalesce(list(p.Value) FILTER (p.Value IS NOT NULL), [])) AS l
  FROM span s CROSS JOIN (VALUES ('sales'), ('demand')) v(Variant) CROSS JOIN origins o
  LEFT JOIN positions p ON p.ItemLocationId = s.ItemLocationId AND p.Variant = v.Variant
    AND p.TransDate BETWEEN o.Origin - 14 AND o.Origin - 1
  GROUP BY 1, 2, 3),
dow AS (
  SELECT x.ItemLocationId, x.Variant, x.Origin, t.h AS Horizon,
    list_sort(coalesce(list(p.Value) FILTER (p.Value IS NOT NULL), [])) AS d
  FROM hist x CROSS JOIN targets t
  LEFT JOIN positions p ON p.ItemLocationId = x.ItemLocationId AND p.Variant = x.Variant
    AND p.TransDate BETWEEN x.Origin - 14 AND x.Origin - 1
    AND datediff('day', p.TransDate, x.Origin + CAST(t.h - 1 AS INTEGER)) % 7 = 0
  GROUP BY 1, 2, 3, 4),
fc AS (
  SELECT x.ItemLocationId, x.Variant, x.Origin, w.Horizon, CAST(len(l) AS BIGINT) AS HistoryDays,
    x.Origin - 1 AS LastUsed,
    CASE WHEN len(l) >= 4 THEN list_sum(l) / len(l) END AS Mean,
    CASE WHEN len(l) >= 4 THEN {_pick('l', 0.5)} END AS Median,
    CASE WHEN len(l) >= 4 THEN {_pick('d', 0.5)} END AS MedianDow,
    CASE WHEN len(l) >= 4 THEN {_pick('l', 0.5)} END AS Q0,
    CASE WHEN len(l) >= 4 THEN {_pick('l', 0.8)} END AS Q1,
    CASE WHEN len(l) >= 4 THEN {_pick('l', 0.9)} END AS Q2, a.Value AS Actual
  FROM hist x JOIN dow w ON w.ItemLocationId = x.ItemLocationId AND w.Variant = x.Variant
    AND w.Origin = x.Origin
  LEFT JOIN positions a ON a.ItemLocationId = x.ItemLocationId AND a.Variant = x.Variant
    AND a.TransDate = x.Origin + CAST(w.Horizon - 1 AS INTEGER)),
scored AS (SELECT * FROM fc WHERE Actual IS NOT NULL AND Mean IS NOT NULL)"""

_ERRORS = "\n UNION ALL ".join(
    [f"SELECT ItemLocationId, Variant, Horizon, '{m}' AS Model, count({c}) AS Days, "
     f"coalesce(sum(Actual) FILTER ({c} IS NOT NULL), 0) AS Actual, "
     f"coalesce(sum(abs(Actual - {c})), 0) AS AbsError, CAST(NULL AS DOUBLE) AS Pinball "
     f"FROM scored GROUP BY 1, 2, 3" for m, c in (
         ("mean", "Mean"), ("median", "Median"), ("median_dow", "MedianDow"))]
    + [f"SELECT ItemLocationId, Variant, Horizon, 'q{q}', count(*), sum(Actual), NULL, "
       f"sum(greatest((Actual - Q{i}) * {q}, (Actual - Q{i}) * ({q} - 1))) "
       f"FROM scored GROUP BY 1, 2, 3" for i, q in enumerate((0.5, 0.8, 0.9))])

_EVENT_SERIES = f"WITH {EVENTS}{ARRAYS}"

_ETA = """,
w AS (
  SELECT ItemLocationId, Variant, dayofweek(TransDate) AS wd, count(Value) AS n, sum(Value) AS s,
    sum(Value * Value) AS q FROM positions WHERE Value IS NOT NULL GROUP BY 1, 2, 3),
t AS (
  SELECT ItemLocationId, Variant, CAST(sum(n) AS BIGINT) AS Points, sum(q) AS q,
    sum(s * s / n) AS b, sum(s) * sum(s) / sum(n) AS l FROM w GROUP BY 1, 2),
e AS (SELECT *, CASE WHEN q - l > 1e-9 * q THEN (b - l) / (q - l) END AS WeekdayShare FROM t)"""

_LAGS = """,
both_k AS (
  SELECT a.ItemLocationId, a.Variant, k.k, a.Value AS x, b.Value AS y
  FROM positions a CROSS JOIN (VALUES (0), (1), (7)) k(k)
  LEFT JOIN positions b ON b.ItemLocationId = a.ItemLocationId AND b.Variant = a.Variant
    AND b.TransDate = a.TransDate - k.k AND b.Value IS NOT NULL
  WHERE a.Value IS NOT NULL OR k.k = 0),
lag_k AS (
  SELECT ItemLocationId, Variant, k, count(y) AS n,
    CASE WHEN var_samp(x) FILTER (y IS NOT NULL) * var_samp(y) > 0 THEN
      covar_samp(x, y) / sqrt(var_samp(x) FILTER (y IS NOT NULL) * var_samp(y)) END AS c,
    var_samp(x - y) AS d,
    sum(abs(x - y)) / nullif(sum(x) FILTER (y IS NOT NULL), 0) AS w
  FROM both_k GROUP BY 1, 2, 3),
pair_ids AS (SELECT DISTINCT ItemLocationId FROM days WHERE ValueSales IS NOT NULL),
lags AS (
  SELECT p.ItemLocationId, v.Variant, coalesce(a.n, 0) AS Pairs1, coalesce(b.n, 0) AS Pairs7,
    a.c AS Acf1, b.c AS Acf7, b.d / nullif(7 * a.d, 0) AS VarianceRatio7, a.w AS NaiveWape,
    b.w AS SeasonalWape
  FROM pair_ids p CROSS JOIN (VALUES ('sales'), ('demand')) v(Variant)
  LEFT JOIN lag_k a ON a.ItemLocationId = p.ItemLocationId AND a.Variant = v.Variant AND a.k = 1
  LEFT JOIN lag_k b ON b.ItemLocationId = p.ItemLocationId AND b.Variant = v.Variant
    AND b.k = 7)"""

_PATTERNS = """,
three AS (
  SELECT ItemLocationId, Variant, Value AS x2, TransDate - 2 = lag(TransDate, 2) OVER w AS ok,
    lag(Value, 2) OVER w AS x0, lag(Value, 1) OVER w AS x1
  FROM positions WINDOW w AS (PARTITION BY ItemLocationId, Variant ORDER BY TransDate)),
pattern AS (
  SELECT ItemLocationId, Variant, concat(
      CASE WHEN x0 <= x1 AND x0 <= x2 THEN '0' WHEN x1 < x0 AND x1 <= x2 THEN '1' ELSE '2' END,
      CASE WHEN (x0 <= x1) <> (x0 <= x2) THEN '0' WHEN (x1 < x0) <> (x1 <= x2) THEN '1'
           ELSE '2' END) AS p, CAST(count(*) AS DOUBLE) AS n
  FROM three WHERE ok AND x0 IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL GROUP BY 1, 2, 3),
share AS (SELECT *, n / sum(n) OVER (PARTITION BY ItemLocationId, Variant) AS p_ FROM pattern),
pe AS (
  SELECT ItemLocationId, Variant, CAST(sum(n) AS BIGINT) AS Windows, count(*) AS Patterns,
    -sum(p_ * ln(p_)) AS s, -sum((p_ / 2 + 1 / 12) * ln(p_ / 2 + 1 / 12))
      - (6 - count(*)) * (1 / 12 * ln(1 / 12)) AS m
  FROM share GROUP BY 1, 2),
pec AS (SELECT *, abs(s) / ln(6) AS Entropy,
          -2 / (7 / 6 * ln(7) - 2 * ln(12) + ln(6)) * (m - s / 2 - ln(6) / 2) * abs(s) / ln(6)
            AS Complexity FROM pe)"""

_CLASSES = """,
cls AS (
  SELECT *, CASE WHEN coalesce(VariantDays, 0) < 4 THEN 'n/a' WHEN ZeroShare >= 0.6
    THEN 'no structure' WHEN Quadrant = 'smooth' THEN 'level' WHEN Cv2 >= 0.49 THEN 'jumpy'
    ELSE 'mixed' END AS Class FROM profile),
shares AS (
  SELECT Branch, Class, count(*) AS Pairs, sum(Revenue) AS Revenue,
    sum(Revenue) / sum(sum(Revenue)) OVER (PARTITION BY Branch) AS RevenueShare
  FROM cls WHERE Variant = 'sales' GROUP BY 1, 2)"""

_RANK_ROWS = f"WITH {LINEITEM}{PROFILE}, r AS (SELECT * FROM profile WHERE Variant = 'sales')"


def _percent_ranks(measures: list[str]) -> str:
    return ", ".join(
        f"CASE WHEN {m} IS NOT NULL THEN percent_rank() OVER (PARTITION BY Branch, {m} IS NULL "
        f"ORDER BY {m}) END AS r_{m}" for m in measures)


_MEASURES = ["Adi", "Cv2", "DeficitDayShare"]

_MEASURED = f"""{_EVENT_SERIES}{PROFILE}{_BACKTEST}, er AS ({_ERRORS}),
eg AS (SELECT ItemLocationId, sum(Actual) AS Actual, sum(AbsError) AS AbsError FROM er
       WHERE Variant = 'sales' AND Model = 'mean' AND Horizon BETWEEN 2 AND 3 GROUP BY 1),
me AS (SELECT p.Branch, p.ItemLocationId, round(p.ZeroShare, 9) AS ZeroShare, Actual, AbsError,
         round(AbsError / nullif(Actual, 0), 9) AS Wape
       FROM profile p JOIN eg ON eg.ItemLocationId = p.ItemLocationId WHERE p.Variant = 'sales')"""

_WEIGHTED_RANKS = f"""m AS (
  SELECT Branch, CAST(w AS DOUBLE) AS w,
    CAST(sum(w) OVER (PARTITION BY Branch ORDER BY x RANGE BETWEEN UNBOUNDED PRECEDING
                      AND CURRENT ROW) AS DOUBLE)
      - CAST(sum(w) OVER (PARTITION BY Branch, x) AS DOUBLE) / 2 AS rx,
    CAST(sum(w) OVER (PARTITION BY Branch ORDER BY y RANGE BETWEEN UNBOUNDED PRECEDING
                      AND CURRENT ROW) AS DOUBLE)
      - CAST(sum(w) OVER (PARTITION BY Branch, y) AS DOUBLE) / 2 AS ry FROM k),
c AS (
  SELECT Branch, count(*) AS "Rows",
    (sum(w) * sum(w * rx * ry) - sum(w * rx) * sum(w * ry))
    / CASE WHEN sum(w) * sum(w * rx * rx) - sum(w * rx) * sum(w * rx)
                  > 1e-12 * sum(w) * sum(w * rx * rx)
             AND sum(w) * sum(w * ry * ry) - sum(w * ry) * sum(w * ry)
                  > 1e-12 * sum(w) * sum(w * ry * ry)
      THEN sqrt((sum(w) * sum(w * rx * rx) - sum(w * rx) * sum(w * rx))
                * (sum(w) * sum(w * ry * ry) - sum(w * ry) * sum(w * ry))) END AS Correlation
  FROM m GROUP BY 1)
SELECT Branch, "Rows", {_six('Correlation')} FROM c"""

SPECIFIED |= {
    "baseline_forecasts": f"""{_EVENT_SERIES}{_BACKTEST}
SELECT ItemLocationId, Variant, Origin, Horizon, HistoryDays, LastUsed,
  {_six('Mean', 'Median', 'MedianDow', 'Q0', 'Q1', 'Q2', 'Actual')} FROM fc""",
    "baseline_errors": f"""{_EVENT_SERIES}{_BACKTEST}, er AS ({_ERRORS}),
er2 AS (SELECT *, AbsError / nullif(Actual, 0) AS Wape FROM er)
SELECT ItemLocationId, Variant, Horizon, Model, Days,
  {_six('Actual', 'AbsError', 'Pinball', 'Wape')} FROM er2""",
    "error_by_horizon_group": f"""{_EVENT_SERIES}{_BACKTEST}, er AS ({_ERRORS}),
hg AS (
  SELECT p.LocationNetwork, Variant, Model,
    CASE WHEN Horizon BETWEEN 2 AND 3 THEN '2-3' ELSE '5-7' END AS Horizons,
    CAST(sum(Days) AS BIGINT) AS Days, sum(Actual) AS Actual, sum(AbsError) AS AbsError,
    sum(Pinball) AS Pinball
  FROM er JOIN pairs p ON p.ItemLocationId = er.ItemLocationId
  WHERE Horizon BETWEEN 2 AND 3 OR Horizon BETWEEN 5 AND 7 GROUP BY 1, 2, 3, 4),
hw AS (SELECT *, AbsError / nullif(Actual, 0) AS Wape FROM hg)
SELECT LocationNetwork, Variant, Model, Horizons, Days,
  {_six('Actual', 'AbsError', 'Pinball', 'Wape')} FROM hw""",
    "measure_error_rank": f"""{_MEASURED},
k AS (SELECT Branch, ZeroShare AS x, Wape AS y, CAST(Actual AS DECIMAL(38,10)) AS w FROM me
      WHERE ZeroShare IS NOT NULL AND Wape IS NOT NULL AND Actual > 0),
{_WEIGHTED_RANKS}""",
    "measure_error_deciles": f"""{_MEASURED},
k AS (SELECT *, CAST(Actual AS DECIMAL(38,10)) AS w FROM me
      WHERE ZeroShare IS NOT NULL AND Actual > 0),
d AS (
  SELECT *, CAST(ceil(
      CAST(sum(w) OVER (PARTITION BY Branch ORDER BY ZeroShare, ItemLocationId
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) * 10
      / CAST(sum(w) OVER (PARTITION BY Branch) AS DOUBLE)) AS INTEGER) AS Decile FROM k),
s AS (
  SELECT Branch, Decile, count(*) AS Series, min(ZeroShare) AS LowMeasure,
    max(ZeroShare) AS HighMeasure, sum(Actual) AS Actual, sum(AbsError) AS AbsError,
    sum(AbsError) / nullif(sum(Actual), 0) AS Wape FROM d GROUP BY 1, 2)
SELECT Branch, Decile, Series, {_six('LowMeasure', 'HighMeasure', 'Actual', 'AbsError', 'Wape')}
FROM s""",
    "weekday_significance": f"""{_EVENT_SERIES}{_ETA},
wd7 AS (SELECT ItemLocationId, Variant FROM w GROUP BY 1, 2 HAVING count(*) = 7),
br AS (SELECT ItemLocationId, max(Branch) AS Branch FROM days GROUP BY 1),
z AS (SELECT e.ItemLocationId, Branch, greatest(0.0, least(1.0, WeekdayShare)) AS s,
        (Points - 7) / 2.0 AS a
      FROM e JOIN wd7 ON wd7.ItemLocationId = e.ItemLocationId AND wd7.Variant = e.Variant
      JOIN br ON br.ItemLocationId = e.ItemLocationId
      WHERE e.Variant = 'sales' AND Points > 7 AND WeekdayShare IS NOT NULL),
t7 AS (SELECT Branch, round(pow(1 - s, a) * (1 + a * s + a * (a + 1) * s * s / 2), 9) AS P FROM z),
r7 AS (SELECT *, count(*) OVER (PARTITION BY Branch ORDER BY P RANGE BETWEEN UNBOUNDED PRECEDING
                                AND CURRENT ROW) AS rank,
         count(*) OVER (PARTITION BY Branch) AS m FROM t7),
c7 AS (SELECT Branch, max(P) FILTER (P <= 0.2 * rank / m) AS cut FROM r7 GROUP BY 1),
s7 AS (SELECT t7.Branch, count(*) AS Series, count(*) FILTER (P <= cut) AS SignificantSeries,
         min(P) AS SmallestP FROM t7 JOIN c7 ON c7.Branch = t7.Branch GROUP BY 1)
SELECT Branch, Series, SignificantSeries, {_six('SmallestP')} FROM s7""",
    "baseline_calibration": f"""{_EVENT_SERIES}{_BACKTEST},
cal AS (
  SELECT ItemId, Variant, Horizon, count(*) AS Days,
    avg(CASE WHEN Actual <= Q0 THEN 1.0 ELSE 0.0 END) AS Coverage0,
    avg(CASE WHEN Actual <= Q1 THEN 1.0 ELSE 0.0 END) AS Coverage1,
    avg(CASE WHEN Actual <= Q2 THEN 1.0 ELSE 0.0 END) AS Coverage2,
    sum(Mean - Actual) / nullif(sum(Actual), 0) AS Bias
  FROM scored s JOIN pairs p ON p.ItemLocationId = s.ItemLocationId GROUP BY 1, 2, 3)
SELECT ItemId, Variant, Horizon, Days, {_six('Coverage0', 'Coverage1', 'Coverage2', 'Bias')}
FROM cal""",
    "check_forecasts": f"""{_EVENT_SERIES}{_BACKTEST},
o AS (SELECT ItemLocationId, Variant, Origin, count(*) AS n, max(Mean IS NULL) AS short
      FROM fc GROUP BY 1, 2, 3)
{_journal([
    _check("'forecast_no_leakage'", "error", "count(*) FILTER (LastUsed >= Origin)")
    + " FROM fc",
    _check("'forecast_not_negative'", "error",
           "count(*) FILTER (least(Mean, Median, MedianDow, Q0, Q1, Q2) < 0)") + " FROM fc",
    _check("'forecast_quantiles_monotone'", "error", "count(*) FILTER (Q0 > Q1 OR Q1 > Q2)")
    + " FROM fc",
    _check("'forecast_full_horizon'", "error", "count(*) FILTER (n <> 7)") + " FROM o",
    _check("'forecast_short_history'", "warning", "count(*) FILTER (short)") + " FROM o"])}""",
    "weekday_strength": f"""{_EVENT_SERIES}{_ETA}
SELECT ItemLocationId, Variant, Points, {_six('WeekdayShare')} FROM e""",
    "lag_measures": f"""{_EVENT_SERIES}{_LAGS}
SELECT ItemLocationId, Variant, Pairs1, Pairs7,
  {_six('Acf1', 'Acf7', 'VarianceRatio7', 'NaiveWape', 'SeasonalWape')} FROM lags""",
    "permutation_entropy": f"""{_EVENT_SERIES}{_PATTERNS}
SELECT ItemLocationId, Variant, Windows, Patterns, {_six('Entropy', 'Complexity')} FROM pec""",
    "rank_correlation": f"""{_RANK_ROWS},
k AS (SELECT Branch, ZeroShare AS x, DeficitDayShare AS y,
        CAST(SalesQtyTotal AS DECIMAL(38,10)) AS w FROM r
      WHERE ZeroShare IS NOT NULL AND DeficitDayShare IS NOT NULL AND SalesQtyTotal > 0),
{_WEIGHTED_RANKS}""",
    "volume_deciles": f"""{_RANK_ROWS},
k AS (SELECT *, CAST(SalesQtyTotal AS DECIMAL(38,10)) AS w,
        coalesce(DeficitSalesShare * VariantQty, 0) AS DeficitQty FROM r
      WHERE ZeroShare IS NOT NULL AND SalesQtyTotal > 0),
d AS (
  SELECT *, CAST(ceil(
      CAST(sum(w) OVER (PARTITION BY Branch, Quadrant ORDER BY ZeroShare, ItemLocationId
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) * 10
      / CAST(sum(w) OVER (PARTITION BY Branch, Quadrant) AS DOUBLE)) AS INTEGER) AS Decile
  FROM k),
s AS (
  SELECT Branch, Quadrant, Decile, count(*) AS Series, min(ZeroShare) AS LowMeasure,
    max(ZeroShare) AS HighMeasure, sum(VariantQty) AS Actual, sum(DeficitQty) AS AbsError,
    sum(DeficitQty) / nullif(sum(VariantQty), 0) AS Wape FROM d GROUP BY 1, 2, 3)
SELECT Branch, Quadrant, Decile, Series,
  {_six('LowMeasure', 'HighMeasure', 'Actual', 'AbsError', 'Wape')} FROM s""",
    "measure_correlations": f"""{_RANK_ROWS},
m AS (SELECT Branch, {', '.join(f'round({m}, 9) AS {m}' for m in _MEASURES)} FROM r),
p AS (SELECT Branch, {_percent_ranks(_MEASURES)} FROM m),
c AS ({' UNION ALL '.join(
    f"SELECT Branch, '{a}' AS MeasureA, '{b}' AS MeasureB, corr(r_{a}, r_{b}) AS Correlation "
    "FROM p GROUP BY 1" for i, a in enumerate(_MEASURES) for b in _MEASURES[i + 1:])})
SELECT Branch, MeasureA, MeasureB, {_six('Correlation')} FROM c""",
    "predictability_classes": f"""WITH {LINEITEM}{PROFILE}{_CLASSES}
SELECT Branch, Class, Pairs, round(Revenue, 2) AS Revenue, {_six('RevenueShare')} FROM shares""",
    "class_decisions": f"""WITH {LINEITEM}{BASE}, profile_classes AS (
  SELECT Branch, AbcRevenueStore = 'A' AS top, CAST(round(Revenue, 2) AS DECIMAL(38,2)) AS rev,
    CASE WHEN coalesce(VariantDays, 0) < 4 THEN 'n/a' WHEN ZeroShare >= 0.6 THEN 'no structure'
         WHEN Quadrant = 'smooth' THEN 'level' WHEN Cv2 >= 0.49 THEN 'jumpy' ELSE 'mixed' END AS Class
  FROM base WHERE Variant = 'sales'),
k AS (SELECT Branch, Class, count(*) AS Pairs, sum(rev) AS a, coalesce(sum(rev) FILTER (top), 0) AS t,
        coalesce(sum(rev) FILTER (NOT top), 0) AS u FROM profile_classes GROUP BY 1, 2),
s AS (SELECT Branch, Class, CASE Class WHEN 'no structure' THEN 'stock rule' WHEN 'level' THEN 'simple model'
        WHEN 'jumpy' THEN 'own model' WHEN 'mixed' THEN 'calendar model' ELSE 'n/a' END AS Decision, Pairs,
        Pairs / sum(Pairs) OVER b AS PairShare, CAST(a AS DOUBLE) / CAST(sum(a) OVER b AS DOUBLE) AS RevenueShare,
        CAST(t AS DOUBLE) / nullif(CAST(sum(t) OVER b AS DOUBLE), 0) AS TopShare,
        CAST(u AS DOUBLE) / nullif(CAST(sum(u) OVER b AS DOUBLE), 0) AS TailShare
      FROM k WINDOW b AS (PARTITION BY Branch))
SELECT Branch, Class, Decision, Pairs, {_six('PairShare', 'RevenueShare', 'TopShare', 'TailShare')} FROM s""",
    "check_classes": f"""WITH {LINEITEM}{PROFILE}{_CLASSES}
{_journal([
    _check("'class_revenue_share'", "error",
           "count(*) FILTER (Class <> 'n/a' AND RevenueShare < 0.03)") + " FROM shares",
    _check("'class_assigned'", "error",
           "count(*) FILTER (VariantDays >= 4 AND Class = 'n/a')") + " FROM cls"])}""",
    "stratified_sample_cells": f"""{_RANK_ROWS}
SELECT Quadrant, Branch, count(*) AS Series, least(count(*), 25) AS Sampled FROM r
GROUP BY 1, 2""",
    "stratified_sample_series": f"""{_RANK_ROWS}
SELECT ItemLocationId, Quadrant, Branch FROM r QUALIFY row_number() OVER (
  PARTITION BY Quadrant, Branch
  ORDER BY md5(concat('41:', ItemLocationId)), ItemLocationId) <= 25""",
}

_CORR = ("CASE WHEN sqrt(var_samp({x}) * var_samp({y})) > 1e-9 "
         "THEN covar_samp({x}, {y}) / sqrt(var_samp({x}) * var_samp({y})) END")

_WEEK = "CAST(floor(datediff('day', DATE '1970-01-05', TransDate) / 7) AS INTEGER)"

_TREND = f""",
wk AS (SELECT ItemLocationId, {_WEEK} AS w, sum(ValueSales) AS q FROM days
       WHERE ValueSales IS NOT NULL GROUP BY 1, 2),
nw AS (SELECT ItemLocationId, count(*) AS Weeks FROM wk GROUP BY 1 HAVING count(*) >= 3),
tr AS (
  SELECT a.ItemLocationId, max(Weeks) AS Weeks,
    sum(sign(b.q - a.q)) / nullif(sqrt(CAST(count(*) AS DOUBLE)
      * count(*) FILTER (b.q <> a.q)), 0) AS Tau,
    median((b.q - a.q) / (b.w - a.w)) AS SenSlope, sum(sign(b.q - a.q)) AS s
  FROM wk a JOIN wk b ON b.ItemLocationId = a.ItemLocationId AND b.w > a.w
  JOIN nw n ON n.ItemLocationId = a.ItemLocationId GROUP BY 1),
eq AS (SELECT ItemLocationId, sum(t * (t - 1) * (2 * t + 5)) AS ties FROM (
         SELECT ItemLocationId, q, CAST(count(*) AS DOUBLE) AS t FROM wk GROUP BY 1, 2) GROUP BY 1),
dt AS (SELECT wk.ItemLocationId, w, round(q - SenSlope * (w - min(w) OVER (PARTITION BY wk.ItemLocationId)), 9) AS d,
         CAST(Weeks AS DOUBLE) AS n FROM wk JOIN tr ON tr.ItemLocationId = wk.ItemLocationId),
rk AS (SELECT ItemLocationId, n, row_number() OVER (PARTITION BY ItemLocationId ORDER BY w) AS i,
         rank() OVER (PARTITION BY ItemLocationId ORDER BY d)
           + (count(*) OVER (PARTITION BY ItemLocationId, d) - 1) / 2.0 - (n + 1) / 2.0 AS c FROM dt),
ss AS (SELECT ItemLocationId, sum(c * c) AS v FROM rk GROUP BY 1),
ac AS (SELECT a.ItemLocationId, b.i - a.i AS k, max(a.n) AS n, sum(a.c * b.c) / nullif(max(v), 0) AS r
       FROM rk a JOIN rk b ON b.ItemLocationId = a.ItemLocationId AND b.i > a.i
       JOIN ss ON ss.ItemLocationId = a.ItemLocationId GROUP BY 1, 2),
hr AS (SELECT ItemLocationId, coalesce(sum((n - k) * (n - k - 1) * (n - k - 2) * r)
         FILTER (abs(r) > 1.96 / sqrt(n)), 0) AS h FROM ac GROUP BY 1),
zz AS (SELECT tr.*, s - sign(s) AS z, (Weeks * (Weeks - 1) * (2.0 * Weeks + 5) - ties) / 18.0 AS v0,
         (Weeks * (Weeks - 1) * (2.0 * Weeks + 5) - ties) / 18.0
           * (1 + 2 * h / (CAST(Weeks AS DOUBLE) * (Weeks - 1) * (Weeks - 2))) AS v1
       FROM tr JOIN eq ON eq.ItemLocationId = tr.ItemLocationId JOIN hr ON hr.ItemLocationId = tr.ItemLocationId),
zc AS (SELECT ItemLocationId, Weeks, Tau, SenSlope, CASE WHEN v0 > 0 THEN z / sqrt(v0) END AS Z,
         CASE WHEN v1 > 0 THEN z / sqrt(v1) END AS ZCorrected FROM zz)"""

_RAMP = """,
born AS (SELECT ItemLocationId, min(TransDate) AS b FROM days WHERE InLife = 1 GROUP BY 1),
wk AS (SELECT d.ItemLocationId, SalesQty,
         CAST(floor(datediff('day', b, TransDate) / 7) AS INTEGER) AS w
       FROM days d JOIN born ON born.ItemLocationId = d.ItemLocationId
       WHERE IsEmpty = 0 AND InLife = 1),
lived AS (SELECT ItemLocationId FROM wk GROUP BY 1 HAVING max(w) >= 15),
sums AS (SELECT l.ItemLocationId, g.w + 1 AS w,
           coalesce(sum(SalesQty), 0) AS q
         FROM lived l CROSS JOIN generate_series(0, 15) g(w)
         LEFT JOIN wk ON wk.ItemLocationId = l.ItemLocationId AND wk.w = g.w GROUP BY 1, 2),
mv AS (SELECT ItemLocationId, w, avg(q) OVER (PARTITION BY ItemLocationId ORDER BY w
         ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS m,
         avg(q) FILTER (w >= 9) OVER (PARTITION BY ItemLocationId) AS lv FROM sums),
st AS (SELECT ItemLocationId, max(lv) AS Level,
         coalesce(max(w) FILTER (w >= 4 AND abs(m - lv) > 0.25 * lv), 3) + 1 AS s
       FROM mv GROUP BY 1)"""

_OTHERS = """,
rest AS (
  SELECT *, CASE WHEN count(*) OVER (PARTITION BY TransDate, LocationId) > 1 THEN
      sum(SalesAmount) OVER (PARTITION BY TransDate, LocationId) - SalesAmount END AS sr,
    CASE WHEN count(*) OVER g > 1 THEN sum(SalesQty) OVER g - SalesQty END AS gr
  FROM days WINDOW g AS (PARTITION BY TransDate, LocationId, ItemIdLevel2, Branch)),
known AS (SELECT * FROM rest WHERE ValueSales IS NOT NULL AND sr IS NOT NULL
          AND gr IS NOT NULL)"""

_SPECIAL = """,
k AS (SELECT *, CASE TransDate WHEN DATE '2024-01-01' THEN 'holiday'
        WHEN DATE '2024-01-15' THEN 'mid month' END AS DayType
      FROM days WHERE ValueSales IS NOT NULL),
u AS (SELECT a.Branch, a.DayType, a.ItemLocationId, a.TransDate, max(a.ValueSales) AS v,
        avg(b.ValueSales) AS u
      FROM k a JOIN k b ON b.ItemLocationId = a.ItemLocationId AND b.DayType IS NULL
        AND datediff('day', a.TransDate, b.TransDate) % 7 = 0
        AND abs(datediff('day', a.TransDate, b.TransDate)) <= 28
      WHERE a.DayType IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING avg(b.ValueSales) > 0)"""

_WINDOW = """CASE WHEN TransDate BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' THEN 'base'
  WHEN TransDate BETWEEN DATE '2000-01-01' AND DATE '2000-12-31' THEN 'recent' END"""

_COUNTED = "count(*) FILTER (IsMatrix = 1 AND InLife = 1"


def _five(*columns: str) -> str:
    return ", ".join(f"round({c} + 1e-9, 5) AS {c}" for c in columns)


SPECIFIED |= {
    "weekday_index": f"""WITH {EVENTS},
w AS (SELECT ItemLocationId, Branch, LocationFormatTT, dayofweek(TransDate) + 1 AS Weekday,
        count(*) AS n, sum(ValueSales) AS s FROM days WHERE ValueSales IS NOT NULL
      GROUP BY 1, 2, 3, 4),
x AS (SELECT *, n * sum(s) OVER (PARTITION BY ItemLocationId)
        / sum(n) OVER (PARTITION BY ItemLocationId) AS e FROM w),
y AS (SELECT Branch, LocationFormatTT, Weekday, sum(n) AS Days, sum(s) AS Sales,
        sum(e) AS Expected, sum(s) / nullif(sum(e), 0) AS WeekdayIndex FROM x GROUP BY 1, 2, 3)
SELECT Branch, LocationFormatTT, Weekday, Days, {_six('Sales', 'Expected', 'WeekdayIndex')}
FROM y""",
    "special_day_effect": f"""WITH {EVENTS}{_SPECIAL},
e AS (SELECT Branch, DayType, count(*) AS Days, sum(v) AS Sales, sum(u) AS Usual,
        sum(v) / nullif(sum(u), 0) AS Effect FROM u GROUP BY 1, 2)
SELECT Branch, DayType, Days, {_six('Sales', 'Usual', 'Effect')} FROM e""",
    "special_day_quantiles": f"""WITH {EVENTS}{_SPECIAL},
w AS (SELECT Branch, DayType, round(v / u, 9) AS r, sum(CAST(u AS DECIMAL(38,10))) AS w
      FROM u GROUP BY 1, 2, 3),
s AS (SELECT *, CAST(sum(w) OVER (PARTITION BY Branch, DayType ORDER BY r) AS DOUBLE)
        / CAST(sum(w) OVER (PARTITION BY Branch, DayType) AS DOUBLE) AS share FROM w),
q AS (SELECT Branch, DayType, min(r) FILTER (share >= 0.25) AS Q25,
        min(r) FILTER (share >= 0.5) AS Q50, min(r) FILTER (share >= 0.75) AS Q75
      FROM s GROUP BY 1, 2)
SELECT Branch, DayType, {_six('Q25', 'Q50', 'Q75')} FROM q""",
    "year_over_year": f"""WITH {LINEITEM},
m AS (SELECT Branch, year(TransDate) AS Year, month(TransDate) AS Month, count(*) AS Days,
        avg(ValueSales) AS l, avg(CASE WHEN ValueSales = 0 THEN 1.0 ELSE 0.0 END) AS z
      FROM days WHERE ValueSales IS NOT NULL AND Cohort = 'before' GROUP BY 1, 2, 3),
y AS (SELECT a.Branch, a.Year, a.Month, a.Days, a.l / nullif(b.l, 0) AS LevelRatio,
        a.z - b.z AS ZeroShareChange
      FROM m a JOIN m b ON b.Branch = a.Branch AND b.Month = a.Month AND b.Year = a.Year - 1)
SELECT Branch, Year, Month, Days, {_six('LevelRatio', 'ZeroShareChange')} FROM y""",
    "significant_variance_ratio": f"""{_EVENT_SERIES}{_LAGS},
z AS (SELECT ItemLocationId, Variant,
        (VarianceRatio7 - 1) / sqrt(156.0 / (21 * Pairs1)) AS z
      FROM lags WHERE Variant = 'sales' AND VarianceRatio7 IS NOT NULL),
y AS (SELECT *, abs(z) / sqrt(2) AS x, 1 / (1 + 0.3275911 * abs(z) / sqrt(2)) AS t FROM z),
t AS (SELECT ItemLocationId, Variant, round((((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t
        - 0.284496736) * t + 0.254829592) * t) * exp(-x * x), 9) AS P FROM y),
r AS (SELECT *, count(*) OVER (ORDER BY P RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS rank, count(*) OVER () AS m FROM t),
c AS (SELECT max(P) FILTER (P <= 0.2 * rank / m) AS cut FROM r)
SELECT ItemLocationId, Variant, {_six('P')},
  CASE WHEN P <= cut THEN 1 ELSE 0 END AS Significant FROM t, c""",
    "matrix_runs": f"""WITH {EVENTS},
a AS (SELECT ItemLocationId, TransDate, CASE WHEN TransDate - 1 = lag(TransDate)
        OVER (PARTITION BY ItemLocationId ORDER BY TransDate) THEN 0 ELSE 1 END AS s
      FROM days WHERE IsMatrix = 1 AND InLife = 1),
b AS (SELECT *, sum(s) OVER (PARTITION BY ItemLocationId ORDER BY TransDate) AS r FROM a),
c AS (SELECT ItemLocationId, r, count(*) AS n FROM b GROUP BY 1, 2)
SELECT ItemLocationId, count(*) AS Runs, sum(n) AS MatrixDays, max(n) AS LongestRun
FROM c GROUP BY 1""",
    "ramp_up": f"""WITH {LINEITEM}{_RAMP}
SELECT ItemLocationId, {_six('Level')},
  CASE WHEN Level > 0 AND s <= 16 THEN s END AS StableWeek FROM st""",
    "weekly_trend": f"""WITH {LINEITEM}{_TREND}
SELECT ItemLocationId, Weeks, {_six('Tau', 'SenSlope', 'Z', 'ZCorrected')} FROM zc""",
    "known_shift": f"""WITH {LINEITEM},
w AS (SELECT ItemLocationId, Branch, LocationNetwork, dayofweek(TransDate) AS d,
        count(*) FILTER (TransDate >= DATE '1999-07-01') AS n1,
        sum(ValueSales) FILTER (TransDate >= DATE '1999-07-01') AS s1,
        count(*) FILTER (TransDate < DATE '1999-07-01') AS n0,
        sum(ValueSales) FILTER (TransDate < DATE '1999-07-01') AS s0
      FROM days WHERE ValueSales IS NOT NULL GROUP BY 1, 2, 3, 4),
k AS (SELECT Branch, LocationNetwork, count(DISTINCT ItemLocationId) AS Pairs,
        sum(n1) AS DaysAfter, sum(s1) AS SalesAfter, sum(s0 / n0 * n1) AS ExpectedAfter,
        sum(s1) / nullif(sum(s0 / n0 * n1), 0) AS Shift
      FROM w WHERE n0 > 0 AND n1 > 0 GROUP BY 1, 2)
SELECT Branch, LocationNetwork, Pairs, DaysAfter,
  {_six('SalesAfter', 'ExpectedAfter', 'Shift')} FROM k""",
    "deficit_frequency": f"""WITH {LINEITEM}{BASE},
f AS (SELECT b.Branch, b.AbcRevenueStore AS Class, dayofweek(d.TransDate) + 1 AS Weekday,
        count(*) AS MatrixDays, sum(d.IsDeficit) AS DeficitDays,
        sum(d.SalesQty * d.IsDeficit) / nullif(sum(d.SalesQty), 0) AS DeficitSalesShare,
        sum(d.IsDeficit) / count(*) AS DeficitShare
      FROM days d JOIN (SELECT * FROM base WHERE Variant = 'sales') b
        ON b.ItemLocationId = d.ItemLocationId
      WHERE d.IsMatrix = 1 AND d.InLife = 1 GROUP BY 1, 2, 3)
SELECT Branch, Class, Weekday, MatrixDays, DeficitDays,
  {_six('DeficitSalesShare', 'DeficitShare')} FROM f""",
    "deficit_effect": f"""WITH {LINEITEM}{PROFILE},
w AS (SELECT s.Branch, s.Scope, CAST(s.Quadrant <> d.Quadrant AS INTEGER) AS ch,
        s.SalesLevel - d.SalesLevel AS SalesLevel, s.ZeroShare - d.ZeroShare AS ZeroShare, s.Adi - d.Adi AS Adi,
        s.Cv2 - d.Cv2 AS Cv2
      FROM profile s JOIN profile d ON d.ItemLocationId = s.ItemLocationId AND d.Variant = 'demand'
      WHERE s.Variant = 'sales' AND s.IsEmpty = 0),
u AS (UNPIVOT w ON SalesLevel, ZeroShare, Adi, Cv2 INTO NAME Measure VALUE d),
e AS (SELECT Branch, Scope, Measure, count(*) AS Pairs, sum(ch) AS ClassChanged, avg(d) AS MeanEffect,
        count(*) FILTER (abs(d) > 1e-9) AS PairsMoved, max(abs(d)) AS LargestEffect
      FROM u WHERE d IS NOT NULL GROUP BY 1, 2, 3)
SELECT Branch, Scope, Measure, Pairs, ClassChanged, {_six('MeanEffect')}, PairsMoved, {_six('LargestEffect')} FROM e""",
    "weekly_profile_similarity": f"""WITH {EVENTS},
p AS (SELECT ItemLocationId, ItemId, dayofweek(TransDate) AS d, sum(ValueSales) AS s,
        count(*) AS n FROM days WHERE ValueSales IS NOT NULL GROUP BY 1, 2, 3),
i AS (SELECT ItemId, d, sum(s) / sum(n) AS im FROM p GROUP BY 1, 2),
c AS (SELECT ItemLocationId, count(*) AS Weekdays,
        sum(s / n * im) / nullif(sqrt(sum(s / n * s / n) * sum(im * im)), 0) AS Cosine
      FROM p JOIN i ON i.ItemId = p.ItemId AND i.d = p.d GROUP BY 1)
SELECT ItemLocationId, Weekdays, {_six('Cosine')} FROM c""",
    "other_stores_correlation": f"""WITH {EVENTS},
o AS (SELECT ItemLocationId, ValueSales AS v,
        CASE WHEN count(*) OVER g > 1 THEN sum(ValueSales) OVER g - ValueSales END AS r
      FROM days WHERE ValueSales IS NOT NULL WINDOW g AS (PARTITION BY TransDate, ItemId)),
c AS (SELECT ItemLocationId, count(r) AS Days,
        {_CORR.format(x='CASE WHEN r IS NOT NULL THEN v END', y='r')} AS Correlation
      FROM o GROUP BY 1)
SELECT ItemLocationId, Days, {_six('Correlation')} FROM c""",
    "common_factors": f"""WITH {EVENTS}{_OTHERS},
c AS (SELECT ItemLocationId, count(*) AS Days, {_CORR.format(x='ValueSales', y='sr')} AS a,
        {_CORR.format(x='ValueSales', y='gr')} AS b, {_CORR.format(x='sr', y='gr')} AS ab
      FROM known GROUP BY 1),
r AS (SELECT ItemLocationId, Days, a AS StoreCorr, b AS GroupCorr, ab AS FactorCorr,
        CASE WHEN 1 - ab * ab > 1e-9 THEN (a * a + b * b - 2 * a * b * ab) / (1 - ab * ab) END
          AS R2 FROM c)
SELECT ItemLocationId, Days, {_five('StoreCorr', 'GroupCorr', 'FactorCorr', 'R2')} FROM r""",
    "substitution": f"""WITH {EVENTS},
n AS (SELECT *, CASE WHEN count(*) OVER g > 1 THEN sum(IsDeficit) OVER g - IsDeficit END AS nd
      FROM days WHERE IsMatrix = 1 AND InLife = 1
      WINDOW g AS (PARTITION BY TransDate, LocationId, ItemIdLevel3, Branch)),
w AS (SELECT ItemLocationId, Branch, dayofweek(TransDate) AS d,
        count(*) FILTER (nd > 0) AS n1, sum(ValueDemand) FILTER (nd > 0) AS s1,
        count(*) FILTER (coalesce(nd, 0) <= 0) AS n0,
        sum(ValueDemand) FILTER (coalesce(nd, 0) <= 0) AS s0
      FROM n WHERE ValueDemand IS NOT NULL GROUP BY 1, 2, 3),
e AS (SELECT Branch, sum(n1) AS Days, sum(s1) AS Sales, sum(s0 / n0 * n1) AS Expected,
        sum(s1) / nullif(sum(s0 / n0 * n1), 0) AS Effect
      FROM w WHERE n0 > 0 AND n1 > 0 GROUP BY 1)
SELECT Branch, Days, {_six('Sales', 'Expected', 'Effect')} FROM e""",
    "price_elasticity": f"""WITH {LINEITEM},
k AS (SELECT ItemLocationId, {_WEEK} AS w, sum(SalesQty) AS q, sum(SalesAmount) AS a
      FROM days GROUP BY 1, 2 HAVING sum(SalesQty) > 0 AND sum(SalesAmount) > 0),
p AS (SELECT ItemLocationId, ln(a / q) AS p, ln(q) AS q,
        CASE WHEN abs(a / q / lag(a / q) OVER o - 1) > 0.05
              AND abs(lead(a / q) OVER o / (a / q) - 1) <= 0.05 THEN 1 ELSE 0 END AS s
      FROM k WINDOW o AS (PARTITION BY ItemLocationId ORDER BY w)),
e AS (SELECT ItemLocationId, count(*) AS Weeks, sum(s) AS PriceSteps,
        CASE WHEN var_samp(p) > 1e-9 THEN covar_samp(q, p) / var_samp(p) END AS Elasticity
      FROM p GROUP BY 1)
SELECT ItemLocationId, Weeks, PriceSteps, {_six('Elasticity')} FROM e""",
    "drift_weekday_level": f"""WITH {LINEITEM},
d AS (SELECT Branch, TransDate, sum(SalesQty) AS Qty FROM days GROUP BY 1, 2),
u AS (SELECT *, avg(Qty) OVER (PARTITION BY Branch, dayofweek(TransDate) ORDER BY TransDate
        RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING) AS Usual FROM d),
l AS (SELECT *, Qty / nullif(Usual, 0) AS Level FROM u)
SELECT Branch, TransDate, {_six('Qty', 'Usual', 'Level')} FROM l""",
    "drift_stability": f"""WITH {LINEITEM},
b AS (SELECT Branch, LocationNetwork, {_WINDOW} AS p,
        (CASE WHEN SalesQty >= 1 THEN 1 ELSE 0 END) + (CASE WHEN SalesQty >= 5 THEN 1 ELSE 0 END)
        + (CASE WHEN SalesQty >= 10 THEN 1 ELSE 0 END)
        + (CASE WHEN SalesQty >= 20 THEN 1 ELSE 0 END)
        + (CASE WHEN SalesQty >= 30 THEN 1 ELSE 0 END)
        + (CASE WHEN SalesQty >= 40 THEN 1 ELSE 0 END)
        + (CASE WHEN SalesQty >= 50 THEN 1 ELSE 0 END) AS bin FROM days),
c AS (SELECT Branch, LocationNetwork, bin, count(*) FILTER (p = 'base') AS nb,
        count(*) FILTER (p = 'recent') AS nr FROM b WHERE p IS NOT NULL GROUP BY 1, 2, 3),
s AS (SELECT *, greatest(nb / sum(nb) OVER g, 1e-4) AS sb, greatest(nr / sum(nr) OVER g, 1e-4)
        AS sr FROM c WINDOW g AS (PARTITION BY Branch, LocationNetwork)),
t AS (SELECT Branch, LocationNetwork, sum(nb) AS BaseRows, sum(nr) AS RecentRows,
        sum((sr - sb) * ln(sr / sb)) AS Psi FROM s GROUP BY 1, 2)
SELECT Branch, LocationNetwork, BaseRows, RecentRows, {_six('Psi')} FROM t""",
    "drift_shares": f"""WITH {LINEITEM},
b AS (SELECT *, {_WINDOW} AS Period FROM days),
s AS (SELECT Branch, Scope, Period, count(DISTINCT ItemLocationId) AS Pairs,
        {_COUNTED} AND SalesQty = 0) / nullif({_COUNTED}), 0) AS ZeroShare,
        {_COUNTED} AND IsDeficit = 1) / nullif({_COUNTED}), 0) AS DeficitShare,
        coalesce(sum(SalesQty) FILTER (IsMatrix = 0), 0) / nullif(sum(SalesQty), 0)
          AS OutMatrixShare, sum(SalesAmount) / nullif(sum(SalesQty), 0) AS Price
      FROM b WHERE Period IS NOT NULL GROUP BY 1, 2, 3)
SELECT Branch, Scope, Period, Pairs,
  {_six('ZeroShare', 'DeficitShare', 'OutMatrixShare', 'Price')} FROM s""",
}

_LAGGED = f""",
st AS (SELECT TransDate, LocationId, sum(SalesAmount) AS t, count(*) AS n FROM days GROUP BY 1, 2),
gt AS (SELECT TransDate, LocationId, ItemIdLevel2, Branch, sum(SalesQty) AS t, count(*) AS n
       FROM days GROUP BY 1, 2, 3, 4),
lag AS (
  SELECT d.ItemLocationId, k.k AS Lag, d.ValueSales,
    CASE WHEN s.n > CASE WHEN o.ItemLocationId IS NULL THEN 0 ELSE 1 END
         THEN s.t - coalesce(o.SalesAmount, 0) END AS sr,
    CASE WHEN g.n > CASE WHEN o.ItemLocationId IS NULL THEN 0 ELSE 1 END
         THEN g.t - coalesce(o.SalesQty, 0) END AS gr
  FROM days d CROSS JOIN (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS k) k
  LEFT JOIN days o ON o.ItemLocationId = d.ItemLocationId AND o.TransDate = d.TransDate - k.k
  LEFT JOIN st s ON s.LocationId = d.LocationId AND s.TransDate = d.TransDate - k.k
  LEFT JOIN gt g ON g.LocationId = d.LocationId AND g.ItemIdLevel2 = d.ItemIdLevel2
    AND g.Branch = d.Branch AND g.TransDate = d.TransDate - k.k
  WHERE d.ValueSales IS NOT NULL),
known AS (SELECT * FROM lag WHERE sr IS NOT NULL AND gr IS NOT NULL),
c AS (SELECT ItemLocationId, Lag, count(*) AS Days, {_CORR.format(x='ValueSales', y='sr')} AS a,
        {_CORR.format(x='ValueSales', y='gr')} AS b, {_CORR.format(x='sr', y='gr')} AS ab
      FROM known GROUP BY 1, 2),
r AS (SELECT ItemLocationId, Lag, Days, a AS StoreCorr, b AS GroupCorr, ab AS FactorCorr,
        CASE WHEN 1 - ab * ab > 1e-9 THEN (a * a + b * b - 2 * a * b * ab) / (1 - ab * ab) END
          AS R2 FROM c)"""


def _windows(months: int, count: int, skipped: str = "-1") -> str:
    """CTEs numbering the windows, and for each the last one before it that is not skipped."""
    return f""",
win AS (SELECT i AS w, CAST(DATE '1995-01-01' + to_months(CAST(i * {months} AS INTEGER)) AS DATE) AS f,
          CAST(DATE '1995-01-01' + to_months(CAST((i + 1) * {months} AS INTEGER)) AS DATE) AS u,
          CASE WHEN i IN ({skipped}) THEN 1 ELSE 0 END AS k FROM range({count}) t(i)),
cmp AS (SELECT a.w, max(b.w) AS b, max(a.f) AS "Window", max(b.f) AS Base, max(a.k) AS KnownEvent
        FROM win a JOIN win b ON b.w < a.w AND b.k = 0 GROUP BY 1),
dw AS (SELECT d.*, win.w FROM days d JOIN win ON d.TransDate >= win.f AND d.TransDate < win.u)"""


_MATRIX_ENTITIES = "\n UNION ALL ".join(
    f"SELECT DISTINCT Branch, '{kind}' AS Entity, CAST({column} AS VARCHAR) AS Key, w FROM dw "
    "WHERE IsMatrix = 1 AND InLife = 1"
    for kind, column in (("store", "LocationId"), ("item", "ItemId"), ("pair", "ItemLocationId")))

SPECIFIED |= {
    "lagged_factors": f"""WITH {EVENTS}{_LAGGED}
SELECT ItemLocationId, Lag, Days, {_five('StoreCorr', 'GroupCorr', 'FactorCorr', 'R2')} FROM r""",
    "matrix_entries": f"""WITH {EVENTS},
m AS (SELECT Branch, LocationFormatTT, ItemLocationId, TransDate FROM days WHERE IsMatrix = 1 AND InLife = 1),
seg AS (SELECT DISTINCT Branch, LocationFormatTT FROM m),
cal AS (SELECT seg.*, CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE)
          AS TransDate FROM seg),
i AS (SELECT Branch, LocationFormatTT, TransDate, count(*) AS n FROM m a WHERE NOT EXISTS (
        SELECT 1 FROM m b WHERE b.ItemLocationId = a.ItemLocationId AND b.TransDate = a.TransDate - 1) GROUP BY ALL),
o AS (SELECT Branch, LocationFormatTT, TransDate + 1 AS TransDate, count(*) AS n FROM m a WHERE NOT EXISTS (
        SELECT 1 FROM m b WHERE b.ItemLocationId = a.ItemLocationId AND b.TransDate = a.TransDate + 1) GROUP BY ALL),
p AS (SELECT Branch, LocationFormatTT, TransDate, count(*) AS n FROM m GROUP BY ALL)
SELECT Branch, LocationFormatTT, TransDate, coalesce(i.n, 0) AS Entries, coalesce(o.n, 0) AS Exits,
  coalesce(p.n, 0) AS OnMatrix
FROM cal LEFT JOIN i USING (Branch, LocationFormatTT, TransDate)
LEFT JOIN o USING (Branch, LocationFormatTT, TransDate) LEFT JOIN p USING (Branch, LocationFormatTT, TransDate)""",
    "drift_composition": f"""WITH {LINEITEM}{_windows(3, 28, '18')},
e AS ({_MATRIX_ENTITIES}),
f AS (SELECT Branch, Entity, Key, min(w) AS born FROM e GROUP BY ALL),
s AS (SELECT f.Branch, f.Entity, "Window", Base, KnownEvent, n.w IS NOT NULL AS now, o.w IS NOT NULL AS was,
        f.born < cmp.w AS earlier
      FROM f CROSS JOIN cmp
      LEFT JOIN e n ON n.Branch = f.Branch AND n.Entity = f.Entity AND n.Key = f.Key AND n.w = cmp.w
      LEFT JOIN e o ON o.Branch = f.Branch AND o.Entity = f.Entity AND o.Key = f.Key AND o.w = cmp.b),
g AS (SELECT Branch, Entity, "Window", Base, KnownEvent, count(*) FILTER (now) AS Present,
        count(*) FILTER (was) AS InBase, count(*) FILTER (now AND was) AS Stayed,
        count(*) FILTER (now AND NOT earlier) AS New,
        count(*) FILTER (now AND NOT was AND earlier) AS Returned,
        count(*) FILTER (was AND NOT now) AS Withdrawn FROM s GROUP BY ALL),
h AS (SELECT *, (New + Returned + Withdrawn) / nullif(InBase, 0) AS Turnover FROM g)
SELECT Branch, Entity, "Window", Base, KnownEvent, Present, InBase, Stayed, New, Returned, Withdrawn,
  {_six('Turnover')} FROM h""",
    "drift_targets": f"""WITH {LINEITEM}{_windows(3, 28, '18')},
a AS (SELECT Branch, w, count(*) AS Days,
        count(*) FILTER (StockEndQty >= CASE Branch WHEN 'kg' THEN 0.1 ELSE 1 END) / count(*) AS Availability,
        sum(StockEndQty) / nullif(sum(SalesQty + StockEndQty), 0) AS LeftoverShare
      FROM dw WHERE IsMatrix = 1 AND InLife = 1 GROUP BY 1, 2),
t AS (SELECT a.Branch, "Window", Base, KnownEvent, a.Days, a.Availability, a.LeftoverShare,
        o.Availability AS BaseAvailability, o.LeftoverShare AS BaseLeftoverShare,
        CAST(a.Availability < 0.75 AS INTEGER) AS AvailabilityMissed,
        CAST(a.LeftoverShare > 0.05 AS INTEGER) AS LeftoverMissed,
        a.Availability - o.Availability AS AvailabilityChange, a.LeftoverShare - o.LeftoverShare AS LeftoverChange
      FROM a JOIN cmp ON cmp.w = a.w LEFT JOIN a o ON o.Branch = a.Branch AND o.w = cmp.b)
SELECT Branch, "Window", Base, KnownEvent, Days, AvailabilityMissed, LeftoverMissed,
  {_six('Availability', 'LeftoverShare', 'BaseAvailability', 'BaseLeftoverShare', 'AvailabilityChange',
        'LeftoverChange')} FROM t""",
    "drift_distance": f"""WITH {LINEITEM}{_windows(12, 7)},
v AS (SELECT Branch, LocationNetwork, "Window", Base, KnownEvent, ValueSales AS v,
        count(*) FILTER (dw.w = cmp.w) AS r, count(*) FILTER (dw.w = cmp.b) AS b
      FROM dw JOIN cmp ON dw.w IN (cmp.w, cmp.b) WHERE ValueSales IS NOT NULL GROUP BY ALL),
s AS (SELECT *, sum(r) OVER k AS nr, sum(b) OVER k AS nb, sum(r) OVER o AS cr, sum(b) OVER o AS cb,
        lead(v) OVER o AS nv
      FROM v WINDOW k AS (PARTITION BY Branch, LocationNetwork, "Window"),
        o AS (PARTITION BY Branch, LocationNetwork, "Window" ORDER BY v)),
d AS (SELECT Branch, LocationNetwork, "Window", Base, KnownEvent, CAST(max(nr) AS BIGINT) AS RecentRows,
        CAST(max(nb) AS BIGINT) AS BaseRows, coalesce(sum(abs(cr / nr - cb / nb) * (nv - v)), 0) AS Distance
      FROM s WHERE nr > 0 AND nb > 0 GROUP BY ALL)
SELECT Branch, LocationNetwork, "Window", Base, KnownEvent, RecentRows, BaseRows, {_six('Distance')} FROM d""",
}
