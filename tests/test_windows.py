"""Cuts, lagged factors, composition, distances, entries and corrected trends against plain Python."""

import datetime as dt
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelftide.operators import drift, frontier, hierarchy, lifecycle, links, trend

START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def day_frame(spark, rows):
    """(day number, store, item, subgroup, quantity, on the matrix) as a day layer of one branch."""
    return spark.createDataFrame(
        [(day(n), s, i, f"{s}{i}", g, "kg", "F", float(q), float(q) * 3, m, 1, 0, float(q), float(q) if m else None)
         for n, s, i, g, q, m in rows],
        "TransDate date, LocationId string, ItemId string, ItemLocationId string, ItemIdLevel2 string, Branch string, "
        "LocationFormatTT string, SalesQty double, SalesAmount double, IsMatrix int, InLife int, IsEmpty int, "
        "StockEndQty double, ValueSales double")


@pytest.fixture(scope="module")
def random_rows():
    rng = np.random.default_rng(12)
    return [(n, s, i, "g1" if i < "c" else "g2", rng.integers(0, 9), int(rng.random() < 0.8))
            for n in range(40) for s in "xy" for i in "abcd" if rng.random() < 0.85]


def test_frontier_cuts_add_up(quadrant_layers):
    base = quadrant_layers.base
    points = frontier.order_frontier(quadrant_layers.days, quadrant_layers.params)
    rows = frontier.frontier_cuts(points, base).collect()
    cuts = defaultdict(list)
    for r in rows:
        cuts[r.Cut].append(r)
    assert set(cuts) == {*frontier.CUTS, "total"} and all(r.CutValue is None for r in cuts["total"])
    totals = {(r.Branch, r.Variant, r.Q): r for r in cuts["total"]}
    for cut in frontier.CUTS:
        days = defaultdict(int)
        for r in cuts[cut]:
            days[r.Branch, r.Variant, r.Q] += r.Days
        assert days == {k: r.Days for k, r in totals.items()}
        curve = {(r.Branch, str(r[cut]), r.Variant, r.Q): (r.AvailableDays, r.Leftover, r.LeftoverShare)
                 for r in frontier.frontier_curve(points, base, ["Branch", cut]).collect()}
        assert curve == {(r.Branch, r.CutValue, r.Variant, r.Q): (r.AvailableDays, r.Leftover, r.LeftoverShare)
                         for r in cuts[cut]}


def test_lagged_factors_equal_plain_correlations(spark, random_rows):
    rows = [r for r in random_rows if r[4] >= 0]
    got = {(r.ItemLocationId, r.Lag): r for r in links.lagged_factors(day_frame(spark, rows), 3).collect()}
    at = {(n, s, i): q for n, s, i, _, q, _ in rows}
    seen = 0
    for s in "xy":
        for i in "abcd":
            for k in (1, 2, 3):
                points = []
                for n, s1, i1, g, q, m in rows:
                    if (s1, i1) != (s, i) or not m:
                        continue
                    others = [o for o in "abcd" if (n - k, s, o) in at and o != i]
                    near = [o for o in others if ("g1" if o < "c" else "g2") == g]
                    if others and near:
                        points.append((q, 3 * sum(at[n - k, s, o] for o in others), sum(at[n - k, s, o] for o in near)))
                r = got[s + i, k]
                c = np.corrcoef(np.array(points, float).T)
                assert (r.Days, r.StoreCorr, r.GroupCorr, r.FactorCorr) == (
                    len(points), *[pytest.approx(float(x)) for x in (c[0, 1], c[0, 2], c[1, 2])])
                assert r.R2 == pytest.approx((c[0, 1] ** 2 + c[0, 2] ** 2 - 2 * c[0, 1] * c[0, 2] * c[1, 2])
                                             / (1 - c[1, 2] ** 2))
                seen += 1
    assert len(got) == seen


def test_composition_and_known_events(spark):
    months = {"a": (0, 1, 2, 3), "b": (0, 1), "c": (2, 3), "d": (0, 3), "e": (1,)}
    rows = [(31 * m + 3, "x", i, "g", 1, 1) for i, ms in months.items() for m in ms] + [(95, "x", "z", "g", 1, 0)]
    windows = drift.MonthWindows(START, 1, 4, [day(40)])
    assert windows.base == {1: 0, 2: 0, 3: 2}
    got = {(r.Entity, r.Window): r for r in drift.composition(day_frame(spark, rows), windows).collect()}

    def counts(entity, month):
        r = got[entity, dt.date(2024, month, 1)]
        return r.Base.month, r.KnownEvent, r.Present, r.InBase, r.Stayed, r.New, r.Returned, r.Withdrawn
    assert counts("pair", 2) == (1, 1, 3, 3, 2, 1, 0, 1)
    assert counts("item", 3) == (1, 0, 2, 3, 1, 1, 0, 2)
    assert counts("pair", 4) == (3, 0, 3, 2, 2, 0, 1, 0)
    assert counts("store", 4) == (3, 0, 1, 1, 1, 0, 0, 0)
    assert got["pair", dt.date(2024, 4, 1)].Turnover == 0.5
    with pytest.raises(ValueError):
        drift.MonthWindows(START, 1, 63)


def test_distance_equals_area_between_curves(spark):
    rng = np.random.default_rng(3)
    first, second = rng.integers(0, 20, 200) / 4, rng.integers(5, 40, 90) / 4
    rows = [(k % 31, "x", "a", "g", v, 1) for k, v in enumerate(first)]
    rows += [(31 + k % 28, "x", "a", "g", v, 1) for k, v in enumerate(second)]
    rows += [(61, "y", "a", "g", 1, 1)]
    windows = drift.MonthWindows(START, 1, 3)
    got = drift.distribution_distance(day_frame(spark, rows), "ValueSales", windows, ["LocationId"]).collect()
    grid = np.unique(np.concatenate([first, second]))
    area = sum(abs((first <= a).mean() - (second <= a).mean()) * (b - a) for a, b in zip(grid, grid[1:]))
    assert [(r.LocationId, r.RecentRows, r.BaseRows, r.Distance) for r in got] == [
        ("x", 90, 200, pytest.approx(area))]
    same = drift.distribution_distance(day_frame(spark, rows[:31] + [(n + 31, *r) for n, *r in rows[:28]]),
                                       "ValueSales", drift.MonthWindows(START, 1, 2), ["LocationId"]).first()
    assert same.Distance < 0.5


def test_matrix_entries_equal_counts(spark, random_rows):
    frame = day_frame(spark, random_rows)
    got = lifecycle.matrix_entries(frame, ["LocationId"], day(2), day(36)).collect()
    on = {(n, s, i) for n, s, i, _, _, m in random_rows if m and 2 <= n <= 36}
    assert len(got) == 2 * 35
    for r in got:
        n = (r.TransDate - START).days
        here = [(k, i) for k, s, i in on if s == r.LocationId]
        assert r.OnMatrix == sum(k == n for k, _ in here)
        assert r.Entries == sum(k == n and (n - 1, r.LocationId, i) not in on for k, i in here)
        assert r.Exits == sum(k == n - 1 and (n, r.LocationId, i) not in on for k, i in here)


def plain_trend(x):
    n = len(x)
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    s = sum(np.sign(x[j] - x[i]) for i, j in pairs)
    slope = np.median([(x[j] - x[i]) / (j - i) for i, j in pairs])
    ties = sum(t * (t - 1) * (2 * t + 5) for t in np.unique(x, return_counts=True)[1].tolist())
    variance = (n * (n - 1) * (2 * n + 5) - ties) / 18
    rest = np.round(x - slope * np.arange(n), 9)
    rank = np.array([(rest < v).sum() + ((rest == v).sum() + 1) / 2 for v in rest]) - (n + 1) / 2
    factor = 1.0
    for k in range(1, n):
        r = (rank[:-k] * rank[k:]).sum() / (rank * rank).sum()
        if abs(r) > 1.96 / math.sqrt(n):
            factor += 2 / (n * (n - 1) * (n - 2)) * (n - k) * (n - k - 1) * (n - k - 2) * r
    z = s - np.sign(s)
    return slope, z / math.sqrt(variance), z / math.sqrt(variance * factor) if factor > 0 else None


def test_trend_with_autocorrelation(spark):
    rng = np.random.default_rng(2)
    noise = rng.normal(size=40)
    tied = np.zeros(40)
    for i in range(1, 40):
        tied[i] = 0.8 * tied[i - 1] + noise[i]
    series = {"a": np.round(10 + tied, 3), "b": np.round(20 + np.arange(40) * 0.3 + noise, 3),
              "c": np.tile([4.0, 5.0], 20)}
    rows = [(7 * w, "x", i, "g", q, 1) for i, x in series.items() for w, q in enumerate(x)]
    got = {r.ItemLocationId: r for r in trend.weekly_trend(day_frame(spark, rows)).collect()}
    for i, x in series.items():
        slope, z, corrected = plain_trend(x)
        r = got["x" + i]
        assert (r.Weeks, r.SenSlope, r.Z) == (40, pytest.approx(slope), pytest.approx(z))
        assert r.ZCorrected == (corrected if corrected is None else pytest.approx(corrected))
    assert abs(got["xa"].ZCorrected) < abs(got["xa"].Z)
    short = trend.weekly_trend(day_frame(spark, rows).where(F.col("TransDate") < day(12)), min_weeks=2).collect()
    assert {r.Weeks for r in short} == {2}


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 9, 33])
def test_paths_of_any_depth(spark, depth):
    edges = [(f"n{k}", f"n{k - 1}" if k else None, f"name{k}") for k in range(depth)] + [("lone", "gone", "lonely")]
    paths = {r.LevelId: r for r in hierarchy.hierarchy_paths(
        spark.createDataFrame(edges, "id string, up string, name string"), "id", "up", "name").collect()}
    assert paths[f"n{depth - 1}"].LevelIdList == [f"n{k}" for k in range(depth)]
    assert paths["lone"].LevelIdList == ["lone"] and len(paths) == depth + 1
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.hierarchy_paths(spark.createDataFrame(
            [*edges, ("p", "q", "p"), ("q", "r", "q"), ("r", "p", "r")], "id string, up string, name string"),
            "id", "up", "name")
