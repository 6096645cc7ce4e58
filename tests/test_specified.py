"""Later-stage analyses against hand counts, identities and brute force."""

import dataclasses
import datetime as dt
import math
import time
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelftide.checks.contract import ContractRules, contract_checks, months_without_file
from shelftide.checks.forecast_checks import forecast_checks
from shelftide.checks.journal import assemble
from shelftide.functions import labels
from shelftide.operators import (
    abc_compare, baselines, calendar, frontier, lifecycle, links, measures, ranking, trend)
from shelftide.plans.layers import Layers
from shelftide.sources.facts import RAW_SCHEMA, read_raw, with_rollups
from shop_data import ALL_DAYS, PARAMS, Point, day, main_rows, raw_frame, rows_of

RULES = ContractRules(top_group="GOODS")


def failing(raw, params=PARAMS, rules=RULES):
    journal = assemble(contract_checks(raw, params, rules))
    return {r.CheckName.removeprefix("contract_"): r.Value for r in journal.collect()
            if r.Status != "ok"}


@pytest.fixture(scope="module")
def sound_rows():
    """Two pairs of one store for 14 days that keep every rule of the contract."""
    rows = rows_of("north", "roll", 41, ALL_DAYS, Point(1, 5.0, 5.0, 2.0, 30.0))
    return rows + rows_of("north", "rye", 42, ALL_DAYS, Point(1, 2.5, 2.5, 0.5, 40.0))


def test_sound_contract(spark, sound_rows):
    assert failing(with_rollups(raw_frame(spark, sound_rows))) == {}


@pytest.mark.parametrize("rule, change", [
    ("key_unique", {"ItemLocationId": 41, "TransDate": day(4)}),
    ("key_filled", {"LocationId": None}),
    ("pair_id", {"ItemLocationId": 999}),
    ("top_group", {"ItemIdLevel1": "OTHER"}),
    ("stock_continuity", {"StockStartQty": 9.0}),
    ("stock_not_negative", {"StockEndQty": -1.0}),
    ("attributes_filled", {"LocationNetwork": " "}),
    ("item_constant", {"ItemIdLevel3": "COLD"}),
    ("store_constant", {"LocationFormatTT": "9"}),
    ("measure_known", {"ItemMeasure": "box"}),
    ("qty_not_negative", {"SalesQty": -1.0}),
    ("qty_and_amount", {"SalesAmount": 0.0})])
def test_broken_contract(spark, sound_rows, rule, change):
    rows = [dict(r) for r in sound_rows]
    rows[5].update(change)
    assert rule in failing(with_rollups(raw_frame(spark, rows)))


def test_contract_of_the_whole_table(spark, sound_rows, tmp_path):
    good = with_rollups(raw_frame(spark, sound_rows))
    assert "schema" in failing(good.withColumn("isMatrix", F.col("isMatrix").cast("long")))
    assert "calendar" in failing(good.where(F.col("TransDate") != F.lit(day(9))))
    assert "store_rollup" in failing(good.withColumn(
        "SalesByLocationAmount", F.col("SalesByLocationAmount") + 1))
    crowd = [r for n in range(3, 9) for r in rows_of(
        "quay", "roll", 200 + n, [12], Point(1, 1.0, 1.0, 1.0, 50.0))]
    crowded = with_rollups(raw_frame(spark, sound_rows + crowd))
    assert failing(crowded)["daily_volume"] == 1
    known = dataclasses.replace(RULES, known_events=(day(12),))
    assert "daily_volume" not in failing(crowded, rules=known)

    path = str(tmp_path / "files")
    good.write.parquet(path)
    two = dataclasses.replace(PARAMS, start=dt.date(2025, 2, 20))
    missing = months_without_file(read_raw(spark, path), two).collect()
    assert [r.Month for r in missing] == [dt.date(2025, 2, 1)]
    assert [f.name for f in RAW_SCHEMA] == good.columns
    journal = {r.CheckName: r.Value for r in assemble(
        contract_checks(good, two, RULES, read_raw(spark, path))).collect()}
    assert journal["contract_file_per_month"] == 1


def test_order_is_the_smallest_value_that_covers_q(spark, quadrant_layers):
    got = frontier.order_frontier(quadrant_layers.days, PARAMS, [Decimal("0.50"), Decimal("0.95")])
    rows = {(r.ItemLocationId, r.Q): r for r in got.where("Variant = 'sales'").collect()}
    half = rows[94, Decimal("0.50")]
    # Values 0 x 7, 2 x 4, 12 x 3: seven of fourteen are zero, so the order at 0.5 is zero.
    assert (half.OrderQty, half.AvailableDays, half.Leftover, half.Output) == (0, 0, 0, 0)
    top = rows[94, Decimal("0.95")]
    assert (top.OrderQty, top.AvailableDays, top.Days, top.Leftover, top.Output) == (
        12, 11, 14, 7 * 12 + 4 * 10, 168)
    assert rows[92, Decimal("0.50")].OrderQty == 1


def test_days_outside_the_matrix_do_not_count(layers):
    got = frontier.order_frontier(layers.days, PARAMS)
    assert got.where("ItemLocationId = 13 and Variant = 'sales'").first().Days == 12
    assert got.where("ItemLocationId in (22, 23)").count() == 0
    actual = {r.Branch: r for r in frontier.actual_point(layers.days, PARAMS, ["Branch"]).collect()}
    # kg: pairs 12, 21, 32 with two evenings below 0.1; pcs: one evening of pair 11 below 1.
    assert (actual["kg"].Days, actual["kg"].AvailableDays) == (25, 23)
    assert (actual["pcs"].Days, actual["pcs"].AvailableDays) == (32, 31)


def test_target_is_null_where_the_grid_ends_below_it(quadrant_layers):
    curve = frontier.frontier_curve(
        frontier.order_frontier(quadrant_layers.days, PARAMS), quadrant_layers.profile_pairs,
        ["Branch", "ItemLocationId"][:1])
    rows = {r.Target: r for r in frontier.target_quantiles(curve, ["Branch"], (0.0, 0.99))
            .where("Variant = 'sales'").collect()}
    assert rows[0.0].Q == Decimal("0.40") and rows[0.99].Q is None


TEST = baselines.Backtest(window_start=day(10), window_days=5, horizon=7, history_days=7,
                          min_history=3)


def brute_force(values, first_day, test):
    """Forecasts of one series, day by day."""
    out = {}
    for k in range(test.window_days):
        origin = test.window_start + dt.timedelta(days=k)
        known = {d: v for d, v in values.items()
                 if v is not None and 1 <= (origin - d).days <= test.history_days}
        for h in range(1, test.horizon + 1):
            target = origin + dt.timedelta(days=h - 1)
            seen = sorted(known.values())
            same = sorted(v for d, v in known.items() if (target - d).days % 7 == 0)
            pick = lambda s, q: s[min(int(q * len(s)), len(s) - 1)] if s else None
            enough = len(seen) >= test.min_history
            out[origin, h] = (
                sum(seen) / len(seen) if enough else None, pick(seen, 0.5) if enough else None,
                pick(same, 0.5) if enough else None, values.get(target))
    return out


def test_forecasts_equal_brute_force(layers, quadrant_layers):
    for source in (layers, quadrant_layers):
        series = source.arrays.collect()
        got = {(r.ItemLocationId, r.Variant, r.Origin, r.Horizon): r
               for r in baselines.forecasts(source.arrays, TEST).collect()}
        assert len(got) == len(series) * 35
        for s in series:
            values = {s.FirstDay + dt.timedelta(days=i): v for i, v in enumerate(s.Values)}
            for (origin, h), want in brute_force(values, s.FirstDay, TEST).items():
                r = got[s.ItemLocationId, s.Variant, origin, h]
                assert (r.Mean, r.Median, r.MedianDow, r.Actual) == pytest.approx(want)


def test_the_origin_day_and_later_do_not_change_a_forecast(spark, layers):
    later = [{**r, "SalesQty": r["SalesQty"] * 7, "SalesAmount": 1.0}
             if r["TransDate"] >= day(10) else r for r in main_rows()]
    changed = Layers(raw_frame(spark, later), PARAMS)
    def first_origin(source):
        rows = baselines.forecasts(source.arrays, TEST).where(F.col("Origin") == F.lit(day(10)))
        return sorted(map(tuple, rows.select("ItemLocationId", "Variant", "Horizon", "Mean",
                                             "Median", "MedianDow", "Q2").collect()), key=repr)
    assert first_origin(layers) == first_origin(changed)


def test_errors_are_sums(layers):
    forecast = baselines.forecasts(layers.arrays, TEST)
    row = baselines.forecast_errors(forecast, TEST).where(
        "ItemLocationId = 13 and Variant = 'sales' and Model = 'mean' and Horizon = 1").first()
    got = forecast.where("ItemLocationId = 13 and Variant = 'sales' and Horizon = 1 "
                         "and Actual is not null").collect()
    error = sum(abs(r.Actual - r.Mean) for r in got)
    # The 10th and the 12th have no value; the return of the 14th is a sale of none.
    assert (row.Days, row.AbsError) == (3, pytest.approx(error)) and error > 0
    assert row.Wape == pytest.approx(error / row.Actual)


def test_forecast_checks_catch_a_leak(layers):
    forecast = baselines.forecasts(layers.arrays, TEST)
    def errors(df):
        rows = assemble(forecast_checks(df, TEST)).collect()
        return {r.CheckName for r in rows if r.Status == "error"}
    assert errors(forecast) == set()
    assert errors(forecast.withColumn("LastUsed", F.col("Origin"))) == {"forecast_no_leakage"}
    assert errors(forecast.where("Horizon < 7")) == {"forecast_full_horizon"}
    assert errors(forecast.withColumn("Q2", F.col("Q0") - 1)) >= {"forecast_quantiles_monotone"}
    assert errors(forecast.withColumn("Mean", F.lit(-1.0))) == {"forecast_not_negative"}


def weekly_series(spark, values):
    """One long pair whose daily sales are the given values."""
    start = dt.date(2024, 1, 1)
    rows = [{"TransDate": start + dt.timedelta(days=i), "LocationId": "S", "ItemId": "I",
             "ItemLocationId": 1, "isMatrix": 1, "StockStartQty": 9.0, "StockEndQty": 9.0,
             "SalesQty": float(v), "SalesAmount": float(v) * 2, "ItemMeasure": "kg"}
            for i, v in enumerate(values)]
    params = dataclasses.replace(PARAMS, start=start, end=start + dt.timedelta(len(values) - 1))
    return Layers(raw_frame(spark, rows), params)


def test_weekday_strength_is_the_share_of_weekly_harmonics(spark):
    rng = np.random.default_rng(3)
    values = rng.gamma(2.0, 3.0, 140) + 4 * (np.arange(140) % 7 == 5)
    power = np.abs(np.fft.rfft(values - values.mean())) ** 2
    power[-1] /= 2
    share = power[[20, 40, 60]].sum() / power.sum()
    got = measures.weekday_strength(weekly_series(spark, values).days).where(
        "Variant = 'sales'").first()
    assert got.WeekdayShare == pytest.approx(share, abs=1e-9)


def test_lag_measures(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.gamma(2.0, 3.0, 100), 2)
    got = measures.lag_measures(weekly_series(spark, x).days).where("Variant = 'sales'").first()
    assert (got.Pairs1, got.Pairs7) == (99, 93)
    assert got.Acf7 == pytest.approx(np.corrcoef(x[7:], x[:-7])[0, 1])
    assert got.VarianceRatio7 == pytest.approx(
        np.var(x[7:] - x[:-7], ddof=1) / 7 / np.var(np.diff(x), ddof=1))
    assert got.SeasonalWape == pytest.approx(np.abs(x[7:] - x[:-7]).sum() / x[7:].sum())


def test_permutation_entropy(spark):
    rise = measures.permutation_entropy(weekly_series(spark, range(1, 40)).days).first()
    assert (rise.Patterns, rise.Entropy, rise.Complexity) == (1, 0, 0)
    noise = weekly_series(spark, np.random.default_rng(5).permutation(600) + 1.0).days
    for order in (3, 4):
        row = measures.permutation_entropy(noise, order).where("Variant = 'sales'").first()
        assert row.Patterns == math.factorial(order) and row.Entropy > 0.98
        assert 0 <= row.Complexity < 0.05


def test_weighted_correlation_equals_repeated_rows(spark):
    rng = np.random.default_rng(6)
    x, y, w = rng.integers(0, 6, 60), rng.integers(0, 5, 60), rng.integers(1, 5, 60)
    df = spark.createDataFrame(
        [("kg", float(a), float(b), float(c)) for a, b, c in zip(x, y, w)],
        "Branch string, X double, Y double, W double")
    got = ranking.weighted_rank_correlation(df, "X", "Y", "W").first().Correlation
    def ranks(v):
        return np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])
    a, b = np.repeat(x, w), np.repeat(y, w)
    assert got == pytest.approx(np.corrcoef(ranks(a), ranks(b))[0, 1])


def test_deciles_split_volume(spark):
    df = spark.createDataFrame(
        [(i, "kg", "q", float(i), 1.0 if i < 10 else 10.0, 2.0, 4.0) for i in range(19)],
        "ItemLocationId int, Branch string, Quadrant string, M double, W double, E double, "
        "Y double")
    rows = ranking.volume_deciles(df, "M", "W", "E", "Y").collect()
    series = {r.Decile: r.Series for r in rows}
    assert series[1] == 10 and all(series[d] == 1 for d in range(2, 11))
    assert {r.Wape for r in rows} == {0.5}


def test_benjamini_hochberg(spark):
    p = [0.001, 0.008, 0.039, 0.041, 0.042, 0.06, 0.074, 0.205]
    df = spark.createDataFrame([("kg", v) for v in p], "Branch string, p double")
    rows = {r.p: r.Significant for r in calendar.benjamini_hochberg(df, "p", 0.05).collect()}
    assert [v for v in p if rows[v]] == [0.001, 0.008]


def test_classes_and_their_checks(layers):
    profile = layers.base
    def failed(ladder, share):
        classified = ranking.assign_classes(profile, ladder, "rest", 3)
        rows = assemble(ranking.class_checks(classified, 3, share)).collect()
        return {r.CheckName for r in rows if r.Status != "ok"}
    ladder = [("dense", "ZeroShare = 0")]
    assert failed(ladder, 0.03) == set()
    # The return makes pair 13 the only one that is not dense.
    assert failed(ladder, 0.99) == {"class_revenue_share"}
    assert failed([("", "true")], 0.0) == {"class_assigned"}


def test_sample_is_stable_and_bounded(quadrant_layers):
    profile = quadrant_layers.base
    one = ranking.stratified_sample(profile, 1, 7, ["Branch"])
    again = ranking.stratified_sample(profile.repartition(3), 1, 7, ["Branch"])
    assert one.count() == 1
    assert one.first().ItemLocationId == again.first().ItemLocationId
    assert ranking.stratified_sample(profile, 9, 7, ["Branch"]).count() == 4


def test_special_day_against_its_weekday(spark):
    values = [5.0] * 42
    values[21] = 10.0
    layers = weekly_series(spark, values)
    date = dt.date(2024, 1, 22)
    dates = spark.createDataFrame([(date, "feast")], "TransDate date, DayType string")
    row = calendar.special_days(layers.days, dates).first()
    assert (row.TransDate, row.Usual, row.Ratio) == (date, 5.0, 2.0)


def test_matrix_runs(layers):
    rows = {r.ItemLocationId: r for r in lifecycle.matrix_runs(layers.days).collect()}
    # Pair 13 has no row on the 10th and is off the matrix on the 12th.
    assert (rows[13].Runs, rows[13].MatrixDays, rows[13].LongestRun) == (3, 12, 7)
    assert rows[21].Runs == 1 and 22 not in rows


def test_ramp_up(spark):
    weekly = [0, 1, 2, 4, 6, 8, 10] + [10] * 10
    values = [q if d == 0 else 0 for q in weekly for d in range(7)]
    values[0] = 0.1
    row = lifecycle.ramp_up(weekly_series(spark, values).days).first()
    # The mean of weeks 4-7 is 7, of weeks 5-8 it is 8.5, within a quarter of the level 10.
    assert (row.Level, row.StableWeek) == (10, 8)


def test_trend_and_shift(spark):
    values = [w for w in range(1, 13) for _ in range(7)]
    rows = trend.weekly_trend(weekly_series(spark, values).days).collect()
    assert [(r.Weeks, r.Tau, r.SenSlope) for r in rows] == [(12, 1.0, 7.0)]
    flat = trend.weekly_trend(weekly_series(spark, [3.0] * 70).days).first()
    assert flat.Tau is None and flat.SenSlope == 0
    stepped = weekly_series(spark, [4.0] * 28 + [6.0] * 28)
    row = trend.known_shift(stepped.days, dt.date(2024, 1, 29), ["Branch"]).first()
    assert (row.DaysAfter, row.Shift) == (28, 1.5)


def test_neighbours_stay_inside_the_branch(spark):
    """A piece item out of stock is no neighbour of a kg item of the same subgroup."""
    sold_out = {n: Point(1, 3.0, 0.0, 3.0, 30.0) for n in (6, 13)}
    rows = rows_of("north", "roll", 101, ALL_DAYS, Point(1, 3.0, 3.0, 3.0, 30.0), sold_out)
    rows += rows_of("north", "bun", 102, ALL_DAYS,
                    lambda n: Point(1, 9.0, 9.0, 8.0 if n == 6 else 4.0, 40.0))
    rows += rows_of("north", "rye", 103, ALL_DAYS, Point(1, 9.0, 9.0, 2.0, 20.0))
    days = Layers(raw_frame(spark, rows), PARAMS).days
    got = {r.Branch: r for r in links.substitution(days, ["Branch"]).collect()}
    assert got == {}
    rows[10].update(StockEndQty=3.0)
    days = Layers(raw_frame(spark, rows), PARAMS).days
    row = {r.Branch: r for r in links.substitution(days, ["Branch"]).collect()}
    assert set(row) == {"pcs"} and row["pcs"].Effect == 2.0


def test_other_stores_leave_the_pair_out(spark):
    rows = []
    for pair, store, sign in ((101, "north", 1), (102, "quay", 1), (103, "mill", -1)):
        rows += rows_of(store, "roll", pair, ALL_DAYS, lambda n, s=sign: Point(
            1, 50.0, 50.0, 20.0 + s * (n - 9), 10.0))
    got = {r.ItemLocationId: r.Correlation for r in links.other_stores_correlation(
        Layers(raw_frame(spark, rows), PARAMS).days).collect()}
    # The others of the mill rise twice while it falls; for the north the other two cancel out.
    assert got[103] == pytest.approx(-1) and got[101] is None


def test_price_elasticity(spark):
    prices = [1.0, 1.0, 2.0, 2.0, 2.0, 4.0]
    values = [8.0 / p for p in prices for _ in range(7)]
    rows = weekly_series(spark, values).raw.withColumn(
        "SalesAmount", F.lit(8.0))
    days = Layers(rows, dataclasses.replace(
        PARAMS, start=dt.date(2024, 1, 1), end=dt.date(2024, 2, 11))).days
    row = links.price_elasticity(days).first()
    assert (row.Weeks, row.PriceSteps) == (6, 1)
    assert row.Elasticity == pytest.approx(-1)


def test_abc_comparisons(layers):
    overlap = {(r.RuleA, r.RuleB, r.Branch): r for r in
               abc_compare.top_overlap(layers.base).collect()}
    row = overlap["AbcRevenueStore", "AbcRevenueSubgroup", "kg"]
    assert (row.Both, row.Either) == (3, 3)
    table = layers.raw.sparkSession.createDataFrame(
        [("A", "A", 10), ("B", "B", 10)], "FromClass string, ToClass string, Pairs int")
    assert abc_compare.cramers_v(table).first().CramersV == pytest.approx(1)
    agreement = {r.ItemId: r for r in abc_compare.store_agreement(
        layers.base, "AbcRevenueStore").collect()}
    assert agreement["rye"].Stores == 2


def test_weighted_quantiles_of_special_days(spark):
    special = spark.createDataFrame(
        [("kg", "feast", 1.0, 1.0), ("kg", "feast", 2.0, 1.0), ("kg", "feast", 3.0, 8.0)],
        "Branch string, DayType string, Ratio double, Usual double")
    row = calendar.special_day_quantiles(special, ["Branch"], (0.1, 0.2, 0.5)).first()
    assert (row.Q10, row.Q20, row.Q50) == (1.0, 2.0, 3.0)


def test_trend_of_long_series(spark):
    """Seven years of weeks, as long as the calendar: by the square of the weeks, not their cube."""
    rng = np.random.default_rng(3)
    rows = [(pair, day(1) + dt.timedelta(weeks=int(w)), float(v)) for pair in range(8)
            for w, v in enumerate(rng.integers(0, 40, 364) + pair * np.arange(364) // 50)]
    days = spark.createDataFrame(rows, "ItemLocationId long, TransDate date, ValueSales double")
    start = time.monotonic()
    got = {r.ItemLocationId: r for r in trend.weekly_trend(days).collect()}
    assert time.monotonic() - start < 60
    for pair in range(8):
        y = np.array([v for p, _, v in rows if p == pair])
        i, j = np.triu_indices(364, 1)
        rise = y[j] - y[i]
        assert got[pair].Tau == pytest.approx(np.sign(rise).sum() / math.sqrt(len(rise) * (rise != 0).sum()))
        assert got[pair].SenSlope == pytest.approx(np.median(rise / (j - i)))
        _, equal = np.unique(y, return_counts=True)
        variance = (364 * 363 * 733 - (equal * (equal - 1) * (2 * equal + 5)).sum()) / 18
        score = np.sign(rise).sum()
        assert got[pair].Z == pytest.approx((score - np.sign(score)) / math.sqrt(variance))


def test_series_on_the_bound_is_jumpy(spark):
    """49 sale days whose Cv2 is 0.49 exactly; the mean, 45 / 7, is not."""
    values = [1.0] * 6 + [2.0] * 16 + [6.0] * 4 + [11.0] * 23
    for row in weekly_series(spark, values).profile_pairs.collect():
        assert (row.SalesDays, row.VariantQty, row.Cv2, row.Quadrant) == (49, 315, 0.49, labels.ERRATIC)
