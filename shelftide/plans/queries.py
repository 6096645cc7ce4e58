"""Registered queries: every operator group over the whole given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelftide.checks.contract import (
    ContractRules, contract_checks, daily_volume, volume_outliers)
from shelftide.checks.forecast_checks import forecast_checks
from shelftide.checks.journal import assemble
from shelftide.checks.profile_checks import profile_checks
from shelftide.checks.series_checks import (
    branch_checks, branch_totals, series_checks, source_totals)
from shelftide.functions import labels
from shelftide.functions.expressions import normal_tail
from shelftide.operators import (
    abc_compare, baselines, calendar, drift, fingerprint, frontier, lifecycle, links, measures,
    ranking, series, series_measures, trend)
from shelftide.operators.baselines import Backtest
from shelftide.operators.hierarchy import hierarchy_paths
from shelftide.operators.pivot import Dimension, Figure, manifest, report
from shelftide.params import EVENTS_PARAMS, LINEITEM_PARAMS
from shelftide.plans import population
from shelftide.plans.layers import Layers
from shelftide.plans.pipeline import Build
from shelftide.session import materialise, run_folder
from shelftide.sources import storage
from shelftide.sources.adapters import facts_events, facts_lineitem, hierarchy_edges
from shelftide.sources.facts import with_rollups

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def lineitem(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(facts_lineitem(spark, sf_dir), LINEITEM_PARAMS)


THREE_YEARS = replace(LINEITEM_PARAMS, start=dt.date(1998, 1, 1), end=dt.date(2000, 12, 31))


def events(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(facts_events(spark, sf_dir), EVENTS_PARAMS)


def rounded(df: DataFrame, digits: dict[str, int] | None = None, default: int = 6) -> DataFrame:
    """Doubles rounded to a fixed number of places, so that the order of addition does not
    show in a comparison of results. Ratios of small numbers often end exactly on a rounding
    tie; the tiny shift takes them off it."""
    digits = digits or {}

    def shown(name: str) -> Column:
        value = F.col(f"`{name}`")
        places = digits.get(name)
        return F.round(value + 1e-9, default) if places is None else F.round(value, places)

    return df.select(*[
        shown(f.name).alias(f.name) if f.dataType.typeName() == "double"
        else F.col(f"`{f.name}`") for f in df.schema])


MONEY = {"Revenue": 2, "SalesAmount": 2, "SalesQty": 2, "SalesQtyTotal": 2, "VariantQty": 2,
         "ValueSales": 2, "ValueDemand": 2, "Value": 2}


@query
def facts_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of three years: the period is what this query shows; all others read all lines."""
    return rounded(Layers(facts_lineitem(spark, sf_dir), THREE_YEARS).facts, MONEY)


@query
def store_revenue_outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(lineitem(spark, sf_dir).stores, MONEY)


@query
def pair_life_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).pairs


@query
def series_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(lineitem(spark, sf_dir).days, MONEY)


@query
def series_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(series.positions(events(spark, sf_dir).arrays), MONEY)


@query
def array_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).arrays.select(
        "ItemLocationId", "Variant", "FirstDay", "LastDay",
        F.size("Values").alias("Length"), F.size("Deficit").alias("DeficitLength"),
        F.size(F.filter("Values", lambda v: v.isNotNull())).alias("Points"),
        F.size(F.filter("Deficit", lambda v: v == 1)).alias("DeficitPoints"))


@query
def profile_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(lineitem(spark, sf_dir).profile_pairs.where(
        F.col("Variant") == labels.SALES).select(
        "ItemLocationId", "Cohort", "Scope", "OutlierStore", "IsEmpty", "FirstActive",
        "LastActive", "LifeDays", "MatrixDays", "MatrixDaysOutLife", "SrcRows",
        "SalesQtyTotal", "Revenue", "RevenueOutMatrixShare", "Price"), MONEY)


@query
def profile_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(lineitem(spark, sf_dir).profile_pairs.select(
        "ItemLocationId", "Variant", "VariantDays", "SalesDays", "VariantQty", "SalesLevel",
        "SalesDayShare", "ZeroShare", "Adi", "Cv2", "Quadrant"), MONEY)


@query
def profile_demand_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(events(spark, sf_dir).profile_pairs.select(
        "ItemLocationId", "Variant", "Branch", "LifeDays", "MatrixDays", "VariantDays",
        "SalesDays", "VariantQty", "ZeroShare", "Adi", "Cv2", "Quadrant"), MONEY)


@query
def profile_deficit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(lineitem(spark, sf_dir).profile_pairs.select(
        "ItemLocationId", "Variant", "DeficitDays", "DeficitDayShare", "DeficitSalesShare"))


@query
def abc_six_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).abc


@query
def profile_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(lineitem(spark, sf_dir).base, MONEY)


@query
def pivot_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population.cohorts(lineitem(spark, sf_dir).profile_pairs).rows


@query
def pivot_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population.demand_classes(lineitem(spark, sf_dir).profile_pairs).rows


@query
def pivot_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population.not_applicable(lineitem(spark, sf_dir).profile_pairs).rows


@query
def pivot_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(
        "stores", "Stores by network and format", lineitem(spark, sf_dir).profile_pairs,
        [population.BRANCH, Dimension("LocationNetwork", "network"),
         Dimension("LocationId", "store")],
        [population.PAIRS, population.REVENUE,
         Figure("matrix days", "sum(MatrixDays)", share=True)], "Variant = 'sales'").rows


@query
def pivot_matrix_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric key: sorted as a number, shown as text."""
    return report(
        "matrix_days", "Pairs by matrix days", lineitem(spark, sf_dir).profile_pairs,
        [population.BRANCH, Dimension("MatrixDays", "matrix days")],
        [population.PAIRS, population.REVENUE], "Variant = 'sales'").rows


@query
def table_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = population.population(materialise(lineitem(spark, sf_dir).profile_pairs, "profile"))
    listed = manifest(spark, tables)
    counted = None
    for table in tables:
        rows = table.rows.agg(F.count(F.lit(1)).alias("table_rows")).select(
            F.lit(table.key).alias("name"), "table_rows")
        counted = rows if counted is None else counted.unionByName(rows)
    return listed.join(counted, "name").select(
        "name", F.array_join("keys", ",").alias("keys"),
        F.array_join("block", ",").alias("block"),
        F.array_join("measures", ",").alias("measures"), "table_rows")


@query
def fingerprint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _written(lineitem(spark, sf_dir))
    return layers.raw.agg(
        F.count(F.lit(1)).alias("SrcRows"),
        F.count_distinct("ItemLocationId").alias("SrcPairs")).crossJoin(
        fingerprint.layer_counts(layers.days, layers.profile_pairs))


@query
def fingerprint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one row that goes with a report, over written facts and days. Which files the facts lie in is the
    cluster's affair, so of their number and bytes only that they are known is shown."""
    layers = _written(lineitem(spark, sf_dir))
    row = fingerprint.fingerprint(layers.raw, layers.days, layers.profile_pairs)
    known = (F.col("SrcFiles") > 0) & (F.col("SrcBytes") > 0)
    return row.withColumn("FilesKnown", known).drop("SrcFiles", "SrcBytes")


@query
def fingerprint_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and content mark of all lines."""
    raw = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return fingerprint.source_mark(raw, raw.columns).select("SrcRows", "SrcHash")


@query
def source_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = lineitem(spark, sf_dir)
    return source_totals(layers.raw, layers.params)


def _journal(parts: list[DataFrame]) -> DataFrame:
    return rounded(assemble(parts).drop("Details", "RunAt"))


def _written(layers: Layers) -> Layers:
    """The same layers over written raw facts and days, as the checks meet them."""
    out = Layers(materialise(layers.raw, "raw"), layers.params)
    out.written_facts = out.facts  # a projection of what is written already
    out.days = materialise(out.days, "days")
    return out


@query
def check_branch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _written(lineitem(spark, sf_dir))
    return _journal([branch_checks(
        branch_totals(layers.facts, layers.days, layers.params), "days")])


@query
def check_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _written(lineitem(spark, sf_dir))
    return _journal(series_checks(layers.raw, layers.facts, layers.days, layers.arrays,
                                  layers.params))


@query
def check_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = lineitem(spark, sf_dir)
    base = materialise(layers.base, "base")  # the days are read once here, so they are not written
    return _journal(profile_checks(layers.written_facts, base, series.pairs(layers.written_summary), layers.params))


@query
def hierarchy_path_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = hierarchy_paths(hierarchy_edges(spark, sf_dir), "NodeId", "ParentId", "NodeName")
    return paths.select(
        "LevelId", "ParentLevelId", "LevelName",
        F.array_join("LevelIdList", "/").alias("LevelIdTree"),
        F.size("LevelNameList").alias("Depth"), "LevelNameTree")


def _exchange_path(spark: SparkSession, kind: str) -> str:
    return f"{run_folder(spark)}/{kind}-{uuid.uuid4().hex}"


@query
def text_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs written as delimited text with names and types and read back by name."""
    path = _exchange_path(spark, "text")
    storage.write_text_with_types(lineitem(spark, sf_dir).pairs, path)
    return storage.read_text_with_types(spark, path)


@query
def json_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _exchange_path(spark, "json")
    frame = lineitem(spark, sf_dir).pairs
    storage.write_json_lines(frame, path)
    return storage.read_json_lines(spark, path, frame.schema)


@query
def layered_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days, profile and tables written layer by layer behind their gates."""
    build = Build(spark, materialise(facts_lineitem(spark, sf_dir), "raw"), LINEITEM_PARAMS,
                  _exchange_path(spark, "build"))
    build.run()
    return rounded(build.layer("profile_base"), MONEY)


LINEITEM_RULES = ContractRules(top_group="L1")


@query
def raw_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = materialise(with_rollups(facts_lineitem(spark, sf_dir), ["SalesByLocationAmount"]),
                      "raw")
    return _journal(contract_checks(raw, LINEITEM_PARAMS, LINEITEM_RULES))


@query
def daily_volume_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume_outliers(daily_volume(facts_lineitem(spark, sf_dir)), LINEITEM_RULES)


@query
def order_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = lineitem(spark, sf_dir)
    return rounded(frontier.order_frontier(layers.days, layers.params))


@query
def frontier_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = lineitem(spark, sf_dir)
    base = layers.base
    return rounded(frontier.frontier_curve(
        frontier.order_frontier(layers.days, layers.params), base,
        ["Branch", "AbcRevenueStore"]))


@query
def frontier_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curve by every ABC rule, subgroup and format, and of the branch as a whole."""
    layers = lineitem(spark, sf_dir)
    return rounded(frontier.frontier_cuts(
        frontier.order_frontier(layers.days, layers.params), layers.base))


@query
def frontier_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = lineitem(spark, sf_dir)
    return rounded(frontier.actual_point(layers.days, layers.params,
                                         ["Branch", "LocationNetwork"]))


@query
def frontier_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = lineitem(spark, sf_dir)
    keys = ["Branch", "Scope"]
    curve = frontier.frontier_curve(frontier.order_frontier(layers.days, layers.params),
                                    layers.profile_pairs, keys)
    return rounded(frontier.target_quantiles(curve, keys, (0.35, 0.50, 0.75, 0.80)))


@query
def abc_top_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(abc_compare.top_overlap(lineitem(spark, sf_dir).base))


@query
def abc_store_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(abc_compare.store_agreement(lineitem(spark, sf_dir).base, "AbcRevenueStore"))


def _quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = lineitem(spark, sf_dir)
    layers.days = materialise(layers.days, "days")
    return abc_compare.quarter_classes(layers.days, layers.profile_pairs, layers.params)


@query
def abc_quarter_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abc_compare.transitions(_quarters(spark, sf_dir), "AbcRevenueStore")


@query
def abc_quarter_association(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = abc_compare.transitions(_quarters(spark, sf_dir), "AbcQtyStore")
    return rounded(abc_compare.cramers_v(materialise(table, "transitions")))


# The event period has 30 days, so history and window are short.
EVENTS_TEST = Backtest(window_start=dt.date(2024, 1, 18), window_days=10, history_days=14,
                       min_history=4)


def _event_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baselines.forecasts(events(spark, sf_dir).arrays, EVENTS_TEST)


@query
def baseline_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_event_forecasts(spark, sf_dir))


@query
def baseline_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(baselines.forecast_errors(_event_forecasts(spark, sf_dir), EVENTS_TEST))


HORIZON_GROUPS = {"2-3": (2, 3), "5-7": (5, 7)}


@query
def error_by_horizon_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = events(spark, sf_dir)
    errors = baselines.forecast_errors(baselines.forecasts(layers.arrays, EVENTS_TEST), EVENTS_TEST)
    attributes = layers.pairs.select("ItemLocationId", "LocationNetwork")
    return rounded(baselines.errors_by_horizons(
        errors.join(attributes, "ItemLocationId"), HORIZON_GROUPS, ["LocationNetwork"]))


def _measured_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of every series beside the error of its mean forecast over days 2-3."""
    layers = events(spark, sf_dir)
    errors = baselines.errors_by_horizons(
        baselines.forecast_errors(baselines.forecasts(layers.arrays, EVENTS_TEST), EVENTS_TEST),
        HORIZON_GROUPS, ["ItemLocationId"]).where("Model = 'mean' and Horizons = '2-3'")
    profile = layers.profile_pairs.select("ItemLocationId", "Variant", "Branch", "ZeroShare")
    joined = profile.join(errors, ["ItemLocationId", "Variant"]).where("Variant = 'sales'")
    # Equal values must be equal to the last bit to share a rank.
    return materialise(joined.withColumns({n: F.round(n, 9) for n in ("ZeroShare", "Wape")}),
                       "measured-errors")


@query
def measure_error_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does the error follow the share of zeros? Weighted rank correlation by branch."""
    return rounded(ranking.weighted_rank_correlation(
        _measured_errors(spark, sf_dir), "ZeroShare", "Wape", "Actual"))


@query
def measure_error_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.volume_deciles(
        _measured_errors(spark, sf_dir), "ZeroShare", "Actual", "AbsError", "Actual", ["Branch"]))


@query
def baseline_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = events(spark, sf_dir)
    attributes = layers.pairs.select("ItemLocationId", "ItemId")
    return rounded(baselines.calibration(
        baselines.forecasts(layers.arrays, EVENTS_TEST), attributes, ["ItemId"], EVENTS_TEST))


@query
def check_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _journal(forecast_checks(_event_forecasts(spark, sf_dir), EVENTS_TEST))


@query
def weekday_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(measures.weekday_strength(events(spark, sf_dir).days)).drop("Weekdays")


@query
def weekday_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of series by branch whose weekly rhythm stays significant among all tests."""
    days = events(spark, sf_dir).days
    branches = days.groupBy("ItemLocationId").agg(F.max("Branch").alias("Branch"))
    tested = measures.weekday_significance(measures.weekday_strength(days)).where(
        "Variant = 'sales'").withColumn("P", F.round("P", 9))
    tests = materialise(tested.join(branches, "ItemLocationId"), "tests")
    marked = calendar.benjamini_hochberg(tests, "P", 0.2, ["Branch"])
    return rounded(marked.groupBy("Branch").agg(
        F.count("*").alias("Series"), F.count_if("Significant").alias("SignificantSeries"),
        F.min("P").alias("SmallestP")))


@query
def lag_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(measures.lag_measures(events(spark, sf_dir).days))


@query
def permutation_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(measures.permutation_entropy(events(spark, sf_dir).days))


def _demand_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`sales` rows of the profile, written once: ranking reads them several times."""
    return materialise(lineitem(spark, sf_dir).profile_pairs.where(
        F.col("Variant") == labels.SALES), "ranked-profile")


@query
def rank_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.weighted_rank_correlation(
        _demand_profile(spark, sf_dir), "ZeroShare", "DeficitDayShare", "SalesQtyTotal"))


@query
def volume_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = _demand_profile(spark, sf_dir).withColumn(
        "DeficitQty", F.coalesce(F.col("DeficitSalesShare") * F.col("VariantQty"), F.lit(0.0)))
    return rounded(ranking.volume_deciles(profile, "ZeroShare", "SalesQtyTotal", "DeficitQty",
                                          "VariantQty"))


@query
def measure_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["Adi", "Cv2", "DeficitDayShare"]
    # Equal values must be equal to the last bit to share a rank.
    profile = _demand_profile(spark, sf_dir).withColumns(
        {name: F.round(name, 9) for name in names})
    return rounded(ranking.measure_correlations(profile, names))


CLASS_LADDER = (("no structure", "ZeroShare >= 0.6"), ("level", "Quadrant = 'smooth'"),
                ("jumpy", "Cv2 >= 0.49"))
CLASS_MIN_DAYS = 4


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.assign_classes(lineitem(spark, sf_dir).profile_pairs, CLASS_LADDER, "mixed",
                                  CLASS_MIN_DAYS)


@query
def predictability_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.class_shares(_classified(spark, sf_dir)), MONEY)


DECISIONS = {"no structure": "stock rule", "level": "simple model", "jumpy": "own model",
             "mixed": "calendar model"}
CLASS_RULES = ranking.ClassRules(CLASS_LADDER, "mixed", CLASS_MIN_DAYS, DECISIONS)


@query
def class_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to do with each class, and how much of top and tail it holds."""
    classified = ranking.classified_profile(lineitem(spark, sf_dir).base, CLASS_RULES)
    return rounded(ranking.class_decisions(classified, "AbcRevenueStore"))


@query
def check_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _journal(ranking.class_checks(_classified(spark, sf_dir), CLASS_MIN_DAYS))


@query
def stratified_sample_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled series per cell against the whole cell."""
    profile = lineitem(spark, sf_dir).profile_pairs
    whole = profile.where(F.col("Variant") == labels.SALES).groupBy("Quadrant", "Branch").agg(
        F.count(F.lit(1)).alias("Series"))
    sample = ranking.stratified_sample(profile, 25, 41).groupBy(
        "Quadrant", "Branch").agg(F.count(F.lit(1)).alias("Sampled"))
    return whole.join(sample, ["Quadrant", "Branch"], "left")


@query
def stratified_sample_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled series themselves."""
    return ranking.stratified_sample(lineitem(spark, sf_dir).profile_pairs, 25, 41).select(
        "ItemLocationId", "Quadrant", "Branch")


SPECIAL = [(dt.date(2024, 1, 1), "holiday"), (dt.date(2024, 1, 15), "mid month")]


@query
def weekday_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(calendar.weekday_index(events(spark, sf_dir).days,
                                          ["Branch", "LocationFormatTT"]))


@query
def special_day_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = spark.createDataFrame(SPECIAL, "TransDate date, DayType string")
    return rounded(calendar.special_day_effect(
        calendar.special_days(events(spark, sf_dir).days, dates), ["Branch"]))


@query
def special_day_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = spark.createDataFrame(SPECIAL, "TransDate date, DayType string")
    special = calendar.special_days(events(spark, sf_dir).days, dates)
    # Equal ratios must be equal to the last bit to be one value.
    return rounded(calendar.special_day_quantiles(
        special.withColumn("Ratio", F.round("Ratio", 9)), ["Branch"]))


@query
def year_over_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(calendar.year_over_year(lineitem(spark, sf_dir).days, ["Branch"]))


@query
def significant_variance_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variance-ratio tests of all series at once: both tails of the normal distribution beyond
    z = (VR - 1) / sqrt(2(2k-1)(k-1) / (3kN)), k = 7."""
    lags = measures.lag_measures(events(spark, sf_dir).days)
    z = (F.col("VarianceRatio7") - 1) / F.sqrt(F.lit(156.0) / (21 * F.col("Pairs1")))
    tests = materialise(lags.where("Variant = 'sales' and VarianceRatio7 is not null").select(
        "ItemLocationId", "Variant",
        F.round(normal_tail(z), 9).alias("P")), "tests")
    return rounded(calendar.benjamini_hochberg(tests, "P", 0.2, ["Variant"])).withColumn(
        "Significant", F.col("Significant").cast("int"))


@query
def matrix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.matrix_runs(events(spark, sf_dir).days)


@query
def matrix_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.matrix_entries(events(spark, sf_dir).days, ["Branch", "LocationFormatTT"],
                                    EVENTS_PARAMS.start, EVENTS_PARAMS.end)


@query
def ramp_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all pairs; for those on sale when the facts begin, life begins with their first active day."""
    return rounded(lifecycle.ramp_up(lineitem(spark, sf_dir).days))


@query
def weekly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trend.weekly_trend(lineitem(spark, sf_dir).days, min_weeks=3))


@query
def known_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trend.known_shift(lineitem(spark, sf_dir).days, dt.date(1999, 7, 1),
                                     ["Branch", "LocationNetwork"]))


@query
def deficit_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = lineitem(spark, sf_dir)
    return rounded(links.deficit_frequency(layers.days, layers.base, "AbcRevenueStore"))


@query
def deficit_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of sales minus those of demand."""
    return rounded(links.deficit_effect(
        lineitem(spark, sf_dir).profile_pairs, ["SalesLevel", "ZeroShare", "Adi", "Cv2"], ["Branch", "Scope"]))


@query
def weekly_profile_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(links.weekly_profile_similarity(events(spark, sf_dir).days))


@query
def other_stores_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(links.other_stores_correlation(events(spark, sf_dir).days))


@query
def common_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(links.common_factors(events(spark, sf_dir).days), default=5)


@query
def lagged_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What store and subgroup of 1 to 7 days before say about a pair's day."""
    return rounded(links.lagged_factors(events(spark, sf_dir).days), default=5)


@query
def substitution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(links.substitution(events(spark, sf_dir).days, ["Branch"]))


@query
def price_elasticity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(links.price_elasticity(lineitem(spark, sf_dir).days))


@query
def drift_weekday_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(drift.weekday_level(lineitem(spark, sf_dir).days, ["Branch"]))


DRIFT_WINDOWS = ((dt.date(1999, 1, 1), dt.date(1999, 12, 31)),
                 (dt.date(2000, 1, 1), dt.date(2000, 12, 31)))


@query
def drift_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(drift.population_stability(
        lineitem(spark, sf_dir).days, "SalesQty", (1, 5, 10, 20, 30, 40, 50), *DRIFT_WINDOWS,
        ["Branch", "LocationNetwork"]))


@query
def drift_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(drift.window_shares(lineitem(spark, sf_dir).days, *DRIFT_WINDOWS,
                                       ["Branch", "Scope"]))


#: Quarters of the whole period; the range was changed in July 1999.
QUARTERS = drift.MonthWindows(LINEITEM_PARAMS.start, 3, 28, [dt.date(1999, 7, 1)])
YEARS = drift.MonthWindows(LINEITEM_PARAMS.start, 12, 7)


@query
def drift_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New, returned and withdrawn stores, items and pairs, quarter by quarter."""
    return rounded(drift.composition(lineitem(spark, sf_dir).days, QUARTERS))


@query
def drift_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = lineitem(spark, sf_dir)
    return rounded(drift.target_windows(layers.days, layers.params, QUARTERS, ["Branch"], 0.75, 0.05))


@query
def drift_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the distribution of daily sales moved from one year to the next."""
    return rounded(drift.distribution_distance(lineitem(spark, sf_dir).days, "ValueSales", YEARS,
                                               ["Branch", "LocationNetwork"]))


def _event_measures(layers: Layers) -> DataFrame:
    return series_measures.array_measures(materialise(layers.arrays, "arrays"), SHORT_SERIES)


@query
def array_measure_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of short series, few of which are long enough."""
    return rounded(_event_measures(events(spark, sf_dir)))


@query
def array_measure_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same measures on items over all stores, whose series are long and mostly unbroken."""
    raw = facts_lineitem(spark, sf_dir)
    kept = ("ItemId", "ItemMeasure", "ItemIdLevel1", "ItemIdLevel2", "ItemIdLevel3")
    items = raw.groupBy("TransDate", *kept).agg(
        *[F.sum(c).alias(c) for c in ("StockStartQty", "StockEndQty", "SalesQty",
                                      "SalesAmount")], F.max("isMatrix").alias("isMatrix"))
    whole = items.select(
        "*", F.lit("all").alias("LocationId"), F.lit("all").alias("LocationNetwork"),
        F.lit("all").alias("LocationFormatTT"),
        F.expr("cast(substr(ItemId, 7) as bigint)").alias("ItemLocationId"))
    # Few and long series: each task takes some of them.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    arrays = materialise(Layers(whole, LINEITEM_PARAMS).arrays.repartition(parts, "ItemLocationId"), "arrays")
    return rounded(series_measures.array_measures(arrays))


@query
def measure_applicability(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = events(spark, sf_dir)
    statuses = [f"{m}Status" for m in series_measures.MEASURES]
    flags = ranking.applicability(
        layers.profile_pairs, _event_measures(layers), statuses, {"NaiveGainStatus": "excluded", "PacfOrderStatus": "limited"})
    return rounded(flags.groupBy("Branch", "Variant", *statuses).agg(
        F.count(F.lit(1)).alias("Series"), F.sum("Revenue").alias("Revenue")), MONEY)


# The events cover 30 days, so every minimum length is lowered accordingly.
SHORT_SERIES = series_measures.Settings(
    min_length=8, min_length_sampen=12, min_length_dfa=28, dfa_windows=(4, 7, 10, 14),
    pacf_lags=7)
