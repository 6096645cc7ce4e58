"""Weighted ranks, volume deciles, correlations between measures, classes, samples.

Ranks run over a whole branch, which may be most of the data: values are first combined per
distinct value, then ranked in range blocks (`running.running_total`), never in one window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame, Window, functions as F

from shelftide.checks.journal import check, rows_of, text
from shelftide.functions import labels
from shelftide.functions.expressions import exact, map_values, ratio
from shelftide.operators.running import running_total


def _ranked(df: DataFrame, keys: Sequence[str], column: str, weight: str,
            name: str) -> DataFrame:
    """Join the mid-rank of each distinct value: the weight before it plus half of its own."""
    values = df.groupBy(*keys, column).agg(F.sum(weight).alias("__w"))
    running = running_total(values, keys, [F.col(column).asc()], "__w", "__upto")
    return df.join(
        running.select(*keys, column, (F.col("__upto").cast("double")
                                       - F.col("__w").cast("double") / 2).alias(name)),
        [*keys, column])


def weighted_rank_correlation(df: DataFrame, x: str, y: str, weight: str,
                              keys: Sequence[str] = ("Branch",)) -> DataFrame:
    """Spearman correlation with weights: Pearson of weighted mid-ranks, from six sums."""
    rows = (df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & (F.col(weight) > 0))
            .select(*keys, F.col(x).alias("__x"), F.col(y).alias("__y"),
                    exact(F.col(weight)).alias("__weight")))
    ranked = _ranked(_ranked(rows, keys, "__x", "__weight", "rx"), keys, "__y", "__weight", "ry")
    # Ranks relative to the total weight keep the sums of squares small.
    w = F.col("__weight").cast("double")
    rx, ry = F.col("rx"), F.col("ry")
    sums = ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("Rows"), F.sum(w).alias("w"), F.sum(w * rx).alias("x"),
        F.sum(w * ry).alias("y"), F.sum(w * rx * ry).alias("xy"),
        F.sum(w * rx * rx).alias("xx"), F.sum(w * ry * ry).alias("yy"))
    c = {n: F.col(n) for n in ("w", "x", "y", "xy", "xx", "yy")}

    def spread_of(sum_, squares):
        """Null where all ranks are equal and only rounding is left of their variance."""
        left = c["w"] * c[squares] - c[sum_] * c[sum_]
        return F.when(left > 1e-12 * c["w"] * c[squares], left)

    spread = F.sqrt(spread_of("x", "xx") * spread_of("y", "yy"))
    return sums.select(*keys, "Rows", ratio(c["w"] * c["xy"] - c["x"] * c["y"], spread)
                       .alias("Correlation"))


def volume_deciles(df: DataFrame, measure: str, weight: str, error: str, actual: str,
                   keys: Sequence[str] = ("Branch", "Quadrant")) -> DataFrame:
    """Deciles of volume, not of series, in the order of a measure, with the error of each."""
    rows = (df.where(F.col(measure).isNotNull() & (F.col(weight) > 0))
            .withColumn("__weight", exact(F.col(weight))))
    placed = running_total(rows, keys, [F.col(measure).asc(), F.col("ItemLocationId").asc()],
                           "__weight", "__upto", total="__all")
    share = F.col("__upto").cast("double") * 10 / F.col("__all").cast("double")
    return (
        placed.withColumn("Decile", F.ceil(share).cast("int"))
        .groupBy(*keys, "Decile")
        .agg(F.count(F.lit(1)).alias("Series"), F.min(measure).alias("LowMeasure"),
             F.max(measure).alias("HighMeasure"), F.sum(actual).alias("Actual"),
             F.sum(error).alias("AbsError"))
        .withColumn("Wape", ratio(F.col("AbsError"), F.col("Actual"))))


def measure_correlations(df: DataFrame, measures: Sequence[str],
                         keys: Sequence[str] = ("Branch",)) -> DataFrame:
    """Correlation of percent ranks for every two measures, by branch, over the rows where
    both are known."""
    ranked = df
    for name in measures:
        known = df.where(F.col(name).isNotNull())
        values = known.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("__n"))
        running = running_total(values, keys, [F.col(name).asc()], "__n", "__upto",
                                total="__all")
        below = (F.col("__upto") - F.col("__n")).cast("double")
        ranked = ranked.join(
            running.select(*keys, name, F.try_divide(
                below, (F.col("__all") - 1).cast("double")).alias(f"r_{name}")),
            [*keys, name], "left")
    pairs = list(combinations(measures, 2))
    table = ranked.groupBy(*keys).agg(*[
        F.corr(f"r_{a}", f"r_{b}").alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return table.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(a).alias("MeasureA"), F.lit(b).alias("MeasureB"),
                 F.col(f"c{i}").alias("Correlation")) for i, (a, b) in enumerate(pairs)])))


def assign_classes(profile: DataFrame, ladder: Sequence[tuple[str, str]], otherwise: str,
                   min_days: int) -> DataFrame:
    """Predictability class: the first rung whose condition holds. Too little history means
    the class does not apply."""
    result = F.lit(otherwise)
    for name, condition in reversed(list(ladder)):
        result = F.when(F.expr(condition), F.lit(name)).otherwise(result)
    return profile.withColumn(
        "Class", F.when(F.coalesce(F.col("VariantDays"), F.lit(0)) < min_days,
                        labels.NOT_APPLICABLE).otherwise(result))


@dataclass(frozen=True)
class ClassRules:
    """A ladder of classes, the class of all that no rung takes, the fewest days, and what each class asks for."""
    ladder: Sequence[tuple[str, str]]
    otherwise: str
    min_days: int
    decisions: Mapping[str, str]

    def __post_init__(self):
        if missing := {self.otherwise, *[name for name, _ in self.ladder]} - set(self.decisions):
            raise ValueError(f"classes without a decision: {sorted(missing)}")


def classified_profile(profile: DataFrame, rules: ClassRules) -> DataFrame:
    """The profile with Class and Decision; where the class does not apply, neither does a decision."""
    return assign_classes(profile, rules.ladder, rules.otherwise, rules.min_days).withColumn(
        "Decision", map_values(F.col("Class"), rules.decisions, F.lit(labels.NOT_APPLICABLE)))


def class_decisions(classified: DataFrame, top_rule: str) -> DataFrame:
    """Decision of each branch's classes with its share of pairs and of revenue, the latter also within the top
    (class A of `top_rule`) and within the tail."""
    revenue = exact(F.round("Revenue", 2))
    top = F.col(top_rule) == "A"
    sums = classified.where(F.col("Variant") == labels.SALES).groupBy("Branch", "Class", "Decision").agg(
        F.count(F.lit(1)).alias("Pairs"), F.sum(revenue).alias("All"),
        F.sum(F.when(top, revenue).otherwise(0)).alias("Top"), F.sum(F.when(top, 0).otherwise(revenue)).alias("Tail"))
    # A few classes per branch: the window sees the aggregated table only.
    branch = Window.partitionBy("Branch")
    return sums.select("Branch", "Class", "Decision", "Pairs", *[
        ratio(F.col(c), F.sum(c).over(branch)).alias(name) for c, name in (
            ("Pairs", "PairShare"), ("All", "RevenueShare"), ("Top", "TopShare"), ("Tail", "TailShare"))])


def class_shares(classified: DataFrame) -> DataFrame:
    counts = classified.where(F.col("Variant") == labels.SALES).groupBy("Branch", "Class").agg(
        F.count(F.lit(1)).alias("Pairs"), F.sum("Revenue").alias("Revenue"))
    # A few classes per branch: the window sees the aggregated table only.
    return counts.withColumn("RevenueShare", ratio(
        F.col("Revenue"), F.sum("Revenue").over(Window.partitionBy("Branch"))))


def class_checks(classified: DataFrame, min_days: int, min_share: float = 0.03) -> list[DataFrame]:
    """Each class holds at least the given share of its branch's revenue, and every series
    with enough history has a class."""
    small = class_shares(classified).where(F.col("Class") != labels.NOT_APPLICABLE).agg(
        F.coalesce(F.sum(F.when(F.col("RevenueShare") < min_share, 1).otherwise(0)), F.lit(0))
        .alias("SmallClasses"))
    bare = classified.agg(F.coalesce(F.sum(F.when(
        (F.col("VariantDays") >= min_days)
        & F.coalesce(F.col("Class"), F.lit("")).isin("", labels.NOT_APPLICABLE), 1)
        .otherwise(0)), F.lit(0)).alias("Unclassified"))
    return [rows_of(small.crossJoin(bare), [
        check("class_revenue_share", labels.ERROR, F.col("SmallClasses"),
              text("classes below the revenue share: ", F.col("SmallClasses"))),
        check("class_assigned", labels.ERROR, F.col("Unclassified"),
              text("series with enough history but no class: ", F.col("Unclassified")))])]


def stratified_sample(profile: DataFrame, per_cell: int, seed: int,
                      cell: Sequence[str] = ("Quadrant", "Branch"), buckets: int = 64) -> DataFrame:
    """The same `per_cell` series of every cell on each run: those with the lowest digests of seed
    and id.

    In two stages: each of a cell's buckets keeps its lowest, then the cell keeps the lowest of at most
    `buckets` x `per_cell` rows, so no task ranks a whole cell.
    """
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("ItemLocationId").cast("string")))
    rows = profile.where(F.col("Variant") == labels.SALES).withColumns({
        "Ticket": ticket, "Bucket": F.pmod(F.xxhash64("ItemLocationId"), F.lit(buckets))})

    def lowest(df: DataFrame, *within: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*within).orderBy("Ticket", "ItemLocationId"))
        return df.withColumn("Place", place).where(F.col("Place") <= per_cell).drop("Place")

    return lowest(lowest(rows, *cell, "Bucket"), *cell).drop("Ticket", "Bucket")


def applicability(profile: DataFrame, measures: DataFrame, statuses: Sequence[str],
                  verdicts: Mapping[str, str]) -> DataFrame:
    """Flag per measure: status of the computation, verdict on the measure, or no days."""
    def flagged(status: str):
        verdict = verdicts.get(status, "")
        return (F.when(F.col("MatrixDays") == 0, "no matrix days")
                .when(F.lit(verdict == "excluded"), "excluded")
                .when(F.col(status).isNull(), "short")
                .when((F.col(status) == "ok") & F.lit(verdict == "limited"), "limited")
                .otherwise(F.col(status)).alias(status))
    return (profile.select("ItemLocationId", "Variant", "Branch", "Revenue", "MatrixDays")
            .join(measures, ["ItemLocationId", "Variant"], "left")
            .select("ItemLocationId", "Variant", "Branch", "Revenue",
                    *[flagged(s) for s in statuses]))
