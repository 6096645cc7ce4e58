"""Reports on the series: which pairs are analysed, and in which demand class."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelftide.functions import labels
from shelftide.operators.pivot import Dimension, Figure, Report, report

BRANCH = Dimension("Branch", "branch")
VARIANT = Dimension("Variant", "variant", ahead=f"Variant = '{labels.DEMAND}'")
PAIRS = Figure("pairs", "count(*)", share=True)
#: A pair's revenue is whole cents; sums of doubles show it up to their last bits, which depend on the order
#: of addition, so it is brought back to cents before it is added.
REVENUE = Figure("revenue", "sum(cast(round(Revenue, 2) as decimal(36,2)))", places=0, share=True)

_WHY = f"""case when IsEmpty = 1 then 'empty series' when MatrixDays = 0 then 'no matrix days'
  when VariantDays = 0 then 'no variant days'
  when Quadrant = '{labels.NOT_APPLICABLE}' then 'fewer than two sale days'
  else 'classified' end"""


def cohorts(base: DataFrame) -> Report:
    return report(
        "cohort_sizes", "How many pairs each cohort has, and what they earn", base,
        [BRANCH, Dimension("Cohort", "cohort")],
        [PAIRS, Figure("empty series", "sum(IsEmpty)"), REVENUE],
        f"Variant = '{labels.SALES}'", "profile_base")


def demand_classes(base: DataFrame) -> Report:
    short = Figure("deficit days, %", "try_divide(100.0D * sum(DeficitDays), sum(MatrixDays))", 1)
    return report(
        "class_sizes", "Series by demand class, with their days short of stock", base,
        [BRANCH, VARIANT, Dimension("Quadrant", "demand class")], [PAIRS, REVENUE, short],
        "IsEmpty = 0", "profile_base")


def not_applicable(base: DataFrame) -> Report:
    return report(
        "unclassified_reasons", "Why series have no demand class", base,
        [BRANCH, VARIANT, Dimension("Reason", "reason", _WHY, "Reason = 'classified'")],
        [PAIRS, REVENUE], source_name="profile_base")


def population(base: DataFrame) -> list[Report]:
    return [make(base) for make in (cohorts, demand_classes, not_applicable)]
