"""ABC classes of the pair: three bases, each within the store and within its subgroups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelftide.functions import labels
from shelftide.functions.expressions import exact
from shelftide.operators.running import running_total
from shelftide.params import Params
from shelftide.session import materialise


@dataclass(frozen=True)
class Rule:
    name: str
    metric: str
    partition: tuple[str, ...]
    needs_matrix: bool = False

    def applies(self) -> Column:
        condition = F.col("IsEmpty") == 0
        return condition & (F.col("MatrixDays") > 0) if self.needs_matrix else condition


# Money adds up across branches, quantity does not; frequency needs matrix days.
RULES = (
    Rule("AbcRevenueStore", "Revenue", ("LocationId",)),
    Rule("AbcRevenueSubgroup", "Revenue", ("LocationId", "ItemIdLevel2")),
    Rule("AbcQtyStore", "SalesQtyTotal", ("LocationId", "Branch")),
    Rule("AbcQtySubgroup", "SalesQtyTotal", ("LocationId", "ItemIdLevel2", "Branch")),
    Rule("AbcFreqStore", "SalesDays", ("LocationId",), needs_matrix=True),
    Rule("AbcFreqSubgroup", "SalesDays", ("LocationId", "ItemIdLevel2"), needs_matrix=True),
)

_INPUT = ("ItemLocationId", "LocationId", "ItemIdLevel2", "Branch", "IsEmpty", "MatrixDays",
          "Revenue", "SalesQtyTotal", "SalesDays")


#: Entries of a store (and what comes before it) from which its rows are dealt out over many tasks.
LARGE_STORE = 200_000


def _metric(rule: Rule) -> Column:
    return F.when(rule.applies(), exact(F.col(rule.metric))).otherwise(exact(F.lit(0)))


def _inner(rule: Rule) -> list[str]:
    """The group within the store."""
    return [c for c in rule.partition if c != "LocationId"]


def _ranked_by(rule: Rule) -> Column:
    """A pair's entry under one rule: its group within the store, and what it is ranked by."""
    return F.struct(F.lit(rule.name).alias("Rule"),
                    F.concat_ws("\x1f", *_inner(rule)).alias("Inner"), _metric(rule).alias("Metric"),
                    F.coalesce(rule.applies(), F.lit(False)).alias("Applies"))


def _class(params: Params, applies: Column, metric: Column, running: Column, total: Column) -> Column:
    """Class by the share accumulated before the pair, so the one crossing a bound stays."""
    before = (running - metric).cast("double") / total.cast("double")
    return (F.when(~applies, labels.NOT_APPLICABLE)
            .when((total <= 0) | (metric <= 0), "C")
            .when(before < F.lit(float(params.abc[0])), "A")
            .when(before < F.lit(float(params.abc[1])), "B")
            .otherwise("C"))


def _inside_stores(base: DataFrame, params: Params, store: list[str]) -> DataFrame:
    """All rules after one shuffle of the pairs by store; a rule that nobody asks for is not sorted."""
    placed = base.repartition(*store).withColumns({f"Metric{r.name}": _metric(r) for r in RULES})
    classes = []
    for rule in RULES:
        metric = F.col(f"Metric{rule.name}")
        ranked = Window.partitionBy(*store, *_inner(rule)).orderBy(
            metric.desc(), F.col("RevenueExact").desc(), F.col("ItemLocationId").asc())
        running, total = (F.sum(metric).over(ranked.rowsBetween(Window.unboundedPreceding, to))
                          for to in (Window.currentRow, Window.unboundedFollowing))
        classes.append(_class(params, F.coalesce(rule.applies(), F.lit(False)), metric, running, total).alias(rule.name))
    return placed.select(*[k for k in store if k != "LocationId"], "ItemLocationId", *classes)


def _across_tasks(base: DataFrame, params: Params, keys_before: tuple[str, ...]) -> DataFrame:
    """A pair has one entry under every rule; all entries are ranked in one running total over
    (rule, store, group), which deals a store of any size out over many tasks."""
    entries = base.select(
        *keys_before, "ItemLocationId", "LocationId", "RevenueExact",
        F.inline(F.array(*[_ranked_by(rule) for rule in RULES])))
    ranked = running_total(
        entries, [*keys_before, "Rule", "LocationId", "Inner"],
        [F.col("Metric").desc(), F.col("RevenueExact").desc(), F.col("ItemLocationId").asc()],
        "Metric", "Running", total="Total")
    made = _class(params, *[F.col(c) for c in ("Applies", "Metric", "Running", "Total")])
    classes = ranked.withColumn("Class", made).groupBy(*keys_before, "ItemLocationId")
    return classes.agg(*[F.max(F.when(F.col("Rule") == rule.name, F.col("Class"))).alias(rule.name)
                         for rule in RULES])


def abc_classes(pair_profile: DataFrame, params: Params,
                keys_before: tuple[str, ...] = (), large: int = LARGE_STORE) -> DataFrame:
    """Six classes per pair, from the `sales` rows of a pair profile, which is read more than once.

    Stores of at most `large` pairs are ranked inside tasks, the others across tasks; both give the same.
    """
    store = [*keys_before, "LocationId"]
    base = (pair_profile.where(F.col("Variant") == labels.SALES)
            .select(*keys_before, *_INPUT, exact(F.col("Revenue")).alias("RevenueExact"))
            .withColumns({c: F.coalesce(c, F.lit("")) for c in ("LocationId", "ItemIdLevel2", "Branch")}))
    big = base.groupBy(*store).count().where(F.col("count") > large).drop("count")
    if big.isEmpty():
        return _inside_stores(base, params, store)
    big = materialise(big, "large-stores")
    return _inside_stores(base.join(big, store, "left_anti"), params, store).unionByName(
        _across_tasks(base.join(big, store, "left_semi"), params, keys_before))
