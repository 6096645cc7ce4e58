import dataclasses

import pytest
from pyspark.sql import functions as F

from shelftide.checks.journal import CheckFailed, assemble, enforce
from shelftide.checks.profile_checks import profile_checks
from shelftide.functions.expressions import exact
from shelftide.functions import labels
from shelftide.operators import abc, abc_compare
from shelftide.operators.running import running_total
from shelftide.plans.layers import Layers
from shop_data import PARAMS

NA = labels.NOT_APPLICABLE


@pytest.fixture(scope="module")
def profile(layers):
    return {(r.ItemLocationId, r.Variant): r for r in layers.base.collect()}


def test_key(profile):
    assert len(profile) == 16


def test_history(profile):
    row = profile[12, "sales"]
    assert (row.LifeDays, row.Revenue, row.SalesQtyTotal, row.Price) == (14, 1120, 14, 80)
    row = profile[21, "sales"]
    assert (row.LifeDays, row.MatrixDays, row.MatrixDaysOutLife, row.ZeroShare) == (6, 6, 8, 0)
    row = profile[13, "sales"]
    # The return of the 14th counts neither in the revenue nor in the price; the 12th is off the matrix.
    assert (row.MatrixDays, row.Revenue, row.Price) == (12, 120, 5)
    assert row.RevenueOutMatrixShare == pytest.approx(1 / 12)
    assert profile[22, "sales"].RevenueOutMatrixShare == 1
    row = profile[23, "sales"]
    assert (row.LifeDays, row.MatrixDaysOutLife, row.Price, row.RevenueOutMatrixShare) == (
        None, 0, None, None)


def test_demand(profile):
    row = profile[13, "sales"]
    assert row.ZeroShare == pytest.approx(1 / 12) and row.Adi == pytest.approx(12 / 11)
    assert row.Cv2 == 0 and row.SalesLevel == pytest.approx(22 / 12)
    assert (profile[12, "sales"].VariantDays, profile[12, "demand"].VariantDays) == (14, 12)


def test_deficit_is_the_same_in_both_variants(profile):
    for variant in ("sales", "demand"):
        row = profile[12, variant]
        assert row.DeficitDayShare == pytest.approx(2 / 14)
        assert row.DeficitSalesShare == pytest.approx(2 / 14)


def test_not_applicable(profile):
    row = profile[22, "sales"]
    assert (row.Quadrant, row.AbcFreqStore, row.ZeroShare, row.VariantQty) == (NA, NA, None, None)
    assert row.AbcRevenueStore in ("A", "B", "C")
    assert all(profile[23, "sales"][c] == NA for c in labels.ABC_COLUMNS)


def test_abc_in_a_store(profile):
    # Revenue 1120, 420 and 120; pieces 28 and 22; each pair alone in its subgroup.
    north = [profile[p, "sales"] for p in (12, 11, 13)]
    assert [r.AbcRevenueStore for r in north] == ["A", "A", "B"]
    assert [r.AbcRevenueSubgroup for r in north] == ["A"] * 3
    assert [r.AbcQtyStore for r in north] == ["A"] * 3


def test_abc_bounds_come_from_the_parameters(raw):
    base = Layers(raw, dataclasses.replace(PARAMS, abc=(0.50, 0.95))).base
    assert base.where("ItemLocationId = 11").first().AbcRevenueStore == "B"


def test_quadrants(quadrant_layers):
    rows = {r.ItemLocationId: r for r in quadrant_layers.base.where(
        "Variant = 'sales'").collect()}
    assert [rows[p].Quadrant for p in (91, 92, 93, 94)] == [
        labels.SMOOTH, labels.ERRATIC, labels.INTERMITTENT, labels.LUMPY]
    assert [rows[p].Adi for p in (91, 92, 93, 94)] == [1, 1, 2, 2]
    # Equal frequency: the pair with more revenue takes the better class.
    assert (rows[94].AbcFreqStore, rows[93].AbcFreqStore) == ("A", "B")


def test_ranking_equals_plain_windows(spark, layers, quadrant_layers):
    for source in (layers, quadrant_layers):
        rows = [r for r in source.written_profile_pairs.collect() if r.Variant == "sales"]
        got = {r.ItemLocationId: r for r in abc.abc_classes(
            source.written_profile_pairs, source.params).collect()}
        assert len(got) == len(rows)
        for rule in abc.RULES:
            groups = {}
            for r in rows:
                applies = not r.IsEmpty and (r.MatrixDays > 0 or not rule.needs_matrix)
                groups.setdefault(tuple(r[c] for c in rule.partition), []).append(
                    (-(r[rule.metric] if applies else 0), -r.Revenue, r.ItemLocationId, applies))
            for entries in groups.values():
                total, before = -sum(e[0] for e in entries), 0.0
                for metric, _, pair, applies in sorted(entries):
                    want = "n/a" if not applies else "C" if not metric or total <= 0 else (
                        "A" if before / total < 0.8 else "B" if before / total < 0.95 else "C")
                    assert got[pair][rule.name] == want
                    before -= metric


def test_unset_values_are_caught(layers):
    broken = layers.base
    for column in ("Branch", "ItemIdLevel2", "Cohort"):
        broken = broken.withColumn(column, F.when(F.col("ItemLocationId") != 12, F.col(column)))
    values = {r.CheckName: r.Value for r in journal_of(layers, broken).collect()}
    assert [values[f"profile_filled_{c}"] for c in ("branch", "subgroup", "cohort")] == [1, 1, 1]


def test_fixed_point_at_both_ends(spark):
    one = spark.range(1).select(exact(F.lit(4e-9)).alias("small"), exact(F.lit(1e24)).alias("large"))
    assert float(one.first().small) == 4e-9 and float(one.first().large) == 1e24


def test_running_total_across_blocks(spark):
    df = spark.range(0, 1000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 5)) as k", "id % 7 as o", "id",
        "cast(id % 11 as decimal(18,4)) as v")
    got = running_total(df, ["k"], [F.col("o").desc(), F.col("id").asc()], "v", "run",
                        total="all", blocks=6)
    rows = sorted(got.collect(), key=lambda r: (r.k, -r.o, r.id))
    assert len(rows) == 1000
    seen = {}
    for r in rows:
        seen[r.k] = seen.get(r.k, 0) + r.v
        assert r.run == seen[r.k]
    assert all(r["all"] == seen[r.k] for r in rows)


def journal_of(layers, base):
    return assemble(profile_checks(layers.facts, base, layers.pairs, layers.params))


def test_clean_journal(layers):
    rows = {r.CheckName: r for r in enforce(journal_of(layers, layers.base), "profile")}
    assert rows["profile_empty_pairs"].Value == 1
    assert rows["profile_no_matrix_pairs"].Value == 1


def test_overwritten_quadrant_is_caught(layers):
    broken = layers.base.withColumn("Quadrant", F.when(
        (F.col("ItemLocationId") == 12) & (F.col("Variant") == "sales"), F.lit("odd"))
        .otherwise(F.col("Quadrant")))
    with pytest.raises(CheckFailed, match="profile_filled_demand_class"):
        enforce(journal_of(layers, broken), "profile")


def test_swapped_pair_is_caught_by_the_sets(layers):
    """The pair counts agree, the pairs themselves do not."""
    broken = layers.base.withColumn("ItemLocationId", F.when(
        F.col("ItemLocationId") == 31, 999).otherwise(F.col("ItemLocationId")))
    failed = {r.CheckName for r in journal_of(layers, broken).collect() if r.Status == "error"}
    assert {"profile_pairs_pcs", "profile_life_matches_pairs"} <= failed


def test_empty_journal_stops(spark, layers):
    empty = journal_of(layers, layers.base).where("false")
    with pytest.raises(CheckFailed, match="empty"):
        enforce(empty, "profile")


def test_stores_of_any_size_have_the_same_classes(layers):
    small, large = (sorted(abc.abc_classes(layers.profile_pairs, PARAMS, large=n).select(
        "ItemLocationId", *labels.ABC_COLUMNS).collect()) for n in (abc.LARGE_STORE, 1))
    assert small == large and len(small) == 8


def test_quarters_meet_the_next_without_a_join(spark):
    rows = [(1, "2024-01-01", "A"), (1, "2024-04-01", "B"), (1, "2024-10-01", "C"), (2, "2024-01-01", "n/a"),
            (2, "2024-04-01", "A"), (2, "2024-07-01", "A")]
    classes = spark.createDataFrame(rows, "ItemLocationId long, Quarter string, Rule string").withColumn(
        "Quarter", F.col("Quarter").cast("date"))
    table = abc_compare.transitions(classes, "Rule")
    assert {tuple(r) for r in table.collect()} == {("A", "B", 1), ("A", "A", 1)}
    assert "Join" not in table._jdf.queryExecution().optimizedPlan().toString()
