import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelftide.checks.journal import CheckFailed, assemble, enforce
from shelftide.checks.series_checks import series_checks
from shelftide.functions import labels
from shelftide.operators import series
from shelftide.plans.layers import Layers
from shop_data import ALL_DAYS, PARAMS, Point, day, main_rows, raw_frame, rows_of


@pytest.fixture(scope="module")
def days(layers):
    rows = layers.days.collect()
    return rows


def of(rows, pair):
    return sorted((r for r in rows if r.ItemLocationId == pair), key=lambda r: r.TransDate)


def test_layer_keeps_every_source_row(days):
    assert len(days) == len(main_rows())


def test_deficit_is_below_threshold_only(days):
    assert [r.TransDate.day for r in of(days, 11) if r.IsDeficit] == [5]
    assert [r.TransDate.day for r in of(days, 12) if r.IsDeficit] == [8, 9]
    # Stock equal to the threshold of pieces is no deficit.
    assert not any(r.IsDeficit for r in of(days, 31))


def test_variants(days):
    rows = of(days, 12)
    assert sum(r.ValueSales is not None for r in rows) == 14
    assert sum(r.ValueDemand is not None for r in rows) == 12


def test_return_is_zeroed_and_kept(days):
    row = next(r for r in of(days, 13) if r.TransDate == day(14))
    assert (row.SalesQty, row.SalesAmount, row.IsReturn, row.ValueSales) == (0.0, 0.0, 1, 0.0)


def test_life_cuts_matrix_days(days):
    rows = of(days, 21)
    assert [r.TransDate.day for r in rows if r.InLife] == [6, 7, 8, 9, 10, 11]
    assert sum(r.ValueSales is not None for r in rows) == 6
    assert {r.Cohort for r in rows} == {labels.BEFORE}


def test_sales_outside_the_matrix_are_alive_but_no_series(days):
    rows = of(days, 22)
    assert all(r.InLife == 1 and r.IsEmpty == 0 and r.ValueSales is None for r in rows)


def test_empty_series(days, layers):
    rows = of(days, 23)
    assert all(r.IsEmpty == 1 and r.InLife == 0 and r.Cohort == labels.NOT_APPLICABLE
               for r in rows)
    pair = layers.pairs.where("ItemLocationId = 23").first()
    assert pair.FirstActive is None and pair.LastActive is None and pair.MatrixDays == 14
    assert layers.arrays.where("ItemLocationId = 23").count() == 0


def test_cohort_by_first_activity(layers):
    cohort = {r.ItemLocationId: r.Cohort for r in layers.pairs.collect()}
    assert cohort[31] == labels.AFTER and cohort[12] == labels.BEFORE


def test_cohort_date_itself_is_after(raw):
    params = dataclasses.replace(PARAMS, cohort_date=day(6))
    pairs = Layers(raw, params).pairs
    assert pairs.where("ItemLocationId = 21").first().Cohort == labels.AFTER


def test_branch_and_scope(days):
    assert {r.ItemLocationId for r in days if r.Scope == labels.DISPUTED} == {11}
    assert {r.Branch for r in of(days, 12)} == {"kg"}


def test_outlier_store(layers):
    assert [r.LocationId for r in layers.stores.where("OutlierStore = 1").collect()] == ["mill"]


def test_arrays_fill_gaps(layers):
    rows = {(r.ItemLocationId, r.Variant): r for r in layers.arrays.collect()}
    milk = rows[13, "sales"]
    # No row on the 10th, off the matrix on the 12th, a return on the 14th.
    assert milk.Values == [2.0] * 7 + [None, 2.0, None, 2.0, 0.0, 2.0, 2.0]
    assert milk.Deficit == [0] * 14
    short = rows[21, "sales"]
    assert (short.FirstDay, short.LastDay, len(short.Values)) == (day(6), day(11), 6)
    assert rows[12, "demand"].Values[5] is None and rows[12, "sales"].Values[5] == 1.0
    assert rows[12, "sales"].Deficit[5] == rows[12, "demand"].Deficit[5] == 1


def test_arrays_of_a_pair_without_matrix_days(layers):
    row = layers.arrays.where("ItemLocationId = 22 and Variant = 'sales'").first()
    assert row.Values == [None] * 12


def test_column_types(layers):
    types = {f.name: f.dataType.simpleString() for f in layers.days.schema}
    assert {types[c] for c in ("InLife", "IsDeficit", "IsMatrix", "IsReturn")} == {"int"}
    assert types["ValueSales"] == "double"
    assert dict(layers.arrays.dtypes)["Values"] == "array<double>"
    assert dict(layers.arrays.dtypes)["Deficit"] == "array<int>"
    assert layers.days.columns == list(series.DAY_COLUMNS)


def journal_of(layers, source=None):
    raw = source if source is not None else layers.raw
    return assemble(series_checks(raw, layers.facts, layers.days, layers.arrays, layers.params))


def failed(journal, status="error"):
    return {r.CheckName for r in journal.collect() if r.Status == status}


def test_clean_journal(layers):
    journal = journal_of(layers)
    rows = enforce(journal, "days")
    assert failed(journal) == set()
    assert rows[0].CheckName == "days_returns_zeroed" and rows[0].Value == 1


def test_repeated_row_breaks_the_key(spark):
    rows = main_rows()
    layers = Layers(raw_frame(spark, rows + rows[:1]), PARAMS)
    assert "days_key_unique" in failed(journal_of(layers))


def test_unknown_measure_is_dropped_and_reported(spark):
    rows = main_rows()
    rows[0] = {**rows[0], "ItemMeasure": " box "}
    layers = Layers(raw_frame(spark, rows), PARAMS)
    row = {r.CheckName: r for r in journal_of(layers).collect()}["source_measures_known"]
    assert (row.Status, row.Value) == ("warning", 1.0) and "ticket (box)" in row.Details
    assert layers.days.count() == len(rows) - 1


def test_source_grown_after_the_layer(spark, layers):
    extra = rows_of("quay", "milk", 22, [8], Point(0, 0.0, 0.0, 1.0, 25.0))
    grown = Layers(raw_frame(spark, main_rows() + extra), PARAMS)
    journal = assemble(series_checks(grown.raw, grown.facts, layers.days, layers.arrays, PARAMS))
    assert {"days_sales_qty_pcs", "days_rows_pcs", "days_rows_total"} <= failed(journal)
    with pytest.raises(CheckFailed, match="days_sales_qty_pcs"):
        enforce(journal, "days")


def test_period_without_data(raw):
    params = dataclasses.replace(PARAMS, start=dt.date(2027, 1, 1), end=dt.date(2027, 1, 31))
    assert "days_rows_positive" in failed(journal_of(Layers(raw, params)))


def test_missing_threshold_fails_only_when_met(raw):
    params = dataclasses.replace(PARAMS, thresholds={"pcs": 1.0})
    layers = Layers(raw, params)
    layers.days.where("Branch = 'pcs'").count()
    with pytest.raises(Exception, match="no availability threshold for branch kg"):
        layers.days.collect()
    pieces = Layers(raw.where(F.col("ItemMeasure") == "pcs"), params)
    assert pieces.days.count() > 0


def test_null_pair_id_is_refused(spark):
    rows = main_rows()
    rows[0] = {**rows[0], "ItemLocationId": None}
    with pytest.raises(Exception, match="null ItemLocationId"):
        Layers(raw_frame(spark, rows), PARAMS).facts.collect()


def test_nulls_become_defaults(spark):
    rows = [{"TransDate": day(d), "ItemLocationId": 7, "ItemMeasure": "kg "} for d in ALL_DAYS]
    row = Layers(raw_frame(spark, rows), PARAMS).facts.first()
    assert (row.LocationId, row.IsMatrix, row.SalesQty, row.ItemMeasure) == ("", 0, 0.0, "kg")


@pytest.mark.parametrize("change, text", [
    ({"adi": "1,32"}, "adi"), ({"cv2": 0}, "cv2"), ({"abc": (0.95, 0.8)}, "bounds"),
    ({"disputed": "LOTTERY"}, "list"), ({"returns": "keep"}, "returns"),
    ({"life": "calendar"}, "life"), ({"branches": {}}, "branches")])
def test_bad_parameters(change, text):
    with pytest.raises(ValueError, match=text):
        dataclasses.replace(PARAMS, **change)
