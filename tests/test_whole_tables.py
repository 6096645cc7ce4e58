"""Every line of the given tables reaches the facts."""

import duckdb
from pyspark.sql import functions as F

from conftest import SF_DIR
from shelftide.operators import fingerprint, series
from shelftide.params import EVENTS_PARAMS, LINEITEM_PARAMS
from shelftide.plans import layers as plan_layers, queries
from shelftide.plans.queries import QUERIES, lineitem
from shelftide.sources.adapters import facts_events, facts_lineitem


def test_all_lines_and_events_are_read(spark):
    lines, low, high = duckdb.sql(f"""
        SELECT sum(CASE WHEN l_linenumber > 2 THEN l_quantity * CASE WHEN l_returnflag = 'R'
                     AND l_discount >= 0.09 THEN -1 ELSE 1 END ELSE 0 END),
          min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE))
        FROM '{SF_DIR}/lineitem.parquet'""").fetchall()[0]
    got = facts_lineitem(spark, SF_DIR).agg(
        F.sum("SalesQty"), F.min("TransDate"), F.max("TransDate")).first()
    assert round(got[0], 6) == round(lines, 6) and tuple(got)[1:] == (low, high)
    assert LINEITEM_PARAMS.start <= low and high <= LINEITEM_PARAMS.end

    count, low, high = duckdb.sql(f"""SELECT count(*), min(CAST(ts AS DATE)), max(CAST(ts AS DATE))
        FROM '{SF_DIR}/events.parquet'""").fetchall()[0]
    got = facts_events(spark, SF_DIR).agg(
        F.sum("StockStartQty"), F.min("TransDate"), F.max("TransDate")).first()
    assert tuple(got) == (count, low, high)
    assert EVENTS_PARAMS.start <= low and high <= EVENTS_PARAMS.end


def test_ramp_up_takes_all_pairs_that_lived_sixteen_weeks(spark):
    lived = lineitem(spark, SF_DIR).pairs.where("datediff(LastActive, FirstActive) >= 15 * 7")
    first = lived.where(F.col("FirstActive") < F.lit(LINEITEM_PARAMS.cohort_date)).count()
    assert first > 0 and QUERIES["ramp_up"](spark, SF_DIR).count() == lived.count()


def test_days_do_not_add_up_the_lines_again(spark):
    days = lineitem(spark, SF_DIR).days
    assert not any("lineitem.parquet" in f for f in days.inputFiles())


def test_content_mark_writes_every_value_once(spark):
    raw = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    plan = fingerprint.source_mark(raw, raw.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rint(") == [f.dataType.typeName() for f in raw.schema].count("double")


def test_profile_check_writes_no_days_and_one_summary(spark, monkeypatch):
    written, write = [], queries.materialise

    def noted(df, label):
        written.append(label)
        return write(df, label)

    def checks(facts, base, pair_layer, params):
        assert not any("/facts-" in f or "lineitem.parquet" in f for f in pair_layer.inputFiles())
        return [spark.createDataFrame([("done", "error", 0.0, 0.0, "")],
                                      "CheckName string, Level string, Value double, Threshold double, Details string")]

    monkeypatch.setattr(queries, "materialise", noted)
    monkeypatch.setattr(plan_layers, "materialise", noted)
    monkeypatch.setattr(queries, "profile_checks", checks)
    QUERIES["check_profile"](spark, SF_DIR)
    assert "days" not in written and written.count("pair-summary") == 1


def test_arrays_are_filled_before_they_are_unfolded(spark):
    plan = series.arrays(lineitem(spark, SF_DIR).days)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode", 1)
    assert "flatten" not in above and below.count("flatten(flatten(") == 3
