from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from shelftide.checks.journal import CheckFailed
from shelftide.operators import series
from shelftide import session
from shelftide.operators.fingerprint import content_mark, fingerprint
from shelftide.operators.hierarchy import hierarchy_paths
from shelftide.operators.ranking import ClassRules, class_decisions
from shelftide.plans.pipeline import Build
from shelftide.sources import storage
from shelftide.sources.facts import read_raw
from shop_data import PARAMS, main_rows, raw_frame


def rounded_text(row):
    """Row as text; sums may differ in the last bits with the order of their rows."""
    return str([round(v, 9) if isinstance(v, float) else v for v in row])


@pytest.fixture(scope="module")
def stored_raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "facts")
    raw_frame(spark, main_rows()).repartition(2).write.parquet(path)
    return read_raw(spark, path)


def test_layered_build(spark, stored_raw, tmp_path):
    build = Build(spark, stored_raw, PARAMS, str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError):
        build.run(["profile"])
    build.run()
    assert build.layer("profile_base").count() == 16
    assert build.layer("series_days_checks").where("Status = 'error'").count() == 0
    mark = spark.read.json(build.path("tables/fingerprint")).first()
    assert (mark.SrcFiles, mark.SrcRows, mark.DayPairs, mark.BaseEmptyPairs) == (2, 83, 8, 1)
    assert spark.read.json(build.path("tables/manifest")).count() == 3
    build.run(["tables"])
    with pytest.raises(ValueError, match="unknown steps"):
        build.run(["charts"])


def test_bucketed_build_gives_the_same_layers(spark, stored_raw, tmp_path):
    ranged = Build(spark, stored_raw, PARAMS, str(tmp_path / "ranged"), checks=False)
    bucketed = Build(spark, stored_raw, PARAMS, str(tmp_path / "bucketed"), buckets=4)
    ranged.run(["days", "profile"])
    bucketed.run(["days", "profile"])
    for layer in ("series_days", "series_arrays", "profile_base"):
        one, two = (sorted(map(rounded_text, b.layer(layer).collect()))
                    for b in (ranged, bucketed))
        assert one == two
    days = bucketed._read_days()
    plan = series.arrays(days)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql(f"drop table {bucketed._days_table()}")


def test_gate_stops_later_layers(spark, tmp_path):
    rows = main_rows()
    build = Build(spark, raw_frame(spark, rows + rows[:1]), PARAMS, str(tmp_path / "bad"))
    with pytest.raises(CheckFailed, match="days_key_unique"):
        build.run()
    with pytest.raises(FileNotFoundError):
        build.layer("profile_base")


def test_fingerprint_ignores_row_order(spark, layers, stored_raw, tmp_path):
    path = str(tmp_path / "other")
    stored_raw.orderBy(F.desc("SalesAmount")).coalesce(1).write.parquet(path)
    def mark(raw):
        return fingerprint(raw, layers.days, layers.base).first()
    one, two = mark(stored_raw), mark(read_raw(spark, path))
    assert one.SrcHash == two.SrcHash and (one.SrcFiles, two.SrcFiles) == (2, 1)
    changed = stored_raw.where("ItemLocationId <> 12")
    assert mark(changed).SrcHash != one.SrcHash


def test_fingerprint_sees_which_column_is_null(spark):
    def mark(rows):
        df = spark.createDataFrame(rows, "a int, b int")
        return df.agg(content_mark(df, ["a", "b"])).first()[0]

    assert mark([(None, 5)]) != mark([(5, None)])
    assert mark([(1, 2), (3, 4)]) == mark([(3, 4), (1, 2)]) != mark([(1, 2), (4, 3)])


def test_hierarchy_reaches_the_roots(spark):
    schema = "id string, parent string, name string"
    edges = spark.createDataFrame(
        [("a", None, "A"), ("b", "a", "B"), ("c", "b", "C"), ("d", "c", ""), ("e", "d", "E"),
         ("f", "e", "F"), ("g", "f", "G"), ("x", "gone", "X")], schema)
    rows = {r.LevelId: r for r in hierarchy_paths(edges, "id", "parent", "name").collect()}
    assert rows["c"].LevelNameTree == "A/B/C" and rows["c"].LevelIdList == ["a", "b", "c"]
    assert rows["d"].LevelNameList == ["A", "B", "C"]
    assert rows["g"].LevelIdList == list("abcdefg") and rows["g"].LevelNameTree == "A/B/C/E/F/G"
    assert rows["x"].LevelIdList == ["x"] and len(rows) == 8
    looped = spark.createDataFrame([("x", "y", "X"), ("y", "x", "Y"), ("z", "y", "Z")], schema)
    with pytest.raises(ValueError, match="cycle"):
        hierarchy_paths(looped, "id", "parent", "name")
    with pytest.raises(ValueError, match="title"):
        hierarchy_paths(edges, "id", "parent", "title")


def test_text_keeps_breaks_quotes_and_empty(spark, tmp_path):
    path = str(tmp_path / "odd")
    rows = [(1, 'a\nb'), (2, 'say "x"; y'), (3, "back\\slash\\"), (4, ""), (5, None), (6, " pad "),
            (7, '"'), (8, "a\r\nb"), (9, '\\"')]
    storage.write_text_with_types(spark.createDataFrame(rows, "n int, t string"), path)
    assert sorted(map(tuple, storage.read_text_with_types(spark, path).collect())) == rows


def test_shared_root_needs_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Session())
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Session())
    made = session.materialise(spark.range(3), "x")
    folder = session.run_folder(spark).removeprefix("file:")
    assert made.count() == 3 and any(Path(folder).iterdir())


def test_text_by_name_skips_extra_fields(spark, tmp_path):
    path = str(tmp_path / "text")
    storage.write_text(spark.createDataFrame([(1, "x;y", 2.5)], "a int, b string, c double"), path)
    schema = T.StructType([T.StructField("c", T.DoubleType()), T.StructField("b", T.StringType()),
                           T.StructField("z", T.LongType())])
    assert storage.read_text(spark, path, schema).first() == (2.5, "x;y", None)
    storage.write_text(spark.createDataFrame([(7,)], "a int"), path, ",", header=False)
    plain = T.StructType([T.StructField("n", T.IntegerType())])
    assert storage.read_text(spark, path, plain, ",", header=False).first() == (7,)


def test_typed_text_json_and_literals(spark, layers, tmp_path):
    path = str(tmp_path / "typed")
    storage.write_text_with_types(layers.pairs, path)
    back = storage.read_text_with_types(spark, path)
    assert back.dtypes == layers.pairs.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, layers.pairs.collect()))
    storage.write_json_lines(layers.pairs, str(tmp_path / "json"))
    again = storage.read_json_lines(spark, str(tmp_path / "json"), layers.pairs.schema)
    assert sorted(map(str, again.collect())) == sorted(map(str, layers.pairs.collect()))
    schema = T.StructType([T.StructField("k", T.StringType())])
    assert storage.literal_rows(spark, [("v",)], schema).first().k == "v"
    storage.discard(layers.pairs)


def test_global_order_spans_the_files(spark, layers, tmp_path):
    path = str(tmp_path / "ordered")
    back = storage.write_layer(layers.pairs.repartition(3), path, ["ItemLocationId"],
                               globally=True)
    spans = back.groupBy(F.col("_metadata.file_path")).agg(
        F.min("ItemLocationId").alias("lo"), F.max("ItemLocationId").alias("hi")).orderBy("lo")
    bounds = [(r.lo, r.hi) for r in spans.collect()]
    assert back.count() == 8 and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_bucketed_layer_groups_without_a_shuffle(spark, layers, tmp_path):
    table = storage.write_bucketed(
        layers.days.repartition(4, "ItemLocationId"), "days_bucketed", str(tmp_path / "b"),
        "ItemLocationId", 4, ["ItemLocationId", "TransDate"])
    plan = table.groupBy("ItemLocationId").agg(F.sum("SalesQty"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and plan.count() == 8
    spark.sql("drop table days_bucketed")


def test_build_writes_classes_behind_their_gate(spark, stored_raw, tmp_path):
    with pytest.raises(ValueError, match="mixed"):
        ClassRules((("flat", "Cv2 < 0.2"),), "mixed", 4, {"flat": "rule"})
    rules = ClassRules((("flat", "Cv2 < 0.2"),), "mixed", 4, {"flat": "stock rule", "mixed": "own model"})
    build = Build(spark, stored_raw, PARAMS, str(tmp_path / "classes"), classes=rules)
    try:
        build.run(["days", "profile"])
    except CheckFailed as failed:
        assert "class_revenue_share" in str(failed)
    rows = build.layer("profile_classes").collect()
    assert rows and all(r.Decision == rules.decisions.get(r.Class, "n/a") for r in rows)
    assert build.layer("profile_classes_checks").count() == 2
    strict = Build(spark, stored_raw, PARAMS, str(tmp_path / "strict"), classes=ClassRules(
        (("flat", "ItemLocationId < 0"), ("none", "true")), "mixed", 10**6, {"flat": "a", "none": "b", "mixed": "c"}))
    strict.run(["days", "profile"])  # no series is long enough, so no class is missing or small
    assert {r.Decision for r in strict.layer("profile_classes").collect()} == {"n/a"}


def test_shares_of_classes_in_top_and_tail(spark):
    rows = [("kg", "flat", "rule", "sales", 10.0, "A"), ("kg", "flat", "rule", "sales", 10.0, "B"),
            ("kg", "mixed", "own", "sales", 30.0, "A"), ("kg", "mixed", "own", "demand", 99.0, "A")]
    got = {r.Class: r for r in class_decisions(spark.createDataFrame(
        rows, "Branch string, Class string, Decision string, Variant string, Revenue double, Rule string"),
        "Rule").collect()}
    assert (got["flat"].Pairs, got["flat"].RevenueShare, got["flat"].TopShare, got["flat"].TailShare) == (
        2, 0.4, 0.25, 1.0)
    assert (got["mixed"].PairShare, got["mixed"].TopShare, got["mixed"].TailShare) == (
        pytest.approx(1 / 3), 0.75, 0.0)
