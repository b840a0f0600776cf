import pytest
from pyspark.sql import functions as F

from labelframe.operators import clean, expect


@pytest.fixture(scope="module")
def mapping(spark):
    return clean.class_map(spark, {1: "low", 2: "high"})


def test_unknown_label_raises(spark, mapping):
    df = spark.createDataFrame([("low",), ("odd",), (None,)], "y string")
    with pytest.raises(ValueError, match="odd"):
        clean.require_known_labels(df, "y", mapping)
    clean.require_known_labels(df.where("y = 'low'"), "y", mapping)


def test_repeated_name_raises(spark):
    with pytest.raises(ValueError, match="same"):
        clean.invert_class_map(clean.class_map(spark, {1: "same", 2: "same"}))


def test_encode_then_decode(spark, mapping):
    df = spark.createDataFrame([("low",), ("high",), ("odd",)], "y string")
    out = clean.decode_label(clean.encode_label(df, "y", mapping, "code"), "code", mapping, "name")
    assert {(r["y"], r["code"], r["name"]) for r in out.collect()} == {("low", 1, "low"), ("high", 2, "high"), ("odd", None, None)}
    in_place = clean.encode_label(df, "y", mapping)
    assert in_place.columns == ["y"] and dict(in_place.dtypes)["y"] == "bigint"


def test_range_bounds_are_inside_and_rules_add_up(spark):
    rows = [(0, 0.0), (255, 90.0), (256, 91.0), (-1, float("nan")), (None, 5.0)]
    df = spark.createDataFrame(rows, "shade long, slope double")
    rules = {"shade": (0, 255), "slope": (0, 90)}
    got = {r["column"]: (r["invalid"], r["status"]) for r in clean.audit_ranges(df, rules).collect()}
    assert got == {"shade": (2, "2 invalid"), "slope": (1, "1 invalid"), "TOTAL": (3, "3 invalid")}
    assert clean.drop_impossible(df, rules).count() == 3


def test_recode_keeps_other_values(spark):
    df = spark.createDataFrame([(360,), (0,), (None,)], "a long")
    assert [r["a"] for r in clean.recode(df, "a", 360, 0).collect()] == [0, 0, None]


def test_map_only_steps_accept_a_stream(spark, tmp_path, mapping):
    spark.createDataFrame([(360, "low"), (400, "high")], "a long, y string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("a long, y string").parquet(str(tmp_path / "in"))
    cleaned = clean.drop_impossible(clean.recode(stream, "a", 360, 0), {"a": (0, 359)})
    coded = clean.encode_label(cleaned, "y", mapping, "code")
    query = coded.writeStream.format("memory").queryName("cleaned_rows").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert [tuple(r) for r in spark.table("cleaned_rows").collect()] == [(0, "low", 1)]


def test_expectations(spark):
    df = spark.createDataFrame([(1, 2.0), (2, float("nan"))], "a long, b double")
    checks = expect.all_checks(
        expect.has_columns(df, ["a", "b"]),
        expect.column_count(df, 2),
        expect.row_count(df, 2),
        expect.same_columns(df, df.limit(0)),
        expect.retains(["a", "b"], ["a"], spark),
        expect.in_range(df, "a", 1, 2),
    )
    assert checks.where("NOT passed").count() == 0
    expect.require(checks)
    with pytest.raises(expect.ExpectationError, match="no missing values: observed 1"):
        expect.require(checks, expect.no_missing(df))
    assert not expect.has_columns(df, ["c"]).first()["passed"]
    assert not expect.in_range(df.withColumn("a", F.lit(None).cast("long")), "a", 1, 2).first()["passed"]


def test_class_targets_notice_a_changed_class(spark):
    before = spark.createDataFrame([(1,)] * 4 + [(2,)] * 2, "y long")
    after = spark.createDataFrame([(1,)] * 3 + [(2,)] * 4, "y long")
    got = {r["check"]: r["passed"] for r in expect.class_targets_met(before, after, "y", {2: 4}).collect()}
    assert got == {"class 1": False, "class 2": True}


def test_metric_floor_is_strict(spark):
    metrics = spark.createDataFrame([("m", 0.91), ("n", 0.92)], "model string, macro_f1 double")
    assert [r["passed"] for r in expect.metric_above(metrics, "macro_f1", 0.91).orderBy("check").collect()] == [False, True]
