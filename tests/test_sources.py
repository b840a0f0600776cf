from pathlib import Path

from labelframe.functions.checkpoints import SETTING, clean, materialize, run_folder, shared_folder
from labelframe.functions.small import local_table, settle
from labelframe.operators import encode
from labelframe.sources import tables

import pytest


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, 0.1, "a"), (2, -2.5, "b, c"), (3, None, "d")], "id long, x double, s string")
    out = tables.round_trip(df, str(tmp_path / fmt), fmt)
    assert out.where("passed").count() == 4


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="format"):
        tables.round_trip(spark.range(1).toDF("id"), str(tmp_path / "x"), "pickle")


def test_column_list_keeps_its_order(spark, tmp_path):
    names = ["z", "a", "m"]
    tables.save_columns(spark, names, str(tmp_path / "cols"))
    assert tables.load_columns(spark, str(tmp_path / "cols")) == names
    df = spark.createDataFrame([(1, 2, 3, 4)], "a long, b long, m long, z long")
    assert tables.align(df, names).columns == names
    assert tables.signature(df.schema, "y", "bigint")[-1] == ("y", "bigint", "output")


def test_fitted_parameters_reload(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (2, 6.0)], "k long, x double")
    tables.write_parquet(encode.fit_scaler(df, ["x"]), str(tmp_path / "scaler"))
    tables.write_parquet(encode.fit_one_hot(df, "k"), str(tmp_path / "cats"))
    assert encode.categories(tables.read_parquet(spark, str(tmp_path / "cats"))) == [1, 2]
    scaled = encode.apply_scaler(df, tables.read_parquet(spark, str(tmp_path / "scaler")))
    assert [r["x"] for r in scaled.orderBy("k").collect()] == [-1.0, 1.0]


def test_settle_checks_the_size(spark):
    df = spark.range(50)
    assert "LocalTableScan" in settle(df)._jdf.queryExecution().executedPlan().toString()
    assert settle(df, max_rows=10) is df


def test_local_table(spark):
    rows = [(1, "a", {"k": "v"}), (2, None, {})]
    assert local_table(spark, rows, "i int, s string, m map<string, string>").collect()[0]["m"] == {"k": "v"}
    assert local_table(spark, [], "i int").count() == 0


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get(SETTING)


def test_intermediate_tables_are_parquet_in_the_shared_folder_and_can_be_deleted(spark):
    kept = materialize(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    assert "FileScan parquet" in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, kept.collect())) == [(i, 2 * i) for i in range(10)]
    folder = Path(run_folder(spark).removeprefix("file:"))
    assert folder.is_relative_to(shared_folder(spark)) and list(folder.iterdir())
    clean(spark)
    assert not list(folder.iterdir())
