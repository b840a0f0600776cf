"""Checks fused into one aggregate, and carried by the write that they guard."""

import pytest

from labelframe.operators import expect


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("checks") / "t")
    spark.range(100).selectExpr("id", "CASE WHEN id <> 3 THEN id % 10 END AS v", "CAST('nan' AS double) AS w").write.parquet(path)
    return spark.read.parquet(path)


def test_many_checks_read_a_table_once(stored):
    checks = [expect.missing_check(stored, ["id"]), expect.missing_check(stored, check="all"), expect.range_check("v", 0, 8), expect.count_check(100)]
    rows = expect.run_checks(stored, checks)
    assert scans(rows) == 1
    assert [tuple(r) for r in rows.collect()] == [
        ("no missing values", True, "0", "0"), ("all", False, "101", "0"), ("v in range", False, "11 outside", "[0, 8]"), ("row count", True, "100", "100"),
    ]
    alone = [expect.no_missing(stored, ["id"]), expect.no_missing(stored, check="all"), expect.in_range(stored, "v", 0, 8), expect.row_count(stored, 100)]
    assert [tuple(c.first()) for c in alone] == [tuple(r) for r in rows.collect()]


def test_checks_ride_on_a_write(spark, stored, tmp_path):
    good = [expect.missing_check(stored, ["id"]), expect.count_check(100)]
    rows = expect.write_checked(stored, str(tmp_path / "good"), good)
    assert all(r["passed"] for r in rows.collect()) and spark.read.parquet(str(tmp_path / "good")).count() == 100
    with pytest.raises(expect.ExpectationError, match="row count: observed 100, expected 7"):
        expect.write_checked(stored, str(tmp_path / "bad"), [*good, expect.count_check(7)])
    assert not (tmp_path / "bad").exists()
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        expect.write_checked(stored, str(tmp_path / "good"), good)
    empty = expect.write_checked(stored.limit(0), str(tmp_path / "none"), [expect.count_check(0), expect.missing_check(stored)])
    assert [r["observed"] for r in empty.collect()] == ["0", "0"]
