"""Intermediate tables: written at once from several threads, settings as before."""

from concurrent.futures import ThreadPoolExecutor

from labelframe.functions import checkpoints


def test_threads_leave_the_setting_as_it_was(spark):
    assert spark.conf.get(checkpoints.CLEAN_UP, None) is None
    with ThreadPoolExecutor(4) as pool:
        tables = list(pool.map(lambda n: checkpoints.materialize(spark.range(n).repartition(3)), range(1, 13)))
    assert [t.count() for t in tables] == list(range(1, 13))
    assert spark.conf.get(checkpoints.CLEAN_UP, None) is None
    spark.conf.set(checkpoints.CLEAN_UP, "false")
    checkpoints.materialize(spark.range(2))
    assert spark.conf.get(checkpoints.CLEAN_UP, None) == "false"
    spark.conf.unset(checkpoints.CLEAN_UP)
