import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("labelframe-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def separable(spark):
    """300 rows, three unequal classes that two features tell apart."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):
        c = 0 if i % 10 < 6 else 1 if i % 10 < 9 else 2
        x, y = rng.normal(3.0 * c, 0.5), rng.normal(-2.0 * c, 0.5)
        rows.append((i, c + 1, float(x), float(y), float(rng.normal())))
    return spark.createDataFrame(rows, "id long, label long, x double, y double, noise double").cache()
