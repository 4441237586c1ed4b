import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from annualis.session import configure  # noqa: E402


def make_session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("annualis")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             .config("spark.sql.warehouse.dir", "/tmp/annualis-warehouse")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark, shuffle_partitions=8)


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
