from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from logscore import configure


def new_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("logscore-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = new_session()
    yield session
    session.stop()
