import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourline.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("hourline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    session = configure(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
