import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]


@pytest.fixture(scope="session")
def spark():
    from beaconry.streaming.run import tune_streams

    session = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "6g").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return tune_streams(session)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
