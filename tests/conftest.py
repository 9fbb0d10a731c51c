import sys
from pathlib import Path

import pytest
from pyspark import SparkConf
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from obstar.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("obstar-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
    )
    if not SparkConf().get("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()
