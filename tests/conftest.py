import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("docketmill-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="docketmill-checkpoint-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    names = "region nation customer orders lineitem documents pages conversations".split()
    return {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in names}
