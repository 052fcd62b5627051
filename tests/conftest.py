import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (SparkSession.builder.master("local[8]").appName("tests")
         .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
         .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.maxMetadataStringLength", "10000").config("spark.sql.debug.maxToStringFields", "1000")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
         .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def rows(df, *cols):
    """Rows as sorted tuples, nulls first."""
    df = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
