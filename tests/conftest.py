import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from salesmart.session import apply_defaults

    builder = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    apply_defaults(s)
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
