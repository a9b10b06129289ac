import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (SparkSession.builder.master("local[8]").appName("posegrid-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         # call-site capture costs several JVM round trips per column expression
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
         .config("spark.driver.memory", "8g").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
