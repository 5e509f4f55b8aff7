import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
        "spark.sql.session.timeZone": "UTC", "spark.local.dir": tempfile.mkdtemp(prefix="spark-"), "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-"),
    }
    session = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
