import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ":".join(x for x in (ROOT, os.environ.get("PYTHONPATH", "")) if x)


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="spark-")
    made = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
