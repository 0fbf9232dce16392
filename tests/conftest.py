import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    at = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.master": "local[4]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "3g",
        "spark.sql.warehouse.dir": f"{at}/warehouse", "spark.checkpoint.dir": f"file://{at}/shared", "spark.ui.showConsoleProgress": "false",
    }
    s = SparkSession.builder.config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
