import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import os

    from pyspark.sql import SparkSession

    os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
    place = tmp_path_factory.mktemp("shared")
    made = SparkSession.builder.master("local[4]").config(map={
        "spark.driver.memory": "3g", "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": f"file://{place}",
    }).getOrCreate()
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
