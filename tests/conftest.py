import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__  # noqa: E402,F401  (ships the Arrow helpers by value)
from ferrocar.session import build  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("spark")
    local = {"spark.master": "local[8]", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"}
    local |= {"spark.checkpoint.dir": f"{shared}/checkpoints", "spark.sql.warehouse.dir": f"{shared}/warehouse"}
    session = build("tests", {**local, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a text expression over values."""

    def run(fn, values):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), "i int, c string").coalesce(1)
        return [r[0] for r in df.orderBy("i").select(fn(F.col("c"))).collect()]

    return run
