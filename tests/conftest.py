import json
import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("recordflow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def records(spark):
    """A frame of JSON records from Python values or raw texts; ``ordinal`` keeps their order."""

    def make(*values):
        rows = [(i, f"k{i}", v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "ordinal long, key string, value string")

    return make


@pytest.fixture
def read(spark):
    """Parsed values of a column, in order."""

    def collect(df, column="value", order="ordinal"):
        return [None if r[0] is None else json.loads(r[0]) for r in df.orderBy(order).select(column).collect()]

    return collect
