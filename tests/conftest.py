import contextlib
import io
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import oracle  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("sparkmart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.fixture
def plan_of():
    """The physical plan's text, as ``explain`` prints it."""

    def text(df, mode="formatted"):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain(mode)
        return out.getvalue()

    return text


@pytest.fixture
def rows():
    """Rows as a sorted list of tuples, NULLs included."""

    def listed(df):
        return sorted((tuple(row) for row in df.collect()), key=repr)

    return listed
