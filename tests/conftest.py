import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def values():
    """Metric values of a result frame as ``{(instance, name): value}``."""

    def collect(df, *by):
        keys = [*by, "instance", "name"]
        return {tuple(r[k] for k in keys): r["value"] for r in df.collect()}

    return collect


@pytest.fixture
def reasons():
    """Failure reasons of a result frame as ``{(instance, name): reason}``."""

    def collect(df, *by):
        keys = [*by, "instance", "name"]
        return {tuple(r[k] for k in keys): r["reason"] for r in df.collect()}

    return collect
