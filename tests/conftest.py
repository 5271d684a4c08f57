import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from loomvault.session import SETTINGS
    builder = SparkSession.builder.master("local[8]").appName("tests")
    settings = {**SETTINGS, "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
                "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def warehouse(spark):
    from loomvault.registry.base import warehouse as build
    return build(spark, SMALL)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert rows(left, *columns) == rows(right, *columns)
