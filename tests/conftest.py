from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from perkmill.params import Params  # noqa: E402
from perkmill.schemas import LEDGER, schema_of  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "4000")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Builds a contract table from dicts; columns left out are null."""

    def build(name: str, rows: list[dict]):
        schema = LEDGER if name == "ledger" else schema_of(name)
        unknown = {k for row in rows for k in row} - set(schema.names)
        assert not unknown, unknown
        return spark.createDataFrame([tuple(row.get(n) for n in schema.names) for row in rows], schema)

    return build


@pytest.fixture
def params():
    return Params(as_of=datetime(2024, 3, 1, 9, 0))


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    return SF
