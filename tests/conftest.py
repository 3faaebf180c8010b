import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesloom.operators.staging import clear_staged  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="salesloom-warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="salesloom-shared-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_staged(session)
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)
