import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    if not any("spark.checkpoint.dir" in x for x in os.environ.get("PYSPARK_SUBMIT_ARGS", "").split()):
        builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a small frame from rows and a DDL schema."""

    def build(rows, ddl):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        return spark.createDataFrame(rows, ddl)

    return build


@pytest.fixture
def values():
    """The values of one column as a list."""
    return lambda df, column: [r[column] for r in df.select(column).collect()]
