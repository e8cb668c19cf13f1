import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sediment.session import build_session  # noqa: E402

SF_DIR = os.environ.get("SEDIMENT_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "sediment-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": 8,
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "checkpoints"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def tables(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
