import os

import pytest

from tidemark.session import builder

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder(
            "tidemark-tests",
            **{
                "spark.sql.shuffle.partitions": "4",
                "spark.ui.enabled": "false",
                "spark.driver.memory": "4g",
                "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
                "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            },
        )
        .master("local[4]")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return DATA
