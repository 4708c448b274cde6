import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from assayspark.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
