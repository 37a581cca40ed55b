import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from newsloom import create_spark_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.conf import SparkConf

    extra = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    if not SparkConf().contains("spark.checkpoint.dir"):
        extra["spark.checkpoint.dir"] = str(tmp_path_factory.mktemp("checkpoints"))
    session = create_spark_session("tests", "local[4]", memory={"driver": "4g"}, extra=extra)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
