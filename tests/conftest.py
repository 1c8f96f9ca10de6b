import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from mediaweave.session import ship  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC"}
    session = SparkSession.builder.master("local[4]").appName("tests").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield ship(session)
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not Path(DATA).is_dir():
        pytest.skip("no test tables here")
    return DATA
