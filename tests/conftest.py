import pathlib
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.TemporaryDirectory(prefix="snapmart-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("snapmart-tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch.name}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch.name}/warehouse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
    scratch.cleanup()
