import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def make_session() -> SparkSession:
    from tagloom.session import configure

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tagloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tagloom-tests-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return configure(spark)


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    from tagloom.session import release

    release(session)
    session.stop()
