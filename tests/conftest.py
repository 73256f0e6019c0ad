import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "6g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    from vintora.session import prepare
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def book(spark):
    from vintora.plans.book import Book
    return Book.open(spark, SF)


@pytest.fixture(params=[2, 40])
def ranges(request, spark):
    """Few and many ranges for the windows over keys of any size."""
    spark.conf.set("spark.vintora.ranges", str(request.param))
    yield request.param
    spark.conf.unset("spark.vintora.ranges")
