import pytest
from pyspark.sql import SparkSession

from millrace.session import configure, ship_package


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("millrace-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(shared))  # each test session keeps to its own folder
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield configure(session)
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path / "lake")
