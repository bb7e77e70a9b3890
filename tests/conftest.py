import pytest

from tallyspark.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("tests", "local[4]", **{
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g", "spark.default.parallelism": "4"})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
