import pytest

from lakeops.session import get_spark


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark("lakeops-tests", "local[8]", **{
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
