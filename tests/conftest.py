import pytest

from bodega.queries import Tables
from bodega.session import build_session
from bodega.sources.store import Store

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SMALL)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))
