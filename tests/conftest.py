import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parents[1]))

from folioscope.session import build_session  # noqa: E402

DATA = pathlib.Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", spark_sql_shuffle_partitions="8", spark_driver_memory="8g",
                            spark_ui_showConsoleProgress="false",
                            spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
                            spark_checkpoint_dir=str(tmp_path_factory.mktemp("stages")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(DATA / "sf0.001")
