import os

import pytest

from ledgerguard.session import session

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session(
        "local[8]", "ledgerguard-tests",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}",
    )
    s.sparkContext.setLogLevel("FATAL")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def frame(spark):
    """Rows of text from tuples and a space-separated list of columns."""
    def make(rows, columns, types=None):
        names = columns.split()
        types = types or ["string"] * len(names)
        schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types))
        return spark.createDataFrame(rows, schema)
    return make
