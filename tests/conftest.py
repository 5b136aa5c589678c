import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from massloom.session import build_session, ship_package  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "massloom-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return str(TESTDATA / "sf0.001")


@pytest.fixture
def values(spark):
    """The values of one column expression over a list of inputs, in order."""
    from pyspark.sql import functions as F

    def run(inputs, ddl, expression):
        rows = [(i, x) for i, x in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"at int, x {ddl}")
        return [r[0] for r in df.orderBy("at").select(expression(F.col("x"))).collect()]

    return run
