import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[*]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__default__parallelism="4",
        spark__sql__warehouse__dir=str(root / "warehouse"),
        spark__driver__memory="4g",
        spark__log__level="ERROR",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame of literal rows under a DDL schema."""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as plain tuples, in the order returned."""
    return lambda df: [tuple(r) for r in df.collect()]
