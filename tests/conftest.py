import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsegrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": str(folder / "warehouse"),
        "spark.checkpoint.dir": str(folder / "shared"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(frame, *columns):
    """Rows as sorted tuples."""
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture
def as_rows():
    return rows
