import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clicklake.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def plan_of():
    """The physical plan as text, before AQE changes it."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text


def rows_of(df, *columns):
    """Rows as a sorted list of plain tuples."""
    if columns:
        df = df.select(*columns)
    return sorted((tuple(row) for row in df.collect()), key=repr)
