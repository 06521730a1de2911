from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidelog.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__sql__warehouse__dir=str(home / "warehouse"),
        spark__checkpoint__dir=str(home / "checkpoints"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def values(spark):
    """Rows of one column expression over literal inputs: values("a, b", rows, expr)."""

    def run(schema, rows, expr):
        rows = [(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)]
        df = spark.createDataFrame(rows, f"_i int, {schema}")
        return [r.v for r in df.select("_i", expr.alias("v")).orderBy("_i").collect()]

    return run
