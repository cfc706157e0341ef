from __future__ import annotations

import math
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallywright.session import SessionConfig  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    config = SessionConfig(
        app_name="tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    session = config.build()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small() -> str:
    folder = TESTDATA / "sf0.001"
    if not folder.exists():
        pytest.skip("test tables are not present")
    return str(folder)


def as_rows(df):
    """Rows as tuples in a fixed order; NaN becomes a comparable word."""
    columns = df.columns

    def plain(value):
        return "NaN" if isinstance(value, float) and value != value else value

    rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def assert_close(got, expected):
    """Same rows by transaction id; numbers may differ in their last digits."""
    assert got.columns == expected.columns
    found = {r["transaction_id"]: r for r in got.collect()}
    wanted = {r["transaction_id"]: r for r in expected.collect()}
    assert found.keys() == wanted.keys()
    for key, row in wanted.items():
        for column in expected.columns:
            a, b = found[key][column], row[column]
            if isinstance(b, float) and isinstance(a, float):
                same = (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9)
            else:
                same = a == b
            assert same, (key, column, a, b)
