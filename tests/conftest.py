from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from telmart.session import get_spark  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = get_spark(
        "tests",
        "local[4]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
        },
        "ERROR",
    )
    yield session
    session.stop()


@pytest.fixture
def name():
    """A table name of its own for every test."""
    return f"t_{uuid.uuid4().hex[:12]}"


def rows_of(df, *order_by):
    """Rows as tuples, sorted for comparison."""
    return sorted(map(tuple, df.collect()), key=repr)
