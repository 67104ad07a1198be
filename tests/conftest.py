from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from derrick.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "derrick-tests",
        master=f"local[{os.environ.get('TEST_CPUS', '4')}]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def seed(spark):
    """The reference data set of FIXTURES.md, as frames by table name."""
    from seed_data import seed_tables

    return {name: df.cache() for name, df in seed_tables(spark).items()}
