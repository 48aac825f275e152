import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from usagelens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    from usagelens.sources.tables import Warehouse

    folder = Warehouse(spark, str(tmp_path / "warehouse"))
    folder.ensure_tables()
    return folder


def rows(df, *columns):
    """Sorted tuples of a result."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
