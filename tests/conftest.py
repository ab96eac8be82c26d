import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caseline.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write_lines(tmp_path):
    """Write rows as a tab-separated file and return its path."""

    def write(name, rows, end="\n"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(end.join("\t".join(r) for r in rows).encode() + end.encode())
        return str(path)

    return write


def rows(df, *names):
    """Collected rows as tuples, ordered."""
    picked = df.select(*names) if names else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
