import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.session import build_session, scratch_path  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def tmp_root(spark):
    return scratch_path(spark, "test")


def write_text(path: str, name: str, text: str) -> None:
    """Write a small raw file (fixtures only)."""
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write(text)
