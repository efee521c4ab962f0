from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import ensure_checkpoint_dir, get_spark
    session = get_spark("tests", 8, shuffle_partitions=4, driver_memory="6g")
    ensure_checkpoint_dir(session)
    return session


@pytest.fixture
def folder():
    """A new folder per test; the operating system clears /tmp."""
    return tempfile.mkdtemp(prefix="tidemark-test-")


def rows(df, *columns):
    """Rows as sorted tuples."""
    got = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in got), key=lambda r: tuple((v is None, str(type(v)), v) if not isinstance(v, (list, dict)) else (False, "", str(v)) for v in r))
