from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketgraph.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, app="basketgraph-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples, for order-insensitive comparison."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
