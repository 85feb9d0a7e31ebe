from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starforge.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="starforge-test-")
    s = build_session(
        app="starforge-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": os.path.join(ckpt, "warehouse")},
    )
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparison)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
