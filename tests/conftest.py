from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app="tidemark-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="tidemark-tests-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (small hand-made frames only)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
