from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from canvass.session import ensure_checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    warehouse = tempfile.mkdtemp(prefix="canvass-catalog-", dir="/tmp")
    s = local_session(4, shuffle_partitions=8, app="canvass-tests", conf={"spark.sql.warehouse.dir": warehouse})
    ensure_checkpoint_dir(s)
    yield s


def rows(df, *cols):
    """Result rows as sorted tuples (NULL sorts first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
