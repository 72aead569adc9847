import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shiftkit.session import build_session
    ckpt = tempfile.mkdtemp(prefix="shiftkit-test-ckpt-")
    s = build_session("local[4]", app="shiftkit-tests", shuffle_partitions=4,
                      conf={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shiftkit-test-")


def rows(df, *cols):
    """Collect as sorted tuples (optionally of selected columns)."""
    from shiftkit.functions.names import col
    d = df.select(*[col(c) for c in cols]) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=repr)
