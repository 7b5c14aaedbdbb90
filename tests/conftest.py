import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from labelflow.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    # Unset in tests, so a folder of this machine stands for the shared one.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="labelflow-tests-"))
    yield session
    session.stop()


def rows(df, *keys):
    """Rows as tuples, sorted by their text."""
    picked = df.select(*keys) if keys else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
