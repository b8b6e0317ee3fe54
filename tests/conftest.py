import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from casebook.session import checkpoint_dir, get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app="casebook-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="casebook-warehouse-")})
    # tests only: set a checkpoint folder when the session has none
    checkpoint_dir(s, tempfile.mkdtemp(prefix="casebook-test-ckpt-"))
    yield s


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns when none given)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
