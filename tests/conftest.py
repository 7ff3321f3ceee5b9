import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regstar.session import ensure_checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="regstar-tests")
    ensure_checkpoint_dir(s)
    yield s


def rows(df, *cols):
    """Collected rows as tuples (optionally of some columns), in frame order."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")
