import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from hearth.session import build_session, shared_dir
    s = build_session(master="local[4]", shuffle_partitions=8, app="hearth-tests",
                      driver_memory="4g")
    shared_dir(s)            # tests own the session: register a scratch checkpoint dir
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as a list of tuples (sorted unless an order is given)."""
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=lambda t: tuple(str(x) for x in t))
