import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from civgraph.session import build_session
    s = build_session(app="civgraph-tests", master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def built(spark):
    """The whole pipeline run once over the raw fixtures."""
    import fixtures
    from civgraph.plans.pipeline import build_all
    root = tempfile.mkdtemp(prefix="civgraph-test-", dir=os.environ.get("TMPDIR", "/tmp"))
    raw, seeds = fixtures.write_all(root, spark)
    summary = build_all(spark, raw, seeds, f"{root}/out")
    summary["root"] = root
    summary["raw"] = raw
    return summary
