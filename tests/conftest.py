import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)
# Python workers (Data Source readers) import the package too
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (REPO, os.path.join(REPO, "tests"), os.environ.get("PYTHONPATH", "")) if p)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from freshstate.session import build_session, set_checkpoint_dir
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="freshstate-tests")
    # tests own their scratch folder; clusters name spark.checkpoint.dir themselves
    set_checkpoint_dir(s, str(tmp_path_factory.mktemp("ckpt")))
    yield s


@pytest.fixture
def scratch(spark):
    from freshstate.session import scratch_path
    return lambda name: scratch_path(spark, name)
