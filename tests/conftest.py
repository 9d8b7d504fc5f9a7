import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tessera.session import build_session
    s = build_session("local[4]", 8, app_name="tessera-tests")
    # Tests only: the cluster names spark.checkpoint.dir; here it is unset.
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()
