import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from legworks.session import get_session

    session = get_session(master="local[4]", shuffle_partitions=4, app_name="legworks-tests")
    # tests own a local session: give it a checkpoint folder if none is configured
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield session
