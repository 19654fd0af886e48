import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from changefold.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.maxMetadataStringLength", "1000")
    return session
