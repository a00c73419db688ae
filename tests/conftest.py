import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark

    s = get_spark(
        "tessera-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tessera-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tessera-test-")
