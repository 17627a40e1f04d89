import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vigia.session import get_spark
    # spark.checkpoint.dir comes from the Spark defaults when set there;
    # checkpoint_dir() picks a scratch folder only if it is unset.
    s = get_spark("local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="vigia-t-")
