import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

DATA = os.path.join(ROOT, "tests", "data")
SOURCE_SAMPLE = os.path.join(DATA, "source-sample")
OBJECT_SAMPLE = os.path.join(DATA, "object-sample")
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from skygrid.session import build_session
    scratch = tempfile.mkdtemp(prefix="skygrid-tests-")
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="skygrid-tests",
                      extra={"spark.checkpoint.dir": f"{scratch}/ckpt"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sources(spark):
    from skygrid.sources.catalogue import read_sources
    return read_sources(spark, SOURCE_SAMPLE).cache()
