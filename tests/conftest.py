import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from panelwright.session import DEFAULT_CONF, RUNTIME_CONF  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    b = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "8g"))
    for k, v in {**DEFAULT_CONF, **RUNTIME_CONF}.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder only where the session has none
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pw-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def cached_frames_end_with_their_module():
    """A module's cached frames do not reach the tests that look for leftovers."""
    yield
    s = SparkSession.getActiveSession()
    if s is not None:
        s.catalog.clearCache()


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
