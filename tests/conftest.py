import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyforge.session import clean_scratch, get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app_name="tallyforge-tests", shuffle_partitions=8,
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tf-warehouse-")})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tf-tests-"))
    yield s
    clean_scratch(s)
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder per test under the session's checkpoint root."""
    from tallyforge.session import scratch_root
    return tempfile.mkdtemp(prefix="t-", dir=scratch_root(spark))


SF_SMALL = "/root/testdata/sf0.001"
