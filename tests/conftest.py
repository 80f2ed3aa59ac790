import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from boxstats.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="boxstats-warehouse-", dir="/tmp")
    s = build_session("local[4]", shuffle_partitions=8, app_name="boxstats-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()
