import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from provdata.session import build_session
    import tempfile
    # Catalog tables (bucketed writes) go to a scratch warehouse, never into the repository.
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="provdata-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-")})
    yield s
    s.stop()
