import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitlens.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    import tempfile
    wh = tempfile.mkdtemp(prefix="visitlens-warehouse-")
    s = get_spark("local[4]", shuffle_partitions=8, app_name="visitlens-tests",
                  extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()
