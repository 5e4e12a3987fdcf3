import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from metamart.session import get_spark  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="metamart-tests", shuffle_partitions=4,
                  extra={"spark.driver.memory": "4g",
                         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="metamart-wh-")})
    yield s
    s.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "wh")
