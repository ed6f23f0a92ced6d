import os

os.environ.setdefault("OMP_NUM_THREADS", "1")

import pytest

from claimlens.plans.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("local[4]", 4, **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
