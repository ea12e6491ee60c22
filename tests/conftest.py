import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from headwater.session import session

    found = session("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    yield found
    found.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
