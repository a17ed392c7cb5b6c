import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers of Spark import the package as well.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from tidegauge.session import local_session

    session = local_session("tests", cpus=8, partitions=3)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
