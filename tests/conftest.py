import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.retail import Retail  # noqa: E402
from tallyhouse.session import local_session  # noqa: E402
from tallyhouse.sources.tables import Lake  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("*", app="tests", spark__checkpoint__dir=shared)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def retail(spark):
    return Retail(spark, SF)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))
