import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")


@pytest.fixture(scope="session")
def spark():
    from pointlake.plans.session import local_session
    s = local_session(4, 4, app="pointlake-tests")
    yield s
    s.stop()


@pytest.fixture
def fixture_path():
    return lambda name: os.path.join(FIXTURES, name)
