import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session
    s = get_session("local[4]", 8, app_name="strata-tests", extra={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    from strata.session import checkpoint_dir
    checkpoint_dir(s)  # registers a local folder only when the setting is unset
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="strata-test-")
