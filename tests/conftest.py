import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # tiny data: compiling every plan would take most of the time; tests/compare.py runs with compiled plans
    return session("stationlab-tests", **{"spark.sql.codegen.wholeStage": "false"})
