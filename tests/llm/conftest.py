import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sparkmart.llm.work import reachable  # noqa: E402


@pytest.fixture(scope="session")
def llm(spark):
    return reachable(spark)
