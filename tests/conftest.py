import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import get_spark

    yield get_spark("local[4]", 4, "4g")
