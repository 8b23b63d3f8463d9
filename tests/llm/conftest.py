import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tests_llm_helpers import AWKWARD, documents  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    return documents(spark, AWKWARD).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return documents(spark, [])
