import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from pricebeam.session import local_session, scratch_path  # noqa: E402
from pricebeam.sources.tables import Layers, create_layers  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    """Makes new, unused paths."""
    return lambda label="test": scratch_path(spark, label)


@pytest.fixture
def layers(spark, scratch):
    root = scratch("tables")
    made = Layers(f"t_{root.rsplit('-', 1)[-1][:10]}_", root)
    create_layers(spark, made)
    return made
