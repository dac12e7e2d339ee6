import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from hearthrate.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session("tests", "8")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
