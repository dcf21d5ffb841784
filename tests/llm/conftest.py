"""Tables and paths for the tests of this folder."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.01"
