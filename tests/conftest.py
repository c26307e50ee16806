import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tellstar.session import local_session  # noqa: E402

from .fixtures import write_tree  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="tellstar-tests")
    yield s


@pytest.fixture()
def tree(tmp_path):
    root = tmp_path / "landing"
    write_tree(root)
    return str(root)


@pytest.fixture()
def raw_dir(tmp_path):
    return str(tmp_path / "raw")
