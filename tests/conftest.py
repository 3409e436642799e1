import os
import sys

os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")  # before numpy: its threaded solvers can hang beside a JVM

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lumenfold.session import local_session

    return local_session("4", 4)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
