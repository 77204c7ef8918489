import os

import pytest

os.environ.setdefault("BENCH_CPUS", "4")


@pytest.fixture(scope="session")
def spark():
    from checks.local import local_session

    session = local_session()
    yield session
    session.stop()
