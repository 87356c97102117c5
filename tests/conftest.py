import pytest

from stayspark.session import local_session, ship


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=4, partitions=4, name="tests", memory="3g")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
