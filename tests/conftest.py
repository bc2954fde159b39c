import pytest

from tallyweb.session import local


@pytest.fixture(scope="session")
def spark():
    return local("4", 4)
