import pytest

from starloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("starloom-tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a frame as a sorted list of tuples."""

    def of(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return of
