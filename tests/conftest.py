import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from entityhealth.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", 4)
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Rows as a sorted list of tuples."""

    def read(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

    return read


@pytest.fixture()
def plan():
    """The formatted physical plan as text."""

    def read(df, capsys):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return read
