import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyward.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.01"


# Columns can only be made while a session runs, and test modules make some on import.
SESSION = build_session(
    "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="4g"
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def d(text):
    """ISO text to date."""
    return None if text is None else dt.date.fromisoformat(text)


def rows(df, *cols):
    """Rows as a sorted list of tuples, nulls last."""
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))
