import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from harvestline.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", "local[4]", 4, spark__ui__enabled="false", spark__driver__memory="8g",
                        spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""
    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
    return collect
