import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from acceptance.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def pages_of(spark):
    """Literal pages: ``pages_of(html, ...)`` gives ``page_id, url, html``."""

    def make(*html):
        rows = [(i, f"https://portal.example/p/{i}", h) for i, h in enumerate(html)]
        return spark.createDataFrame(rows, "page_id bigint, url string, html string")

    return make
