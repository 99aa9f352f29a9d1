import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers find the package wherever the tests are started.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from tillwright import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    spark = session.local("tests", cores=4, **{
        "spark.checkpoint.dir": str(folder),
        "spark.sql.warehouse.dir": str(folder / "warehouse"),
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    })
    yield spark
    spark.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df):
    """Rows as sorted tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
