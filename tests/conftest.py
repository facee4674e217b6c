import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakeops.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        "8",
        app="lakeops-tests",
        **{"spark.sql.maxMetadataStringLength": "5000", "spark.checkpoint.dir": str(root / "shared"), "spark.sql.warehouse.dir": str(root / "warehouse")},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    if not Path(SMALL).is_dir():
        pytest.skip("no test tables")
    return SMALL


def rows(df, *cols):
    """Rows as sorted tuples, for comparison without order."""
    out = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in out.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
