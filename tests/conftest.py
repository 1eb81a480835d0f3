import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from flowsift.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("8", 8, "flowsift-tests")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def oracle():
    import duckdb

    con = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con
