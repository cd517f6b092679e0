import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from policylens.session import build_session
    s = build_session("local[*]", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from policylens.sources.tables import RAW_TABLES
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con
