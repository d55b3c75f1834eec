import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from aurum.session import build_session
    s = build_session("local[*]", app="aurum-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="aurum-test-ckpt-")})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from aurum.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
