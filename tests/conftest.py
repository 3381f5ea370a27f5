import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from txnguard.session import local_session
    session = local_session("4", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.sql.maxMetadataStringLength": "2000"})  # plans name whole paths
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
