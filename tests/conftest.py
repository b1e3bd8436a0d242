from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from careledger.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="careledger-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixture_tables(spark):
    """The sf0.001 fixture written once as parquet, read back as Sources."""
    from careledger.config import DEFAULT_AS_OF
    from careledger.sources.fixtures import load_fixture
    from careledger.sources.tables import read_tables, write_tables

    root = tempfile.mkdtemp(prefix="careledger-test-tables-")
    write_tables(load_fixture(spark, SF_SMALL, DEFAULT_AS_OF), root)
    return read_tables(spark, root)
