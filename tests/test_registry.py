"""Every registered query runs; those with SQL agree with it on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from limnos import registry
from tools.check_queries import compare

SF = "/root/testdata/sf0.001"
RUNNERS, ORACLES = registry.runners(), registry.oracles()


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(RUNNERS)


@pytest.mark.parametrize("name", sorted(RUNNERS))
def test_query(spark, connection, name):
    message, rows = compare(spark, connection, SF, RUNNERS[name], ORACLES.get(name))
    assert message is None, message
