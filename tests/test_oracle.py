"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from oracle import queries as oracle_queries
from oracle.compare import compare, connect
from riskforge.plans.queries import registry
from tests.conftest import SMALL

QUERIES = registry()
ORACLE = oracle_queries.registry()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SMALL), con, ORACLE[name])
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_rwa" in df.columns


SPARK_TO_DUCK = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_output_types_match(spark, con, name):
    """Only engine-neutral types leave a query: text, DOUBLE, BIGINT, BOOLEAN,
    and the same on both sides."""
    spark_types = {f.name: f.dataType.simpleString() for f in QUERIES[name](spark, SMALL).schema.fields}
    duck_types = {d[0]: str(d[1]) for d in con.execute(ORACLE[name] + " LIMIT 0").description}
    assert {c: SPARK_TO_DUCK.get(t) for c, t in spark_types.items()} == duck_types
