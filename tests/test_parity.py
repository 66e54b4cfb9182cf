"""Every query with a check query equals it in rows, columns, types and values."""

import os

import pytest

import __spark_entry__ as entry_point
from tests.parity import compare, duck, duck_types, spark_types

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_check_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert spark_types(df) == duck_types(con, ORACLES[name])
    equal, message = compare(df, con, ORACLES[name])
    assert equal, message
    assert not message.startswith("0 rows"), "an empty result proves nothing"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_check_query_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_fixed_schemas_are_those_of_the_files(spark):
    from cantora.plans.model import SCHEMAS, table

    for name in SCHEMAS:
        assert table(spark, SF_DIR, name).schema == spark.read.parquet(f"{SF_DIR}/{name}.parquet").schema, name


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["artist", "album", "avg_lexical_density", "avg_readability_score", "avg_sentiment_score", "rank"]
    assert df.count() > 0
