"""Every query with an SQL oracle gives the oracle's rows."""

import compare
import pytest

import __spark_entry__ as contract
from wxspark.catalog.oracles import ORACLES
from wxspark.catalog.queries import QUERIES

# Too few minutes in the smallest tables to learn every step of the hour.
FITTED = {
    "forest_classify",
    "forest_regress",
    "train_metrics",
    "score_requests",
    "verify_batch",
    "verify_stream",
    "forecast_timeline",
}
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(sf_dir):
    with compare.connect(sf_dir) as small, compare.connect(LARGER) as larger:
        yield {sf_dir: small, LARGER: larger}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf_dir, tables, name):
    path = LARGER if name in FITTED else sf_dir
    assert compare.differences(QUERIES[name](spark, path), ORACLES[name], tables[path]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
