import duckdb
import pytest

from __spark_entry__ import entry
from check import TABLES, differences
from testbed.catalog import QUERIES
from testbed.oracle import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, db, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got) > 0
    assert differences(got, db.sql(ORACLES[name]).df()) is None


def test_entry(spark):
    assert entry(spark).columns[0] == "status"


def test_features_and_sizes_of_a_listing_are_worked_out_once(spark):
    """Filters on what comes of the feature map do not make it anew."""
    from testbed.catalog import rejected_reasons, valid_listings

    for query in (valid_listings, rejected_reasons):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("map_from_entries") == 1
    assert plan.count("THEN double ELSE single END") == 1  # no second time for the filter on the reason


def test_rows_that_are_read_twice_are_made_once(spark):
    """A sort reads its rows for the bounds and again, a union once per side: they are written first."""
    from testbed.catalog import append_listings, export_ranked

    for query in (export_ranked, append_listings):
        plan = query(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
