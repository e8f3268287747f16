"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pytest
from compare import difference
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.plans.inputs import TABLES
from tidemark.plans.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert difference(result, duck, contract.oracle_sql()[name]) == ""


LEG_QUERIES = [
    "legacy_swap", "null_gate", "period_windows", "report_duplicates", "report_nulls", "report_period",
    "report_total", "schema_align", "silver_e2e", "static_align",
]


@pytest.fixture(scope="module")
def odd_dates(spark, tmp_path_factory):
    """Line items shipped long ago, far in the future or never, some without status."""
    path = str(tmp_path_factory.mktemp("odd"))
    items = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").limit(700)
    days = ["1925-03-04", "1969-01-01", "1994-06-15", "1994-12-31", "2068-12-20", "2100-01-01", "2345-06-07"]
    third = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(12)).cast("int")
    odd = F.element_at(F.array(*[F.lit(d).cast("timestamp_ntz") for d in days]), F.least(third, F.lit(6)) + 1)
    items.withColumns({
        "l_shipdate": F.when(third < 7, odd).when(third > 7, F.col("l_shipdate")),
        "l_linestatus": F.when(F.col("l_linenumber") != 3, F.col("l_linestatus")),
    }).coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW lineitem AS FROM '{path}/lineitem.parquet/*.parquet'")
    return path, connection


@pytest.mark.parametrize("name", LEG_QUERIES)
def test_no_line_item_is_lost(spark, odd_dates, name):
    path, connection = odd_dates
    result = QUERIES[name](spark, path)
    # A window has no place for a leg without a date.
    sql = ORACLE[name] + (" WHERE l_shipdate IS NOT NULL" if name == "period_windows" else "")
    assert difference(result, connection, sql) == ""
    if name == "schema_align":
        assert result.count() >= 700


def test_duplicate_report_shows_keys_equal_once_normalized(spark):
    assert QUERIES["report_duplicates"](spark, SF_DIR).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 9
