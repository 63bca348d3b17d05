import duckdb
import pytest
from oracle import connect, differences

import __spark_entry__ as entries
from sluicegate.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(name for name, entry in REGISTRY.items() if entry.sql))
def test_query_matches_its_sql(spark, connection, name):
    sql = entries.oracle_sql()[name]
    assert differences(spark, connection, name, entries.queries()[name], sql, SMALL) is None


def test_entry(spark):
    assert {r.key for r in entries.entry(spark).collect()} == {"error:max:o_totalprice", "warning:in:o_orderstatus"}


def test_balances_around_zero_match_the_sql(spark, tmp_path):
    balances = [-1.0, -0.9999999999999999, -0.5, -0.01, -0.0, 0.0, 0.01, 255.99, 256.0, None]
    customers = spark.createDataFrame(list(enumerate(balances)), "c_custkey long, c_acctbal double")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    connection = duckdb.connect()
    connection.execute(f"create view customer as select * from read_parquet('{tmp_path}/customer.parquet/*.parquet')")
    name = "schema_cast_unsigned"
    run, sql = entries.queries()[name], entries.oracle_sql()[name]
    assert differences(spark, connection, name, run, sql, str(tmp_path)) is None
    assert [r.tiny for r in run(spark, str(tmp_path)).orderBy("c_custkey").collect()] == [
        None, "-0.0", "-0.0", "-0.0", "-0.0", "0.0", "0.0", "255.0", None, None,
    ]
