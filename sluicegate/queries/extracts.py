"""SQL extracts: projection and filter in one statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluicegate.queries.base import query, table
from sluicegate.sources.sql import extract


def _view(spark: SparkSession, sf_dir: str, name: str) -> str:
    view = f"extract_{name}"
    table(spark, sf_dir, name).createOrReplaceTempView(view)
    return view


@query(
    """select c_custkey as customer, c_name as name, c_acctbal as balance from customer
    where c_acctbal > 0 and c_mktsegment = 'BUILDING'"""
)
def src_sql_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _view(spark, sf_dir, "customer")
    return extract(
        spark,
        f"""SELECT c_custkey AS customer, c_name AS name, c_acctbal AS balance
        FROM {view} WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING';""",
    )


@query("select o_orderkey, o_totalprice from orders where year(o_orderdate) = 1998 and o_totalprice > 0")
def src_year_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _view(spark, sf_dir, "orders")
    sql = "select o_orderkey, o_totalprice from " + view + """
        where o_orderdate >= make_timestamp_ntz({{ano}}, 1, 1, 0, 0, 0)
          and o_orderdate < make_timestamp_ntz({{ano}} + 1, 1, 1, 0, 0, 0) and o_totalprice > 0"""
    return extract(spark, sql, {"ano": "1998"})


@query("select o_orderkey, o_orderstatus from orders where o_totalprice > 400000.0 and o_orderstatus = 'F'")
def src_bound_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _view(spark, sf_dir, "orders")
    sql = f"select o_orderkey, o_orderstatus from {view} where o_totalprice > :floor and o_orderstatus = :status"
    return extract(spark, sql, {"floor": 400000.0, "status": "F"})


@query("select o_orderkey, o_orderstatus from orders where o_totalprice < 20000.0 and o_orderstatus = 'O'")
def src_bound_params_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _view(spark, sf_dir, "orders")
    sql = f"select o_orderkey, o_orderstatus from {view} where o_totalprice < ? and o_orderstatus = ?"
    return extract(spark, sql, [20000.0, "O"])
