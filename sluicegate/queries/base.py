"""What the queries share: the registry, the tables, and the contract over orders."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from sluicegate.contract import Contract
from sluicegate.functions.text import WHITESPACE
from sluicegate.operators.check import CheckedFrame, check
from sluicegate.operators.cleanup import clean
from sluicegate.rules import parse_rules

Query = Callable[[SparkSession, str], DataFrame]
Rules = Sequence[Mapping[str, Any]]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(run: Query) -> Query:
        REGISTRY[run.__name__] = Entry(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Orders with blanks, bad dates, bad numbers and bad document numbers. Runs unchanged in
# Spark SQL and DuckDB.
DIRTY_ORDERS = """
select o_orderkey, o_orderstatus, o_totalprice,
  case when o_orderkey % 11 = 0 then null
       when o_orderkey % 7 = 0 then '   ' else o_orderpriority end as priority_txt,
  case when o_orderkey % 13 = 0 then '1999-02-31'
       when o_orderkey % 6 = 0 then ''
       else concat(cast(year(o_orderdate) as string), '-',
                   lpad(cast(month(o_orderdate) as string), 2, '0'), '-',
                   lpad(cast(day(o_orderdate) as string), 2, '0')) end as date_txt,
  case when o_orderkey % 9 = 0 then '12,345'
       when o_orderkey % 10 = 0 then 'abc'
       else cast(cast(o_totalprice as decimal(18,2)) as string) end as amount_txt,
  case o_orderstatus when 'F' then 1 when 'O' then 2 else null end as tipo_credor,
  case when o_orderkey % 5 = 0 then lpad(cast(o_custkey as string), 10, '0')
       when o_orderstatus = 'F' then concat(lpad(cast(o_custkey as string), 9, '0'), '-01')
       else concat(lpad(cast(o_custkey as string), 8, '0'), '/0001-01') end as cpf_cnpj_credor
from {orders}
"""
WITH_DIRTY_ORDERS = f"with dirty_orders as ({DIRTY_ORDERS.format(orders='orders')}) "
SQL_WHITESPACE = f"'{WHITESPACE}'"


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DIRTY_ORDERS, orders=table(spark, sf_dir, "orders"))


def checked(df: DataFrame, fields: Mapping[str, Rules], rows: Rules = ()) -> CheckedFrame:
    """Check rules given per field, and rules over whole rows."""
    document = {"fields": {n: {"validate": list(r)} for n, r in fields.items()}, "validations": list(rows)}
    return check(df, parse_rules(document).checks)


def cleaned(df: DataFrame, fields: Mapping[str, Rules]) -> DataFrame:
    document = {"fields": {n: {"normalize": list(r)} for n, r in fields.items()}}
    return clean(df, parse_rules(document).cleanups).frame


ORDERS_FIELDS = (
    ("o_orderkey", "int64"),
    ("o_custkey", "int64"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "float64"),
    ("o_orderdate", "timestamp[ms]"),
    ("o_orderpriority", "string"),
)
TWO_LEVELS: Mapping[str, Any] = {
    "o_orderpriority": {"normalize": [{"op": "upper"}]},
    "o_totalprice": {"validate": [{"rule": "max", "value": 450000}]},
    "o_orderstatus": {"validate": [{"rule": "in", "values": ["F", "O"], "level": "warning"}]},
}


def orders_contract(
    fields: Mapping[str, Any] = TWO_LEVELS,
    partitions: Sequence[tuple[str, str, str]] = (("tc", "tc", "ctx"), ("ano", "ano", "ctx")),
    extra_fields: Sequence[tuple[str, str]] = (),
) -> Contract:
    schema = [{"name": n, "type": t, "nullable": True} for n, t in (*ORDERS_FIELDS, *extra_fields)]
    partitioning = {
        "style": "hive",
        "fields": [{"name": n, "source": s, "from": origin} for n, s, origin in partitions],
    }
    return Contract.from_dicts(
        "orders", "v1", {"fields": schema}, {"fields": fields, "partitioning": partitioning}
    )
