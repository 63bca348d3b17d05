"""The checks: rows that break a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.operators.check import ROW_INVALID, ROW_WARNING
from sluicegate.queries.base import (
    SQL_WHITESPACE,
    WITH_DIRTY_ORDERS,
    checked,
    dirty_orders,
    query,
    table,
)


@query(
    WITH_DIRTY_ORDERS
    + f"""select o_orderkey, priority_txt from dirty_orders
    where priority_txt is null or trim(priority_txt, {SQL_WHITESPACE}) = ''"""
)
def val_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = checked(dirty_orders(spark, sf_dir), {"priority_txt": [{"rule": "required"}]})
    return result.invalid.select("o_orderkey", "priority_txt")


@query("select c_custkey, c_acctbal from customer where c_acctbal < 0")
def val_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = checked(table(spark, sf_dir, "customer"), {"c_acctbal": [{"rule": "min", "value": 0}]})
    return result.invalid.select("c_custkey", "c_acctbal")


@query("select o_orderkey, o_totalprice from orders where o_totalprice > 450000")
def val_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = checked(table(spark, sf_dir, "orders"), {"o_totalprice": [{"rule": "max", "value": 450000}]})
    return result.invalid.select("o_orderkey", "o_totalprice")


@query("select c_custkey, c_acctbal from customer where c_acctbal <= 0")
def val_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = checked(table(spark, sf_dir, "customer"), {"c_acctbal": [{"rule": "gt", "value": 0}]})
    return result.invalid.select("c_custkey", "c_acctbal")


@query("select c_custkey, c_acctbal from customer where c_acctbal < 0")
def val_ge(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = checked(table(spark, sf_dir, "customer"), {"c_acctbal": [{"rule": "ge", "value": 0}]})
    return result.invalid.select("c_custkey", "c_acctbal")


@query("select p_partkey, p_name from part where length(p_name) > 10")
def val_max_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = checked(table(spark, sf_dir, "part"), {"p_name": [{"rule": "len_max", "value": 10}]})
    return result.invalid.select("p_partkey", "p_name")


@query("select doc_id, length(text) as chars from documents where length(text) > 20000")
def val_max_length_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = checked(table(spark, sf_dir, "documents"), {"text": [{"rule": "max_length", "value": 20000}]})
    return result.invalid.select("doc_id", F.char_length("text").cast("bigint").alias("chars"))


@query("select c_custkey, c_name from customer where not regexp_matches(c_name, '#0000000\\d+$')")
def val_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"rule": "regex", "pattern": r"#0000000\d+$"}
    return checked(table(spark, sf_dir, "customer"), {"c_name": [rule]}).invalid.select("c_custkey", "c_name")


@query(
    """select doc_id, lang from documents
    where not regexp_matches(text, '[a-z0-9._-]+@[a-z0-9-]+(\\.[a-z0-9-]+)+|https?://[a-z0-9.-]+')"""
)
def val_regex_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"rule": "regex", "pattern": r"[a-z0-9._-]+@[a-z0-9-]+(\.[a-z0-9-]+)+|https?://[a-z0-9.-]+"}
    return checked(table(spark, sf_dir, "documents"), {"text": [rule]}).invalid.select("doc_id", "lang")


@query("select event_id, event_type from events where event_type not in ('view', 'click', 'purchase')")
def val_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"rule": "in", "values": ["view", "click", "purchase"]}
    return checked(table(spark, sf_dir, "events"), {"event_type": [rule]}).invalid.select("event_id", "event_type")


@query("select o_orderkey from orders where cast(o_orderdate as date) < date '1996-01-01'")
def val_date_gte(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"rule": "date_gte", "value": "1996-01-01"}
    return checked(table(spark, sf_dir, "orders"), {"o_orderdate": [rule]}).invalid.select("o_orderkey")


@query("select o_orderkey from orders where cast(o_orderdate as date) > date '2001-01-01'")
def val_date_lte(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"rule": "date_lte", "value": "2001-01-01"}
    return checked(table(spark, sf_dir, "orders"), {"o_orderdate": [rule]}).invalid.select("o_orderkey")


@query(
    WITH_DIRTY_ORDERS
    + f"""select o_orderkey, date_txt from dirty_orders
    where trim(date_txt, {SQL_WHITESPACE}) <> ''
      and try_strptime(trim(date_txt, {SQL_WHITESPACE}), '%Y-%m-%d') is null"""
)
def val_date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"rule": "date_format", "format": "yyyy-mm-dd"}
    return checked(dirty_orders(spark, sf_dir), {"date_txt": [rule]}).invalid.select("o_orderkey", "date_txt")


@query(
    """select event_id, value from events
    where not regexp_matches(replace(cast(value as varchar), ',', '.'), '^-?\\d+(\\.\\d{1,1})?$')"""
)
def val_decimal_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"rule": "decimal_scale", "scale": 1}
    return checked(table(spark, sf_dir, "events"), {"value": [rule]}).invalid.select("event_id", "value")


@query(
    WITH_DIRTY_ORDERS
    + f"""select o_orderkey, amount_txt from dirty_orders
    where trim(amount_txt, {SQL_WHITESPACE}) <> '' and not regexp_matches(
      replace(trim(amount_txt, {SQL_WHITESPACE}), ',', '.'), '^-?\\d+(\\.\\d{{1,2}})?$')"""
)
def val_decimal_scale_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"rule": "decimal_scale", "scale": 2}
    return checked(dirty_orders(spark, sf_dir), {"amount_txt": [rule]}).invalid.select("o_orderkey", "amount_txt")


@query(
    WITH_DIRTY_ORDERS
    + """select o_orderkey, cpf_cnpj_credor from dirty_orders
    where (tipo_credor = 1 and length(regexp_replace(coalesce(cpf_cnpj_credor, ''), '[^0-9]', '', 'g')) <> 11)
       or (tipo_credor = 2 and length(regexp_replace(coalesce(cpf_cnpj_credor, ''), '[^0-9]', '', 'g')) <> 14)"""
)
def val_cross_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = checked(dirty_orders(spark, sf_dir), {}, [{"rule": "cpf_cnpj_by_tipo_credor"}])
    return result.invalid.select("o_orderkey", "cpf_cnpj_credor")


@query(
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_tax from lineitem
    where l_discount < 0.02 and l_tax > 0.07"""
)
def val_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("low_discount", (F.col("l_discount") < 0.02).cast("int"))
    rule = {"rule": "max", "value": 0.07, "when": {"field": "low_discount", "op": "eq", "value": 1}}
    result = checked(lines, {"l_tax": [rule]})
    return result.invalid.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_tax")


@query(
    """select o_orderkey,
      case when o_totalprice > 450000 then 'error'
           when o_orderstatus not in ('F', 'O') then 'warning' else 'valid' end as status
    from orders"""
)
def val_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = checked(
        table(spark, sf_dir, "orders"),
        {
            "o_totalprice": [{"rule": "max", "value": 450000, "level": "ERROR"}],
            "o_orderstatus": [{"rule": "in", "values": ["F", "O"], "level": " Warning "}],
        },
    )
    status = F.when(F.col(ROW_INVALID), "error").when(F.col(ROW_WARNING), "warning").otherwise("valid")
    return result.frame.select("o_orderkey", status.alias("status"))


@query("select o_orderkey, o_totalprice from orders where o_totalprice > 450000 or o_totalprice < 2000")
def val_top_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [
        {"rule": "max", "field": "o_totalprice", "args": {"value": 450000}},
        {"rule": "min", "field": "o_totalprice", "value": 2000},
    ]
    return checked(table(spark, sf_dir, "orders"), {}, rows).invalid.select("o_orderkey", "o_totalprice")
