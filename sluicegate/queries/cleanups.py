"""The clean-ups: every row with its cleaned value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.functions.casts import micros
from sluicegate.queries.base import SQL_WHITESPACE, WITH_DIRTY_ORDERS, cleaned, dirty_orders, query, table

# Both ends get whitespace that a plain trim leaves in place.
LEFT_BLANKS, RIGHT_BLANKS = "\t \u00a0", "\u3000\n\u2003"


@query(f"select conv_id, turn, trim(text, {SQL_WHITESPACE}) as text from conversations")
def norm_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat(F.lit(LEFT_BLANKS), "text", F.lit(RIGHT_BLANKS)).alias("text")
    )
    return cleaned(padded, {"text": [{"op": "trim"}]})


@query("select p_partkey, upper(p_name) as p_name from part")
def norm_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return cleaned(parts, {"p_name": [{"op": "upper"}]})


@query("select conv_id, turn, lower(text) as text from conversations")
def norm_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return cleaned(turns, {"text": [{"op": "lower"}]})


@query(
    """select o_orderkey, cast(cast(try_strptime(
        case when o_orderkey % 13 = 0 then '31/02/1999' else strftime(o_orderdate, '%d/%m/%Y') end,
        '%d/%m/%Y') as date) as varchar) as day
    from orders"""
)
def norm_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 13 == 0, "31/02/1999").otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("day"))
    parsed = cleaned(orders, {"day": [{"op": "to_date", "format": "%d/%m/%Y"}]})
    return parsed.select("o_orderkey", F.col("day").cast("string").alias("day"))


@query("select event_id, epoch_us(date_trunc('second', ts)) as ts_micros from events")
def norm_to_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.substring(F.col("ts").cast("string"), 1, 19).alias("ts")
    )
    parsed = cleaned(events, {"ts": [{"op": "to_datetime"}]})
    return parsed.select("event_id", micros(F.col("ts")).alias("ts_micros"))


@query(
    WITH_DIRTY_ORDERS
    + """select o_orderkey, coalesce(priority_txt, 'NONE') as priority_txt,
      coalesce(tipo_credor, 9) as tipo_credor from dirty_orders"""
)
def norm_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = dirty_orders(spark, sf_dir).select("o_orderkey", "priority_txt", "tipo_credor")
    rules = {
        "priority_txt": [{"op": "coalesce", "value": "NONE"}],
        "tipo_credor": [{"op": "coalesce", "value": 9}],
    }
    return cleaned(orders, rules)


@query("select p_partkey, regexp_replace(p_brand, '([A-Z])rand#(\\d)', '\\2/\\1', 'g') as p_brand from part")
def norm_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return cleaned(parts, {"p_brand": [{"op": "replace", "old": r"([A-Z])rand#(\d)", "new": "$2/$1"}]})


@query("select doc_id, regexp_replace(text, '[0-9]+', '0', 'g') as text from documents")
def norm_replace_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cleaned(documents, {"text": [{"op": "replace", "old": "[0-9]+", "new": "0"}]})


@query("select c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') as c_name from customer")
def norm_digits_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return cleaned(customers, {"c_name": [{"op": "digits_only"}]})


@query(
    """select o_orderkey,
      case when length(cast(o_custkey as varchar)) < 3
           then lpad(cast(o_custkey as varchar), 3, '*') else cast(o_custkey as varchar) end as customer
    from orders"""
)
def norm_lpad(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("customer"))
    return cleaned(orders, {"customer": [{"op": "lpad", "len": 3, "char": "*"}]})


@query(
    """select c_custkey, regexp_replace(upper(trim(c_name)), '^CUSTOMER#0*', 'C-', 'g') as c_name
    from customer"""
)
def norm_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit("\t")).alias("c_name")
    )
    steps = [{"op": "trim"}, {"op": "upper"}, {"op": "replace", "old": "^CUSTOMER#0*", "new": "C-"}]
    return cleaned(customers, {"c_name": steps})


@query(
    """select c_custkey, lower(c_mktsegment) as c_mktsegment,
      case when c_mktsegment = 'BUILDING' then upper(c_name) else c_name end as c_name
    from customer"""
)
def norm_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The condition sees the segment before it is lowered."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name")
    when = {"field": "c_mktsegment", "op": "eq", "value": "BUILDING"}
    rules = {"c_mktsegment": [{"op": "lower"}], "c_name": [{"op": "upper", "when": when}]}
    return cleaned(customers, rules)


@query(
    """select o_orderkey,
      case when o_orderstatus = 'F' then lpad(cast(o_custkey as varchar), 10, '0')
           else cast(o_custkey as varchar) end as customer
    from orders"""
)
def norm_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padding turns some rows of a number into text, so the whole column becomes text."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_custkey").alias("customer")
    )
    when = {"field": "o_orderstatus", "op": "eq", "value": "F"}
    padded = cleaned(orders, {"customer": [{"op": "lpad", "len": 10, "when": when}]})
    return padded.select("o_orderkey", "customer")


@query("select o_orderkey, lower(o_orderpriority) as o_orderpriority from orders")
def norm_when_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A condition that cannot be read leaves its operation running on every row."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    when = {"field": "o_orderkey", "op": "almost", "value": 1}
    return cleaned(orders, {"o_orderpriority": [{"op": "lower", "when": when}]})
