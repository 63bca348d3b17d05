"""A whole contract of 28 columns: orders dressed as spending commitments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.contract import Contract
from sluicegate.operators import report
from sluicegate.operators.check import ROW_INVALID, ROW_WARNING, CheckedFrame
from sluicegate.plans.load import LoadContext, check_prepared, prepare
from sluicegate.queries.base import query, table

# Runs unchanged in Spark SQL and DuckDB. Names do not matter, the order does.
COMMITMENTS = """
select
  case when o_orderkey % 17 = 0 then '31/02/1999' else concat(
    lpad(cast(day(o_orderdate) as string), 2, '0'), '/', lpad(cast(month(o_orderdate) as string), 2, '0'), '/',
    cast(year(o_orderdate) as string)) end as c01,
  case when o_orderkey % 501 = 0 then '  ' else concat(' NE', cast(o_orderkey as string), ' ') end as c02,
  case o_orderstatus when 'F' then '1' when 'O' then '2' else '9' end as c03,
  concat(' customer ', cast(o_custkey as string), ' ') as c04,
  case when o_orderkey % 5 = 0 then cast(o_custkey as string)
    when o_orderstatus = 'F' then concat(lpad(cast(o_custkey as string), 9, '0'), '-01')
    else concat(lpad(cast(o_custkey as string), 8, '0'), '/0001-01') end as c05,
  concat(cast(o_custkey as string), '-11') as c06,
  case when o_orderkey % 19 = 0 then '12' else lpad(cast(o_custkey as string), 7, '2') end as c07,
  concat(cast(o_custkey as string), '/0001-01') as c08,
  cast(o_custkey % 100 as string) as c09, 'unit ' as c10, cast(o_custkey % 10 as string) as c11, ' office' as c12,
  case when o_orderkey % 23 = 0 then 'pbx' else 'pb' end as c13,
  case when o_orderkey % 29 = 0 then 'other' else 'm' end as c14,
  'f' as c15, 'n' as c16, 's' as c17, ' detail ' as c18, 'r' as c19,
  case when o_orderkey % 2 = 0 then null else 'co' end as c20,
  'p' as c21, 'program ' as c22, 'a' as c23, ' action' as c24,
  concat(' ', o_orderpriority, ' of  ', o_orderstatus, ' ') as c25,
  case when o_orderkey % 31 = 0 then 'n/a' else cast(cast(o_totalprice as decimal(18,2)) as string) end as c26,
  cast(cast(o_totalprice as decimal(18,2)) - 1100 as string) as c27,
  cast(cast(o_totalprice as decimal(18,2)) as string) as c28,
  o_orderkey
from {orders}
"""

# The row check looks at tipo_credor and cpf_cnpj_credor unless told otherwise; the other names are free.
# fmt: off
COLUMNS = (
    "commit_date", "commit_no", "tipo_credor", "payee", "cpf_cnpj_credor", "officer_id", "town_code",
    "unit_tax_id", "unit_code", "unit_text", "office_code", "office_text", "state", "sphere",
    "function_code", "nature_code", "detail_code", "detail_text", "fund_code", "extra_code",
    "program_code", "program_text", "action_code", "action_text", "remarks", "committed", "settled",
    "paid",
)
# fmt: on
TYPES = {
    "commit_date": "date32",
    "tipo_credor": "int32",
    "committed": "decimal128(18,2)",
    "settled": "decimal128(18,2)",
    "paid": "decimal128(18,2)",
}
TRIM, UPPER, DIGITS = {"op": "trim"}, {"op": "upper"}, {"op": "digits_only"}
RULES = {
    "commit_date": {"normalize": [{"op": "to_date", "format": "%d/%m/%Y"}], "validate": [{"rule": "required"}]},
    "commit_no": {"normalize": [TRIM], "validate": [{"rule": "required"}]},
    "tipo_credor": {"validate": [{"rule": "in", "values": [1, 2, 3], "level": "warning"}]},
    "payee": {"normalize": [TRIM, UPPER]},
    "cpf_cnpj_credor": {"normalize": [DIGITS]},
    "officer_id": {"normalize": [DIGITS, {"op": "lpad", "len": 11}]},
    "town_code": {"validate": [{"rule": "regex", "pattern": r"^\d{7}$"}]},
    "unit_tax_id": {"normalize": [DIGITS, {"op": "lpad", "len": 14}]},
    "state": {"normalize": [UPPER], "validate": [{"rule": "max_length", "value": 2}]},
    "sphere": {"normalize": [UPPER], "validate": [{"rule": "in", "values": ["M", "E"], "level": "warning"}]},
    "extra_code": {"normalize": [{"op": "coalesce", "value": 0}]},
    "remarks": {"normalize": [TRIM, {"op": "replace", "old": r"\s+", "new": "_"}]},
    "committed": {"validate": [{"rule": "gt", "value": 0}, {"rule": "required", "level": "warning"}]},
    "settled": {"validate": [{"rule": "ge", "value": 0}]},
    "paid": {"validate": [{"rule": "ge", "value": 0}]},
    **{n: {"normalize": [TRIM]} for n in COLUMNS if n.endswith("_text")},
}
CONTRACT = Contract.from_dicts(
    "commitments",
    "v1",
    {"fields": [{"name": n, "type": TYPES.get(n, "string")} for n in (*COLUMNS, "o_orderkey")]},
    {
        "fields": RULES,
        "validations": [{"rule": "cpf_cnpj_by_tipo_credor"}],
        "partitioning": {
            "style": "hive",
            "fields": [{"name": n, "source": n, "from": "ctx"} for n in ("tc", "ano")],
        },
    },
)

IS_BROKEN = {
    "error:required:commit_date": "c01 = '31/02/1999'",
    "error:required:commit_no": "trim(c02) = ''",
    "warning:in:tipo_credor": "c03 = '9'",
    "error:regex:town_code": "not regexp_full_match(c07, '\\d{7}')",
    "error:max_length:state": "length(c13) > 2",
    "warning:in:sphere": "upper(c14) not in ('M', 'E')",
    "error:gt:committed": "coalesce(try_cast(c26 as decimal(18,2)) <= 0, false)",
    "warning:required:committed": "c26 = 'n/a'",
    "error:ge:settled": "cast(c27 as decimal(18,2)) < 0",
    "error:ge:paid": "cast(c28 as decimal(18,2)) < 0",
    "error:cpf_cnpj_by_tipo_credor:global": """(c03 = '1' and length(regexp_replace(c05, '[^0-9]', '', 'g')) <> 11)
      or (c03 = '2' and length(regexp_replace(c05, '[^0-9]', '', 'g')) <> 14)""",
}
WITH_COMMITMENTS = f"with commitments as ({COMMITMENTS.format(orders='orders')}) "
ANY_ERROR, ANY_WARNING = (
    " or ".join(f"({test})" for key, test in IS_BROKEN.items() if key.startswith(level)) for level in ("error", "warning")
)


def _checked(spark: SparkSession, sf_dir: str) -> CheckedFrame:
    source = spark.sql(COMMITMENTS, orders=table(spark, sf_dir, "orders"))
    prepared = prepare(source, CONTRACT, LoadContext.of(CONTRACT, 2024, "alpha"))
    return check_prepared(prepared, CONTRACT)


@query(
    WITH_COMMITMENTS
    + " union all ".join(
        f"select '{key}' as key, count(*) filter ({test}) as hits from commitments" for key, test in IS_BROKEN.items()
    )
)
def full_contract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of rule at once: clean-ups, casts, field checks and a row check."""
    return report.rule_counts(_checked(spark, sf_dir)).select("key", "hits")


@query(
    WITH_COMMITMENTS
    + f"""select o_orderkey,
      case when c01 <> '31/02/1999' then concat(c01[7:10], '-', c01[4:5], '-', c01[1:2]) end as commit_date,
      trim(c02) as commit_no, upper(trim(c04)) as payee,
      regexp_replace(c05, '[^0-9]', '', 'g') as cpf_cnpj_credor,
      lpad(regexp_replace(c06, '[^0-9]', '', 'g'), 11, '0') as officer_id,
      lpad(regexp_replace(c08, '[^0-9]', '', 'g'), 14, '0') as unit_tax_id,
      upper(c13) as state, coalesce(c20, '0') as extra_code,
      regexp_replace(trim(c25), '\\s+', '_', 'g') as remarks,
      case when c26 <> 'n/a' then c26 end as committed,
      concat_ws('|', trim(c10), trim(c12), trim(c18), trim(c22), trim(c24)) as descriptions,
      'alpha' as tc, 2024 as ano,
      case when {ANY_ERROR} then 'error' when {ANY_WARNING} then 'warning' else 'valid' end as status
    from commitments"""
)
def full_contract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col(ROW_INVALID), "error").when(F.col(ROW_WARNING), "warning").otherwise("valid")
    kept = """o_orderkey commit_no payee cpf_cnpj_credor officer_id unit_tax_id state
        extra_code remarks tc ano""".split()
    return _checked(spark, sf_dir).frame.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        *kept[1:],
        F.col("commit_date").cast("string").alias("commit_date"),
        F.col("committed").cast("string").alias("committed"),
        F.concat_ws("|", *[n for n in COLUMNS if n.endswith("_text")]).alias("descriptions"),
        status.alias("status"),
    )
