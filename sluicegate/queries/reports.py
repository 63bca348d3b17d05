"""Flags, splits, counts and samples over the two-level contract of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.contract import Contract
from sluicegate.operators import report
from sluicegate.operators.check import ROW_INVALID, ROW_WARNING, CheckedFrame
from sluicegate.plans.load import LoadContext, check_prepared, prepare
from sluicegate.queries.base import checked, orders_contract, query, table

IS_ERROR = "o_totalprice > 450000"
IS_WARNED = "o_orderstatus not in ('F', 'O')"
ROWS = "select o_orderkey, o_orderpriority, o_totalprice from orders where "
COUNTS = f"""count(*) as rows_total, count(*) filter (not ({IS_ERROR})) as rows_valid,
      count(*) filter ({IS_ERROR}) as rows_invalid,
      count(*) filter ({IS_WARNED} and not ({IS_ERROR})) as rows_warning"""


def _two_levels(spark: SparkSession, sf_dir: str, contract: Contract | None = None) -> CheckedFrame:
    contract = contract or orders_contract()
    ctx = LoadContext.of(contract, 2024, "alpha")
    return check_prepared(prepare(table(spark, sf_dir, "orders"), contract, ctx), contract)


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select("o_orderkey", "o_orderpriority", "o_totalprice")


@query(
    f"""select o_orderkey, {IS_ERROR} as error_max_o_totalprice_1, {IS_WARNED} as warning_in_o_orderstatus_2
    from orders"""
)
def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _two_levels(spark, sf_dir)
    return result.flags.select("o_orderkey", *[c.flag for c in result.checks])


@query(f"select o_orderkey, {IS_ERROR} as invalid, {IS_WARNED} and not ({IS_ERROR}) as warning from orders")
def row_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = _two_levels(spark, sf_dir).frame
    return frame.select("o_orderkey", F.col(ROW_INVALID).alias("invalid"), F.col(ROW_WARNING).alias("warning"))


@query(ROWS + f"not ({IS_ERROR})")
def split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_two_levels(spark, sf_dir).valid)


@query(ROWS + IS_ERROR)
def split_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_two_levels(spark, sf_dir).invalid)


@query(ROWS + f"{IS_WARNED} and not ({IS_ERROR})")
def split_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_two_levels(spark, sf_dir).warning)


@query(f"select {COUNTS} from orders")
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.load_summary(_two_levels(spark, sf_dir))


@query(
    f"""select 'error:max:o_totalprice' as key, 'error' as level, 'max' as rule, 'o_totalprice' as field,
      count(*) filter ({IS_ERROR}) as hits from orders
    union all select 'warning:in:o_orderstatus', 'warning', 'in', 'o_orderstatus',
      count(*) filter ({IS_WARNED}) from orders"""
)
def rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.rule_counts(_two_levels(spark, sf_dir))


@query(
    """select key, sum(hits)::bigint as hits from (
      select 'error:min:c_acctbal' as key, count(*) filter (c_acctbal < 0) as hits from customer
      union all select 'error:min:c_acctbal', count(*) filter (c_acctbal < 1000) from customer
      union all select 'error:required:c_name', 0) group by key"""
)
def rule_counts_shared_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two limits on one column share a key; their hits add up."""
    limits = [{"rule": "min", "value": 0}, {"rule": "min", "value": 1000}]
    rules = {"c_acctbal": limits, "c_name": [{"rule": "required"}]}
    return report.rule_counts(checked(table(spark, sf_dir, "customer"), rules)).select("key", "hits")


@query(
    """select 'error_min_c_acctbal_1' as flag, count(*) filter (c_acctbal < 0) as hits from customer
    union all select 'error_min_c_acctbal_2', count(*) filter (c_acctbal < 1000) from customer"""
)
def rule_counts_per_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = [{"rule": "min", "value": 0}, {"rule": "min", "value": 1000}]
    return report.alias_counts(checked(table(spark, sf_dir, "customer"), {"c_acctbal": limits})).select("flag", "hits")


@query(
    f"""select * from (
      select 'error:max:o_totalprice' as key, count(*) filter ({IS_ERROR}) as hits from orders
      union all select 'warning:in:o_orderstatus', count(*) filter ({IS_WARNED}) from orders) where hits > 0"""
)
def rules_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.rules_summary(_two_levels(spark, sf_dir))


@query(
    f"""select o_orderkey, row_number() over (order by o_orderkey) as sample_seq,
      'error|max|o_totalprice|error:max:o_totalprice|Valor acima do máximo permitido (450000)' as issues
    from orders where {IS_ERROR} order by o_orderkey limit 100"""
)
def invalid_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_issue_text(report.invalid_samples(_two_levels(spark, sf_dir), order_by=["o_orderkey"]))


@query(
    f"""select o_orderkey, row_number() over (order by o_orderkey) as sample_seq,
      'warning|in|o_orderstatus|warning:in:o_orderstatus|Valor fora do conjunto permitido' as issues
    from orders where {IS_WARNED} and not ({IS_ERROR}) order by o_orderkey limit 100"""
)
def warning_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_issue_text(report.warning_samples(_two_levels(spark, sf_dir), order_by=["o_orderkey"]))


def _with_issue_text(samples: DataFrame) -> DataFrame:
    texts = F.transform(
        "__issues__", lambda i: F.concat_ws("|", i["level"], i["rule"], i["field"], i["key"], i["message"])
    )
    seq = F.col("__sample_seq__").cast("bigint").alias("sample_seq")
    return samples.select("o_orderkey", seq, F.array_join(texts, ";").alias("issues"))


@query(
    f"""select {COUNTS}, 'completed_with_invalid_rows_not_published' as status,
      count(*) filter ({IS_ERROR}) >= 100 as invalid_samples_truncated,
      count(*) filter ({IS_WARNED} and not ({IS_ERROR})) >= 100 as warning_samples_truncated
    from orders"""
)
def load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.load_status(_two_levels(spark, sf_dir))


WIDE_LINES = {
    "l_orderkey": [{"rule": "required"}],
    "l_quantity": [{"rule": "gt", "value": 0}, {"rule": "max", "value": 49}],
    "l_extendedprice": [{"rule": "decimal_scale", "scale": 1, "level": "warning"}],
    "l_discount": [{"rule": "ge", "value": 0}, {"rule": "max", "value": 0.09, "level": "warning"}],
    "l_tax": [{"rule": "max", "value": 0.07, "when": {"field": "l_discount", "op": "eq", "value": 0.0}}],
    "l_returnflag": [{"rule": "in", "values": ["A", "N", "R"]}, {"rule": "max_length", "value": 1}],
    "l_linestatus": [{"rule": "regex", "pattern": "^[FO]$"}],
    "l_shipdate": [{"rule": "date_gte", "value": "1995-06-01"}, {"rule": "date_lte", "value": "2001-06-01"}],
}


@query(
    """select key, hits from (select
      count(*) filter (l_orderkey is null) as "error:required:l_orderkey",
      count(*) filter (l_quantity <= 0) as "error:gt:l_quantity",
      count(*) filter (l_quantity > 49) as "error:max:l_quantity",
      count(*) filter (not regexp_matches(cast(l_extendedprice as varchar), '^-?\\d+(\\.\\d{1,1})?$'))
        as "warning:decimal_scale:l_extendedprice",
      count(*) filter (l_discount < 0) as "error:ge:l_discount",
      count(*) filter (l_discount > 0.09::double) as "warning:max:l_discount",
      count(*) filter (l_discount = 0 and l_tax > 0.07::double) as "error:max:l_tax",
      count(*) filter (l_returnflag not in ('A', 'N', 'R')) as "error:in:l_returnflag",
      count(*) filter (length(l_returnflag) > 1) as "error:max_length:l_returnflag",
      count(*) filter (l_linestatus not in ('F', 'O')) as "error:regex:l_linestatus",
      count(*) filter (l_shipdate < date '1995-06-01') as "error:date_gte:l_shipdate",
      count(*) filter (cast(l_shipdate as date) > date '2001-06-01') as "error:date_lte:l_shipdate"
      from lineitem) unpivot (hits for key in (columns(*)))"""
)
def rule_counts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve checks over the largest table in one scan and one aggregate."""
    return report.rule_counts(checked(table(spark, sf_dir, "lineitem"), WIDE_LINES)).select("key", "hits")


DOCUMENTS = Contract.from_dicts(
    "documents",
    "v1",
    {
        "fields": [
            {"name": "doc_id", "type": "int64"},
            {"name": "text", "type": "string"},
            {"name": "lang", "type": "string"},
            {"name": "source", "type": "string"},
            {"name": "n_chars", "type": "uint32"},
        ]
    },
    {
        "fields": {
            "text": {
                "normalize": [{"op": "trim"}, {"op": "replace", "old": r"[ \t]+", "new": "$0"}],
                "validate": [
                    {"rule": "required"},
                    {"rule": "max_length", "value": 20000},
                    {"rule": "regex", "pattern": "(?i)[.!?]", "level": "warning"},
                ],
            },
            "lang": {"validate": [{"rule": "in", "values": ["en", "fr", "de"], "level": "warning"}]},
            "n_chars": {
                "validate": [{"rule": "min", "value": 20, "when": {"field": "lang", "op": "eq", "value": "en"}}]
            },
        },
        "partitioning": {"style": "hive", "fields": [{"name": "tc", "source": "tc", "from": "ctx"}]},
    },
)
DOCUMENT_ERROR = "(length(text) > 20000 or (n_chars < 20 and lang = 'en'))"
DOCUMENT_WARNING = "(not regexp_matches(text, '[.!?]') or lang not in ('en', 'fr', 'de'))"


@query(
    f"""select lang, count(*) as rows_total, count(*) filter ({DOCUMENT_ERROR}) as rows_invalid,
      count(*) filter ({DOCUMENT_WARNING} and not {DOCUMENT_ERROR}) as rows_warning
    from documents group by lang"""
)
def row_status_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through clean-up, cast and checks, counted per language."""
    ctx = LoadContext.of(DOCUMENTS, 2024, "alpha")
    result = check_prepared(prepare(table(spark, sf_dir, "documents"), DOCUMENTS, ctx), DOCUMENTS)
    counts = [c for c, n in zip(report.row_counts(), ("rows_total", "", "rows_invalid", "rows_warning")) if n]
    return result.frame.groupBy("lang").agg(*counts)


@query(
    """select key, hits from (select
      count(*) filter (trim(url) = '') as "error:required:url",
      count(*) filter (not regexp_matches(url, '^https?://[a-z0-9.-]+/[a-z]{2}/[0-9]+')) as "error:regex:url",
      count(*) filter (length(html) > 20000) as "warning:max_length:html",
      count(*) filter (not regexp_matches(html, '(?s)<html lang="(en|fr|de)".*</html>\\s*$'))
        as "warning:regex:html"
      from pages) unpivot (hits for key in (columns(*)))"""
)
def rule_counts_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns over whole web pages."""
    rules = {
        "url": [{"rule": "required"}, {"rule": "regex", "pattern": "^https?://[a-z0-9.-]+/[a-z]{2}/[0-9]+"}],
        "html": [
            {"rule": "max_length", "value": 20000, "level": "warning"},
            {"rule": "regex", "pattern": r'(?s)<html lang="(en|fr|de)".*</html>\s*$', "level": "warning"},
        ],
    }
    return report.rule_counts(checked(table(spark, sf_dir, "pages"), rules)).select("key", "hits")
