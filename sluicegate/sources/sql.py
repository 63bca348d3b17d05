"""SQL extracts from the Spark catalog or a JDBC database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from sluicegate.errors import ContractError
from sluicegate.operators.schema import bytes_to_text, decimals_to_text

# Fixed value: the placeholder for the year of a load.
YEAR_PLACEHOLDER = "{{ano}}"
YEAR_PARAM = "ano"

DEFAULT_FETCH_SIZE = 10_000

Params = Mapping[str, Any] | Sequence[Any] | None


def read_sql_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def render_year(sql: str, params: Params) -> tuple[str, bool]:
    """Put the year into every placeholder. Tells whether there was one.

    The year is forced to an integer, so no text from outside reaches the statement.
    """
    pieces = sql.split(YEAR_PLACEHOLDER)
    if len(pieces) == 1:
        return sql, False
    try:
        year = int(_by_name(params)[YEAR_PARAM])
    except KeyError:
        raise ContractError(f"the SQL has {YEAR_PLACEHOLDER}, but no year was given") from None
    return str(year).join(pieces), True


def extract(spark: SparkSession, sql: str, params: Params = None) -> DataFrame:
    """Run one statement on catalog tables, with the year rendered or parameters bound."""
    text, rendered = render_year(sql, params)
    kind = dict if isinstance(params, Mapping) else list
    bound = {} if rendered or params is None else {"args": kind(params)}
    return spark.sql(_one_statement(text), **bound)


@dataclass(frozen=True)
class JdbcSplit:
    """How a JDBC read is divided: ranges of one column, bounds only set the stride."""

    column: str
    lower: Any
    upper: Any
    partitions: int


def jdbc_options(
    url: str,
    sql: str,
    params: Params = None,
    split: JdbcSplit | None = None,
    fetch_size: int = DEFAULT_FETCH_SIZE,
    single_task: bool = False,
    **extra: str,
) -> dict[str, str]:
    """Reader options for one extract. The statement runs in the database.

    A read without a split goes through one connection into one task; that must be asked for with
    ``single_task``. Times come without a zone, as the database shows them.
    """
    if split is None and not single_task:
        raise ContractError("a JDBC read needs a split, or single_task=True to fetch all rows in one task")
    text, rendered = render_year(sql, params)
    if params is not None and not rendered:
        raise ContractError(f"a JDBC read binds no parameters; use {YEAR_PLACEHOLDER} in the SQL")
    text = _one_statement(text)
    options = {"url": url, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true", **extra}
    if split is None:
        return {**options, "query": text}
    return {
        **options,
        "dbtable": f"({text}) extract",
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.partitions),
    }


def extract_jdbc(
    spark: SparkSession,
    url: str,
    sql: str,
    params: Params = None,
    decimals_as_text: bool = False,
    bytes_as_text: bool = False,
    **options: Any,
) -> DataFrame:
    """Rows of the statement; decimals and bytes as text where wanted, as ``operators.schema`` turns them."""
    rows = spark.read.format("jdbc").options(**jdbc_options(url, sql, params, **options)).load()
    rows = decimals_to_text(rows) if decimals_as_text else rows
    return bytes_to_text(rows) if bytes_as_text else rows


def _by_name(params: Params) -> dict[Any, Any]:
    """Parameters under their names; of those without names the first is the year."""
    if params is None or isinstance(params, (str, bytes)):
        return {}
    if isinstance(params, Mapping):
        return dict(params)
    return dict(zip((YEAR_PARAM, *range(1, len(params))), params))


def _one_statement(sql: str) -> str:
    return sql.strip().rstrip(";").rstrip()
