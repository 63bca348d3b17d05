"""Conditions under which a rule applies."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.errors import ContractError
from sluicegate.functions.casts import Target, convert
from sluicegate.functions.operand import Operand, Scope

# Condition operators.
OPERATORS = ("eq", "ne", "in", "nin", "isnull", "notnull")


def is_usable(when: Mapping[str, Any] | None) -> bool:
    """False for a condition that cannot be read; its rule then applies to every row."""
    return bool(when) and bool(when.get("field")) and _operator(when) in OPERATORS


def condition(when: Mapping[str, Any] | None, scope: Scope, asked_by: str) -> Column | None:
    if not is_usable(when):
        return None
    operand = scope.get(when["field"], f"{asked_by} (when)")
    operator, value = _operator(when), when.get("value")
    if operator == "isnull":
        return operand.col.isNull()
    if operator == "notnull":
        return operand.col.isNotNull()
    if operator in ("eq", "ne"):
        left = _as_kind_of(operand, value)
        if value is None:
            return F.lit(None).cast("boolean")
        return left == F.lit(value) if operator == "eq" else left != F.lit(value)
    values = [v for v in (value if isinstance(value, list) else [value]) if v is not None]
    if len({isinstance(v, str) for v in values}) > 1:
        raise ContractError(f"{asked_by} (when): the list mixes text and numbers: {values}")
    listed = _as_kind_of(operand, values[0] if values else None).isin(values)
    return listed if operator == "in" else ~listed


def _operator(when: Mapping[str, Any]) -> str:
    return str(when.get("op") or "").lower()


def _as_kind_of(operand: Operand, value: Any) -> Column:
    """Read the column as the type of the literal it is compared with."""
    if value is None:
        return operand.col
    if isinstance(value, bool):
        kind: T.DataType = T.BooleanType()
    elif isinstance(value, int):
        kind = T.LongType()
    elif isinstance(value, float):
        kind = T.DoubleType()
    else:
        kind = T.StringType()
    return convert(operand, Target(kind)).col
