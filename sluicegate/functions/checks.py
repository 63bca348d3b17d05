"""The checks. Each gives a column that is true where a value breaks the rule.

A check returns None when an argument it needs is missing: the rule is then declared
but never run. Nulls pass every check but ``required``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from datetime import date, datetime
from decimal import ROUND_CEILING, Decimal, localcontext
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions import patterns
from sluicegate.functions.casts import to_date, to_number
from sluicegate.functions.cleanups import parse_date, text_arg
from sluicegate.functions.operand import Operand, Scope
from sluicegate.functions.text import as_text, digits, strip, stripped

Args = Mapping[str, Any]

# Named date formats and the default one.
NAMED_DATE_FORMATS = {
    "yyyy-mm-dd": "%Y-%m-%d",
    "yyyy/mm/dd": "%Y/%m/%d",
    "dd/mm/yyyy": "%d/%m/%Y",
}
DEFAULT_DATE_FORMAT = "yyyy-mm-dd"

# The row check on document numbers, its columns and the length per type.
DOCUMENT_CHECK = "cpf_cnpj_by_tipo_credor"
DOCUMENT_TYPE_FIELD = "tipo_credor"
DOCUMENT_FIELD = "cpf_cnpj_credor"
DOCUMENT_LENGTHS = {1: 11, 2: 14}

# Below this every whole number is a double.
EXACT_IN_DOUBLES = 2**53


def required(x: Operand, args: Args) -> Column:
    missing = x.col.isNull()
    if x.is_a(T.StringType):
        return missing | (strip(x.col) == "")
    return missing


def minimum(x: Operand, args: Args) -> Column | None:
    return _compared(x, args, lambda number, limit: number < limit, math.ceil, from_=False)


def maximum(x: Operand, args: Args) -> Column | None:
    return _compared(x, args, lambda number, limit: number > limit, math.floor, above=True)


def greater_than(x: Operand, args: Args) -> Column | None:
    return _compared(x, args, lambda number, limit: number <= limit, math.floor, above=True, from_=False)


def max_length(x: Operand, args: Args) -> Column | None:
    if args.get("value") is None:
        return None
    return F.char_length(as_text(x)) > int(args["value"])


def regex(x: Operand, args: Args) -> Column | None:
    pattern = text_arg(args, "pattern")
    return None if pattern is None else ~as_text(x).rlike(patterns.java_regex(pattern))


def in_list(x: Operand, args: Args) -> Column | None:
    values = args.get("values")
    if not isinstance(values, list) or not values:
        return None
    return ~as_text(x).isin([str(v) for v in values])


def date_gte(x: Operand, args: Args) -> Column | None:
    limit = _day(args)
    return None if limit is None else to_date(x) < F.lit(limit)


def date_lte(x: Operand, args: Args) -> Column | None:
    limit = _day(args)
    return None if limit is None else to_date(x) > F.lit(limit)


def date_format(x: Operand, args: Args) -> Column:
    name = text_arg(args, "format") or DEFAULT_DATE_FORMAT
    text = stripped(x)
    return (text != "") & parse_date(text, NAMED_DATE_FORMATS.get(name.lower(), name)).isNull()


def decimal_scale(x: Operand, args: Args) -> Column | None:
    if args.get("scale") is None:
        return None
    scale = int(args["scale"])
    # A comma counts as a point. Blank text passes.
    fraction = rf"([.,]\d{{1,{scale}}})?" if scale > 0 else ""
    return ~stripped(x).rlike(patterns.JAVA_FLAGS + rf"^(-?\d+{fraction})?\z")


# Rule names.
FIELD_CHECKS: dict[str, Callable[[Operand, Args], Column | None]] = {
    "required": required,
    "notnull": required,
    "min": minimum,
    "max": maximum,
    "gt": greater_than,
    "ge": minimum,
    "max_length": max_length,
    "regex": regex,
    "in": in_list,
    "date_gte": date_gte,
    "date_lte": date_lte,
    "date_format": date_format,
    "decimal_scale": decimal_scale,
}


def document_by_type(args: Args, scope: Scope, asked_by: str) -> Column:
    """Digits in a document number against the length its type calls for."""
    kind = scope.get(text_arg(args, "tipo_field") or DOCUMENT_TYPE_FIELD, asked_by)
    number = scope.get(text_arg(args, "doc_field") or DOCUMENT_FIELD, asked_by)
    kind_code = to_number(kind, T.LongType())
    length = F.char_length(digits(F.coalesce(as_text(number), F.lit(""))))
    broken = [(kind_code == code) & (length != size) for code, size in DOCUMENT_LENGTHS.items()]
    return reduce(Column.__or__, broken)


def _compared(
    x: Operand,
    args: Args,
    broken: Callable[[Column, Column], Column],
    whole: Callable[[float], int],
    above: bool = False,
    from_: bool = True,
) -> Column | None:
    """Numbers are compared as doubles. Where that can be told from the number itself, it is, and the comparison
    reaches the scan: a bigint against the whole number that ``whole`` makes of a limit that doubles hold exactly, and
    a decimal against the least one that as a double is at the limit (``above``: above it), which it must be
    from (or else below) to break the rule."""
    if args.get("value") is None:
        return None
    limit = float(args["value"])
    if x.is_a(T.LongType) and abs(limit) < EXACT_IN_DOUBLES:
        return broken(x.col, F.lit(whole(limit)).cast("long"))
    if x.is_a(T.DecimalType) and math.isfinite(limit):
        bound = least_decimal(math.nextafter(limit, math.inf) if above else limit, x.dtype.scale)
        most = Decimal(10) ** (x.dtype.precision - x.dtype.scale)
        if not -most < bound < most:
            return x.col.isNotNull() if (bound < 0) == from_ else F.lit(False)
        literal = F.lit(str(bound)).cast(x.dtype)
        return x.col >= literal if from_ else x.col < literal
    return broken(to_number(x, T.DoubleType()), F.lit(limit))


def least_decimal(limit: float, scale: int) -> Decimal:
    """The least decimal of so many places that is at least ``limit`` when it is made a double, which rounds it to the
    nearest one: all from the middle between the limit and the double below, or the next place after it."""
    if math.isinf(limit):
        return Decimal(limit)
    with localcontext() as context:
        context.prec, step = 1200, Decimal(1).scaleb(-scale)
        middle = (Decimal(math.nextafter(limit, -math.inf)) + Decimal(limit)) / 2
        bound = middle.quantize(step, rounding=ROUND_CEILING)
        return bound if float(bound) >= limit else bound + step


def _day(args: Args) -> date | None:
    value = text_arg(args, "value")
    return None if value is None else datetime.fromisoformat(value).date()
