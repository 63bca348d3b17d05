"""The nine clean-up operations, each ``Operand -> Operand``."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.errors import ContractError
from sluicegate.functions import patterns
from sluicegate.functions.casts import floor_to_millis, from_micros
from sluicegate.functions.operand import FLOATING, INTEGRAL, NUMERIC, TIMESTAMPS, Operand
from sluicegate.functions.text import as_text, digits, strip

Args = Mapping[str, Any]
TEXT = T.StringType()

# Default formats and time units of the date clean-ups.
DATE_FORMAT = "%Y-%m-%d"
DATETIME_FORMAT = "%Y-%m-%d %H:%M:%S"
UNIT_DIGITS = {"ms": 3, "us": 6, "ns": 9}


def text_arg(args: Args, name: str) -> str | None:
    """An argument as stripped text; blank counts as missing."""
    value = args.get(name)
    return None if value is None else str(value).strip() or None


def trim(x: Operand, args: Args) -> Operand:
    return Operand(strip(as_text(x)), TEXT)


def upper(x: Operand, args: Args) -> Operand:
    return Operand(F.upper(as_text(x)), TEXT)


def lower(x: Operand, args: Args) -> Operand:
    return Operand(F.lower(as_text(x)), TEXT)


def digits_only(x: Operand, args: Args) -> Operand:
    return Operand(digits(as_text(x)), TEXT)


def to_date(x: Operand, args: Args) -> Operand:
    return Operand(parse_date(as_text(x), text_arg(args, "format") or DATE_FORMAT), T.DateType())


def to_datetime(x: Operand, args: Args) -> Operand:
    unit = text_arg(args, "unit") or "ms"
    if unit not in UNIT_DIGITS:
        raise ContractError(f"to_datetime: unknown unit '{unit}'")
    parsed = parse_timestamp(as_text(x), text_arg(args, "format") or DATETIME_FORMAT)
    if unit == "ms":
        parsed = floor_to_millis(parsed)
    return Operand(parsed, T.TimestampNTZType(), UNIT_DIGITS[unit])


def coalesce(x: Operand, args: Args) -> Operand:
    value = args.get("value")
    if value is None:
        raise ContractError("coalesce: 'value' is missing")
    kind = _kind_with_literal(x, value)
    filled = as_text(x) if isinstance(kind, T.StringType) else x.col.cast(kind)
    literal = F.lit(value).cast(kind)
    return Operand(F.coalesce(filled, literal), kind, x.digits)


def replace(x: Operand, args: Args) -> Operand | None:
    old = text_arg(args, "old")
    if old is None:
        return None
    new = patterns.java_replacement(text_arg(args, "new") or "", old)
    return Operand(F.regexp_replace(as_text(x), patterns.java_regex(old), new), TEXT)


def lpad(x: Operand, args: Args) -> Operand | None:
    if args.get("len") is None:
        return None
    width = int(args["len"])
    text = as_text(x)
    fill = (text_arg(args, "char") or "0")[:1]
    # F.lpad cuts longer text; padding must not.
    return Operand(
        F.when(F.char_length(text) < width, F.lpad(text, width, fill)).otherwise(text), TEXT
    )


# Operation names.
OPERATIONS: dict[str, Callable[[Operand, Args], Operand | None]] = {
    "trim": trim,
    "upper": upper,
    "lower": lower,
    "to_date": to_date,
    "to_datetime": to_datetime,
    "coalesce": coalesce,
    "replace": replace,
    "digits_only": digits_only,
    "lpad": lpad,
}


def parse_date(text: Column, directives: str) -> Column:
    layout = patterns.number_layout(directives)
    if layout:
        return _iso_text(text, layout).try_cast("timestamp_ntz" if layout.has_time else "date").cast("date")
    return _this_century(F.try_to_date(text, patterns.java_date_format(directives)), directives)


def parse_timestamp(text: Column, directives: str) -> Column:
    """Parse to a zone-less time."""
    layout = patterns.number_layout(directives)
    if layout:
        return _iso_text(text, layout).try_cast("timestamp_ntz")
    # Read as UTC, so that no session zone can move it.
    java = patterns.java_date_format(directives) + " X"
    instant = F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit(java))
    return _this_century(from_micros(F.unix_micros(instant)), directives)


def _iso_text(text: Column, layout: patterns.NumberLayout) -> Column:
    """The date as ``2024-01-05[ 10:20[:30]]``, null where the text has another shape.

    A cast reads that form many times faster than a date parser reads a pattern, and a bad
    value costs it no exception.
    """

    def number(directive: str) -> Column:
        return F.substring(text, layout.starts[directive], patterns.NUMBER_WIDTHS[directive])

    if layout.is_iso:
        return F.when(text.rlike(layout.shape), text)
    pieces = [number("%Y"), F.lit("-"), number("%m"), F.lit("-"), number("%d")]
    if layout.has_time:
        pieces += [F.lit(" "), number("%H"), F.lit(":"), number("%M")]
    if "%S" in layout.starts:
        pieces += [F.lit(":"), number("%S")]
    return F.when(text.rlike(layout.shape), F.concat(*pieces))


def _this_century(parsed: Column, directives: str) -> Column:
    """Two-digit years 69 to 99 belong to the last century; Java reads them all as 20yy."""
    if not patterns.has_short_year(directives):
        return parsed
    return F.when(F.year(parsed) >= 2069, parsed - F.expr("interval 1200 months")).otherwise(parsed)


def choose(condition: Column, new: Operand, old: Operand) -> Operand:
    """``new`` where the condition holds, else ``old``, in a type both fit."""
    digits = max(new.digits, old.digits)
    if new.dtype == old.dtype:
        return Operand(F.when(condition, new.col).otherwise(old.col), new.dtype, digits)
    kind = _common_kind(new, old)
    if isinstance(kind, T.StringType):
        return Operand(F.when(condition, as_text(new)).otherwise(as_text(old)), kind)
    return Operand(
        F.when(condition, new.col.cast(kind)).otherwise(old.col.cast(kind)), kind, digits
    )


def _common_kind(a: Operand, b: Operand) -> T.DataType:
    if a.is_a(T.DateType, *TIMESTAMPS) and b.is_a(T.DateType, *TIMESTAMPS):
        return T.TimestampNTZType()
    if a.is_a(*INTEGRAL) and b.is_a(*INTEGRAL):
        return T.LongType()
    if a.is_a(*NUMERIC) and b.is_a(*NUMERIC):
        return T.DoubleType()
    return TEXT


def _kind_with_literal(x: Operand, value: Any) -> T.DataType:
    """Type of a column once its nulls are filled with a literal."""
    if isinstance(value, bool):
        return x.dtype if x.is_a(T.BooleanType) else TEXT
    if isinstance(value, int) and x.is_a(*INTEGRAL):
        return x.dtype if abs(value) <= 127 else T.LongType()
    if isinstance(value, int) and x.is_a(*FLOATING):
        return x.dtype
    if isinstance(value, float) and x.is_a(*NUMERIC):
        return T.DoubleType()
    if isinstance(value, int) and x.is_a(T.DecimalType):
        return T.DecimalType(38, x.dtype.scale)
    return TEXT
