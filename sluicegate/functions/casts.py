"""Casts that turn a bad value into null: looser than ANSI, stricter than Spark's text parsing."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.operand import EPOCH, FLOATING, INTEGRAL, NUMERIC, TIMESTAMPS, Operand
from sluicegate.functions.text import as_text

# Type names a contract may use.
PLAIN_TOKENS: dict[str, T.DataType] = {
    "string": T.StringType(),
    "utf8": T.StringType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "date32": T.DateType(),
    "date": T.DateType(),
}
UNSIGNED_TOKENS: dict[str, tuple[T.DataType, int]] = {
    "uint8": (T.ShortType(), 8),
    "uint16": (T.IntegerType(), 16),
    "uint32": (T.LongType(), 32),
    "uint64": (T.DecimalType(20, 0), 64),
}
DECIMAL_TOKEN = re.compile(r"decimal128\((\d+),(\d+)\)")

INTEGER_TEXT = r"^[+-]?\d+\z"
DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
FLOAT_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\z"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}\z"
TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?\z"

# The years 1 to 9999 in days and milliseconds since the epoch: what date and time columns hold.
DAYS_RANGE = (-719_162, 2_932_896)
MILLIS_RANGE = (-62_135_596_800_000, 253_402_300_799_999)


@dataclass(frozen=True)
class Target:
    """A contract type: the Spark type plus the range check an unsigned type needs."""

    dtype: T.DataType
    unsigned_bits: int | None = None


def parse_token(token: Any) -> Target:
    """Contract type name to Spark type. Unknown names mean text, as does a missing one."""
    if isinstance(token, dict) and "type" in token:
        token = token["type"]
    if isinstance(token, str):
        name = token.strip().lower()
        if name in PLAIN_TOKENS:
            return Target(PLAIN_TOKENS[name])
        if name in UNSIGNED_TOKENS:
            return Target(*UNSIGNED_TOKENS[name])
        if name.startswith("timestamp"):
            return Target(T.TimestampNTZType())
        decimal = DECIMAL_TOKEN.fullmatch(name)
        if decimal:
            return Target(T.DecimalType(int(decimal[1]), int(decimal[2])))
    return Target(T.StringType())


def convert(x: Operand, target: Target) -> Operand:
    dtype = target.dtype
    if target.unsigned_bits is not None:
        return Operand(_unsigned(x, target.unsigned_bits).cast(dtype), dtype)
    if isinstance(dtype, T.StringType):
        return Operand(as_text(x), dtype)
    if isinstance(dtype, T.BooleanType):
        return Operand(_boolean(x), dtype)
    if isinstance(dtype, T.DateType):
        return Operand(to_date(x), dtype)
    if isinstance(dtype, TIMESTAMPS):
        return Operand(_timestamp_millis(x), dtype, 3)
    return Operand(to_number(x, dtype), dtype)


def to_number(x: Operand, dtype: T.DataType) -> Column:
    if x.is_a(T.StringType):
        return _guarded(x.col, _number_pattern(dtype)).try_cast(dtype)
    if x.is_a(T.DateType):
        return F.unix_date(x.col).try_cast(dtype)
    if x.is_a(*TIMESTAMPS):
        ticks = micros(x.col)
        return (F.floor(ticks / 1000) if x.digits == 3 else ticks).try_cast(dtype)
    if x.is_a(*NUMERIC, T.BooleanType):
        return x.col.try_cast(dtype)
    return to_number(Operand(as_text(x), T.StringType()), dtype)


def to_date(x: Operand) -> Column:
    if x.is_a(T.DateType):
        return x.col
    if x.is_a(*TIMESTAMPS):
        return x.col.cast("date")
    if x.is_a(*NUMERIC):
        days = to_number(x, T.IntegerType())
        return F.date_from_unix_date(F.when(days.between(*DAYS_RANGE), days))
    if x.is_a(T.BooleanType):
        return F.lit(None).cast("date")
    return _guarded(as_text(x), DATE_TEXT).try_cast("date")


def micros(timestamp: Column) -> Column:
    """Microseconds since the epoch of a zone-less time, untouched by the session zone."""
    return F.timestamp_diff("MICROSECOND", _epoch(), timestamp.cast("timestamp_ntz"))


def from_micros(ticks: Column) -> Column:
    return F.timestamp_add("MICROSECOND", ticks, _epoch())


def floor_to_millis(timestamp: Column) -> Column:
    return F.timestamp_add("MICROSECOND", -F.pmod(micros(timestamp), F.lit(1000)), timestamp)


def _epoch() -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz")


def _guarded(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), text)


def _number_pattern(dtype: T.DataType) -> str:
    if isinstance(dtype, INTEGRAL):
        return INTEGER_TEXT
    return FLOAT_TEXT if isinstance(dtype, FLOATING) else DECIMAL_TEXT


def _boolean(x: Operand) -> Column:
    if x.is_a(T.BooleanType):
        return x.col
    if x.is_a(*NUMERIC):
        return x.col != 0
    if x.is_a(T.StringType):
        word = F.lower(x.col)
        return F.when(word == "true", True).when(word == "false", False)
    return F.lit(None).cast("boolean")


def _timestamp_millis(x: Operand) -> Column:
    if x.is_a(T.DateType):
        return x.col.cast("timestamp_ntz")
    if x.is_a(*TIMESTAMPS):
        return floor_to_millis(x.col.cast("timestamp_ntz"))
    if x.is_a(*NUMERIC):
        millis = to_number(x, T.LongType())
        return from_micros(F.when(millis.between(*MILLIS_RANGE), millis * 1000))
    if x.is_a(T.BooleanType):
        return F.lit(None).cast("timestamp_ntz")
    return floor_to_millis(_guarded(as_text(x), TIMESTAMP_TEXT).try_cast("timestamp_ntz"))


def _unsigned(x: Operand, bits: int) -> Column:
    if x.is_a(T.StringType):
        x = Operand(_guarded(x.col, INTEGER_TEXT), T.StringType())
    wide = T.DecimalType(20, 0)
    # bigint first: it cuts fractions off, where a cast to decimal rounds them.
    value = F.coalesce(to_number(x, T.LongType()).cast(wide), to_number(x, wide))
    return F.when(value.between(F.lit(0).cast(wide), F.lit(str(2**bits - 1)).cast(wide)), value)
