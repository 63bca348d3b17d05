"""A column together with what the builders must know about it."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.errors import ContractError

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
NUMERIC = (*INTEGRAL, *FLOATING, T.DecimalType)
EPOCH = "1970-01-01 00:00:00"
TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def column(name: str) -> Column:
    """Reference a column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class Operand:
    col: Column
    dtype: T.DataType
    # Fraction digits a timestamp shows as text: 3 after the contract cast, 6 before.
    digits: int = 6

    def is_a(self, *kinds: type) -> bool:
        return isinstance(self.dtype, kinds)


def operand(name: str, dtype: T.DataType, digits: int = 6) -> Operand:
    """A column of the data. A time with a zone becomes the clock time in UTC, whatever the session's zone."""
    if isinstance(dtype, T.TimestampType):
        utc = F.timestamp_add("MICROSECOND", F.unix_micros(column(name)), F.lit(EPOCH).cast("timestamp_ntz"))
        return Operand(utc, T.TimestampNTZType(), digits)
    return Operand(column(name), dtype, digits)


class Scope:
    """The columns that rules may refer to, as operands."""

    def __init__(self, schema: T.StructType, millis: Iterable[str] = ()):
        self._types = {f.name: f.dataType for f in schema.fields}
        self._millis = frozenset(millis)

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(self._types)

    def __contains__(self, name: str) -> bool:
        return name in self._types

    def get(self, name: str, asked_by: str) -> Operand:
        if name not in self._types:
            raise ContractError(f"{asked_by}: column '{name}' is not in the data")
        return operand(name, self._types[name], 3 if name in self._millis else 6)
