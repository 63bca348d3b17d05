"""Names, order and types of columns."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.errors import ContractError
from sluicegate.functions.casts import Target, convert, parse_token
from sluicegate.functions.operand import FLOATING, INTEGRAL, NUMERIC, TIMESTAMPS, Operand, Scope, column, operand
from sluicegate.functions.text import as_text
from sluicegate.names import folding, unused
from sluicegate.partitioning import PartitionSpec, ctx_value

log = logging.getLogger(__name__)

TEXT_TOKENS = ("string", "utf8")
# Columns whose marks share one whole number.
MARK_BITS = 62


def positional_rename(df: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Give the columns the contract's names, by position.

    Without names the columns stay as they are, and must then be unique.
    """
    actual = df.columns
    names = [n for n in (str(name).strip() for name in names or ()) if n]
    repeated = sorted({n for n in actual if actual.count(n) > 1})
    if not names:
        if repeated:
            raise ContractError(f"columns occur more than once and no names are given: {repeated}")
        return df
    if len(actual) != len(names):
        raise ContractError(
            f"the input has {len(actual)} columns, the contract {len(names)}\n"
            f"input: {_numbered(actual)}\ncontract: {_numbered(names)}"
        )
    if repeated:
        log.warning("columns occur more than once, renamed by position: %s", repeated)
    renamed = [f"{i}: {a} -> {n}" for i, (a, n) in enumerate(zip(actual, names), 1) if a != n]
    if renamed:
        log.warning("columns take their contract names: %s", ", ".join(renamed))
    return df.toDF(*names)


def add_context_columns(df: DataFrame, spec: PartitionSpec, ctx: Any) -> DataFrame:
    """Add the load's own values as columns, unless the data has them, in whatever case the session ignores."""
    fold = folding(df.sparkSession)
    own = {fold(name) for name in df.columns}
    missing = {f.source: F.lit(ctx_value(ctx, f)) for f in spec.ctx_fields if fold(f.source) not in own}
    return df.withColumns(missing) if missing else df


def enforce(df: DataFrame, fields: Sequence[Mapping[str, Any]], millis: Sequence[str] = ()) -> DataFrame:
    """Cast to the contract types (bad values become null) and put contract columns first."""
    return enforce_marked(df, fields, millis).frame


@dataclass(frozen=True)
class Enforced:
    """Cast rows. ``marked`` has beside them, as bits of whole numbers, which columns lost their value in the cast."""

    marked: DataFrame
    marks: tuple[str, ...] = ()
    lossy: tuple[str, ...] = ()  # columns whose cast can lose a value, one bit each

    @property
    def frame(self) -> DataFrame:
        return self.marked.drop(*self.marks) if self.marks else self.marked

    def losses(self) -> list[Column]:
        """Lost values per column, for one ``agg`` or ``observe`` over the marked rows."""
        bits = [(column(self.marks[n // MARK_BITS]), 1 << n % MARK_BITS) for n in range(len(self.lossy))]
        return [F.count_if(mark.bitwiseAND(F.lit(bit)) != 0).alias(f"lost_{n}") for n, (mark, bit) in enumerate(bits)]


def enforce_marked(df: DataFrame, fields: Sequence[Mapping[str, Any]], millis: Sequence[str] = ()) -> Enforced:
    """Cast to the contract types, and mark on every row the columns that held a value before and hold none after."""
    targets = {str(f["name"]).strip(): parse_token(f.get("type")) for f in fields}
    as_text_only = [f for f in fields if _is_text(f) and str(f.get("type")).strip().lower() not in TEXT_TOKENS]
    if as_text_only:
        log.warning("these types are not contract types, the columns are kept as text: %s", as_text_only)
    scope, own = Scope(df.schema, millis), df.columns
    cast: dict[str, Column] = {}
    lost: dict[str, Column] = {}
    for name in (n for n in targets if n in own):
        before = scope.get(name, "schema")
        cast[name] = convert(before, targets[name]).col
        if _can_lose(before.dtype, targets[name]):
            lost[name] = before.col.isNotNull() & cast[name].isNull()
    marks = {
        unused(f"__cast_lost_{start // MARK_BITS}__", own): _as_bits(list(lost.values())[start : start + MARK_BITS])
        for start in range(0, len(lost), MARK_BITS)
    }
    others = [column(n) for n in own if n not in targets]
    marked = df.select(*[c.alias(n) for n, c in cast.items()], *others, *[c.alias(n) for n, c in marks.items()])
    return Enforced(marked, tuple(marks), tuple(lost))


def cast_losses(df: DataFrame, fields: Sequence[Mapping[str, Any]], millis: Sequence[str] = ()) -> DataFrame:
    """Values that the cast to the contract types loses: field and rows_lost, for every column where that can happen."""
    done = enforce_marked(df, fields, millis)
    if not done.lossy:
        return df.sparkSession.createDataFrame([], "field string, rows_lost long")
    rows = [F.struct(F.lit(name).alias("field"), F.col(f"lost_{n}").alias("rows_lost")) for n, name in enumerate(done.lossy)]
    return done.marked.agg(*done.losses()).select(F.inline(F.array(*rows)))


def _as_bits(flags: Sequence[Column]) -> Column:
    none = F.lit(0).cast("long")
    bits = [F.when(flag, F.lit(1 << n).cast("long")).otherwise(none) for n, flag in enumerate(flags)]
    return reduce(Column.bitwiseOR, bits)


def _can_lose(source: T.DataType, target: Target) -> bool:
    if isinstance(target.dtype, T.StringType):
        return isinstance(source, T.BinaryType)
    return not isinstance(source, T.NullType) and (
        target.unsigned_bits is not None or not _keeps_every_value(source, target.dtype)
    )


def millis_fields(fields: Sequence[Mapping[str, Any]]) -> list[str]:
    """Contract columns that hold millisecond timestamps after the cast."""
    return [str(f["name"]).strip() for f in fields if isinstance(parse_token(f.get("type")).dtype, TIMESTAMPS)]


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames with the same column names, widening types where they differ."""
    names = frames[0].columns
    for other in frames[1:]:
        if other.columns != names:
            raise ContractError(f"cannot stack columns {other.columns} under {names}")
    kinds = [_widest([f.schema[i].dataType for f in frames]) for i in range(len(names))]

    def widened(df: DataFrame) -> DataFrame:
        own = [operand(f.name, f.dataType) for f in df.schema.fields]
        return df.select(*[_widen(x, kind).alias(n) for x, kind, n in zip(own, kinds, names)])

    return reduce(DataFrame.union, map(widened, frames))


def align_by_name(df: DataFrame, fields: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Reorder by name and fill absent columns with null.

    A column is cast only where every value survives; otherwise it keeps its own type
    and the contract cast decides later.
    """
    own = {f.name: f.dataType for f in df.schema.fields}
    chosen = []
    for field in fields:
        name, dtype = str(field["name"]).strip(), parse_token(field.get("type")).dtype
        if name not in own:
            chosen.append(F.lit(None).cast(dtype).alias(name))
            continue
        safe = _keeps_every_value(own[name], dtype)
        chosen.append((column(name).cast(dtype) if safe else column(name)).alias(name))
    return df.select(*chosen)


def decimals_to_text(df: DataFrame) -> DataFrame:
    texts = {
        f.name: column(f.name).cast("string")
        for f in df.schema.fields
        if isinstance(f.dataType, T.DecimalType)
    }
    return df.withColumns(texts) if texts else df


def bytes_to_text(df: DataFrame) -> DataFrame:
    """Decode every binary column: as UTF-8 where valid, else as Latin-1."""
    texts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.BinaryType):
            utf8 = column(f.name).cast("string")
            latin = F.decode(column(f.name), "ISO-8859-1")
            texts[f.name] = F.when(F.is_valid_utf8(utf8), utf8).otherwise(latin)
    return df.withColumns(texts) if texts else df


def _is_text(field: Mapping[str, Any]) -> bool:
    return isinstance(parse_token(field.get("type")).dtype, T.StringType)


def _numbered(names: Sequence[str]) -> str:
    return ", ".join(f"{i}. {n}" for i, n in enumerate(names, 1))


def _widest(kinds: Sequence[T.DataType]) -> T.DataType:
    return reduce(_wider, kinds)


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, INTEGRAL) and isinstance(b, INTEGRAL):
        return max(a, b, key=lambda t: INTEGRAL.index(type(t)))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(min(38, whole + scale), scale)
    if isinstance(a, NUMERIC) and isinstance(b, NUMERIC):
        for one, other in ((a, b), (b, a)):
            if isinstance(one, T.DecimalType) and isinstance(other, INTEGRAL):
                return T.DecimalType(38, one.scale)
        return T.DoubleType()
    dated = (T.DateType, *TIMESTAMPS)
    if isinstance(a, dated) and isinstance(b, dated):
        return T.TimestampNTZType()
    return T.StringType()


def _widen(x: Operand, kind: T.DataType):
    if x.dtype == kind:
        return x.col
    return as_text(x) if isinstance(kind, T.StringType) else x.col.cast(kind)


def _keeps_every_value(source: T.DataType, target: T.DataType) -> bool:
    if source == target:
        return True
    if isinstance(source, INTEGRAL):
        if isinstance(target, INTEGRAL):
            return INTEGRAL.index(type(source)) <= INTEGRAL.index(type(target))
        if isinstance(target, T.DecimalType):
            return target.precision - target.scale >= 19
        return isinstance(target, T.DoubleType) and not isinstance(source, T.LongType)
    if isinstance(source, T.DecimalType) and isinstance(target, T.DecimalType):
        whole = target.precision - target.scale >= source.precision - source.scale
        return whole and target.scale >= source.scale
    return (isinstance(source, T.FloatType) and isinstance(target, FLOATING)) or (
        isinstance(source, T.DateType) and isinstance(target, T.TimestampNTZType)
    )
