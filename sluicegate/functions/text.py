"""Text form of values, and whitespace handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.operand import TIMESTAMPS, Operand

# The code points with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The magnitudes written without an exponent, from (included) and to (excluded).
PLAIN_RANGE = {"float": (1e-6, 1e13), "double": (1e-5, 1e16)}
# A 32-bit float keeps any number of six digits but for the tiniest, below the least normal one; nine tell any two apart.
ALWAYS_KEPT, MOST_DIGITS, LEAST_NORMAL = 6, 9, 1.17549435e-38
# The magnitudes Java itself writes without an exponent.
JAVA_PLAIN_RANGE = (1e-3, 1e7)


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends.

    ``btrim`` with an explicit set stays linear in the text length, which an
    anchored regular expression does not.
    """
    return F.btrim(text, F.lit(WHITESPACE))


def stripped(x: Operand) -> Column:
    """Text without whitespace around it; only text can have any."""
    return strip(x.col) if x.is_a(T.StringType) else as_text(x)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def as_text(x: Operand) -> Column:
    if x.is_a(T.StringType):
        return x.col
    if x.is_a(T.FloatType, T.DoubleType):
        return _floating_text(x)
    if x.is_a(*TIMESTAMPS):
        return _timestamp_text(x)
    if x.is_a(T.BinaryType):
        return F.try_validate_utf8(x.col.cast("string"))
    return x.col.cast("string")


def _floating_text(x: Operand) -> Column:
    """Shortest decimal text: ``12345678.0`` and ``1e20``, not ``1.2345678E7`` and ``1.0E20``."""
    size = F.abs(x.col)
    raw = _shortest(x.col, size) if x.is_a(T.FloatType) else x.col.cast("string")
    # 17 significant digits at 1e-5 need 21 places; 16 whole digits still fit beside them.
    padded = raw.try_cast("decimal(38,21)").cast("string")
    plain = F.regexp_replace(padded, r"(?<=\.\d{1,20})0+\z", "")
    short = F.regexp_replace(F.regexp_replace(raw, r"(\.0)?E", "e"), "Infinity", "inf")

    def within(bounds: tuple[float, float]) -> Column:
        low, high = (F.lit(bound).cast(x.dtype) for bound in bounds)
        return (size >= low) & (size < high)

    by_cast = size == 0
    if not x.is_a(T.FloatType):
        by_cast |= within(JAVA_PLAIN_RANGE)
    return F.when(by_cast, raw).when(within(PLAIN_RANGE[x.dtype.simpleString()]), plain).otherwise(short)


def _shortest(value: Column, size: Column) -> Column:
    """A 32-bit float in the fewest digits that read back as the same float, such as ``1.5E-7``; zeros, infinities and
    what is no number as Java has them, which does not always find the fewest digits."""
    found = F.when(size < F.lit(LEAST_NORMAL).cast("float"), _read_back(value, 1)).otherwise(_read_back(value, ALWAYS_KEPT))
    bare = F.regexp_replace(F.regexp_replace(found, r"(?<=\d)\.?0*e", "E"), r"E\+?(-?)0*(?=\d)", "E$1")
    return F.when((size > 0) & (size < float("inf")), bare).otherwise(value.cast("string"))


def _read_back(value: Column, fewest: int) -> Column:
    """The value rounded to so many digits as it takes for the same float to be read back."""
    exact, found = value.cast("double"), []
    for digits in range(fewest, MOST_DIGITS + 1):
        # Java rounds up what lies in the middle of two candidates; the even one is wanted.
        rounded, finer = (F.format_string(f"%.{n}e", exact) for n in (digits - 1, digits))
        middle = (finer.cast("double") == exact) & finer.rlike(r"[02468]\.?5e")
        even = F.when(middle, F.regexp_replace(finer, r"\.?5e", "e"))
        found += [F.when(text.cast("float") == value, text) for text in (even, rounded)]
    return F.coalesce(*found)


def _timestamp_text(x: Operand) -> Column:
    """``2024-01-05 10:00:00.000``: always the same number of fraction digits.

    Built from the cast, because ``date_format`` moves a zone-less time through the
    session zone and shifts it in daylight-saving gaps.
    """
    raw = x.col.cast("timestamp_ntz").cast("string")
    fraction = F.regexp_extract(raw, r"\.(\d+)\z", 1)
    return F.concat(
        F.substring_index(raw, ".", 1), F.lit("."), F.rpad(fraction, x.digits, "0")
    )
