"""Words of ASCII letters and digits and of everything beyond ASCII, as numbers; and given rows in bounded blocks."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# In UTF-8 every byte of a character beyond ASCII is above 127, so words can be cut from bytes.
_CUT = bytes(ord(chr(b).lower()) if b > 127 or chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
# Bytes of a text that are cut into words at a time.
SPAN = 4 << 20
UNKNOWN = -1


def texts(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8; null as the empty text."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """The words in order, A-Z in lower case."""
    return text.translate(_CUT).split()


def numbers(text: bytes, known: Mapping[bytes, int]) -> np.ndarray:
    """The number of each word, UNKNOWN for other words. Long texts are cut span by span, so that only numbers pile up."""
    if len(text) <= SPAN:
        return _numbers(text.translate(_CUT), known)
    clean, parts, at = text.translate(_CUT), [], 0
    while at < len(clean):
        end = clean.find(b" ", at + SPAN)
        end = len(clean) if end < 0 else end
        parts.append(_numbers(clean[at:end], known))
        at = end
    return np.concatenate(parts)


def _numbers(clean: bytes, known: Mapping[bytes, int]) -> np.ndarray:
    found = clean.split()
    get = known.get
    return np.fromiter([get(word, UNKNOWN) for word in found], dtype=np.int32, count=len(found))


def blocks(rows: DataFrame, key: str, size: Column, limit: int) -> Iterator[list[Row]]:
    """All rows in blocks of about ``limit`` bytes, one block at a time on the driver. Rows of one key stay together.

    ``size`` is the bytes of a row. Blocks go by a hash of the key; where one comes out twice too large although it
    holds several keys, all are made smaller. So a block beyond the limit holds a single key.
    """
    total = rows.agg(F.sum(size)).first()[0] or 0
    count = max(1, math.ceil(total / limit))

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(count), F.col(key)), F.lit(count))

    def crowded(count: int) -> bool:
        per_key = rows.groupBy(block(count).alias("block"), key).agg(F.sum(size).alias("size"))
        held = per_key.groupBy("block").agg(F.sum("size").alias("size"), F.count("*").alias("keys"))
        return not held.where((F.col("size") > 2 * limit) & (F.col("keys") > 1)).isEmpty()

    while count > 1 and crowded(count):
        count *= 2
    for number in range(count):
        found = rows.where(block(count) == number).collect()
        if found:
            yield found
