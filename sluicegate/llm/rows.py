"""What the operators share: batches of plain Python rows, and encodings remembered per chunk of text."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import sluicegate

# Rows that are turned into Python objects at a time; their texts bound the memory of a task.
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20
_ARROW = {
    T.LongType(): pa.int64(),
    T.IntegerType(): pa.int32(),
    T.StringType(): pa.string(),
    T.BinaryType(): pa.binary(),
    T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(),
}


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most BATCH_ROWS rows and about BATCH_BYTES bytes."""
    rows = max(1, min(BATCH_ROWS, BATCH_BYTES * batch.num_rows // max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, also when it was not installed.

    On a cluster that lacks that folder, ship the package with ``--py-files`` as usual.
    """
    root = str(Path(sluicegate.__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))


def map_arrow(df: DataFrame, task: Callable, schema: T.StructType | str) -> DataFrame:
    prepare_workers(df.sparkSession)
    return df.mapInArrow(task, schema)


def map_rows(df: DataFrame, names: Sequence[str], rule: Callable[..., Iterable[tuple]], schema: T.StructType) -> DataFrame:
    """Apply ``rule(*columns)`` to lists of the named columns, and make rows of the tuples it gives."""
    kinds = [_ARROW[field.dataType] for field in schema.fields]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                made = list(rule(*(column.to_pylist() for column in piece.columns)))
                if made:
                    columns = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(df.select(*names), task, schema)


def map_batches(df: DataFrame, change: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """Change or drop rows without changing the columns, a bounded batch at a time."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield change(piece)

    return map_arrow(df, task, df.schema)


_MEMO: dict[Any, Any] = {}


def memo(key: Any, make: Callable[[], Any]) -> Any:
    """What tasks of one kind share in a worker process. Only the latest kind is kept, so that the stages of a
    pipeline don't pile up in the memory of their workers."""
    if key not in _MEMO:
        _MEMO.clear()
        _MEMO[key] = make()
    return _MEMO[key]


class ChunkCache(dict):
    """What ``encode`` gives for a chunk of text or bytes, made when first asked for.

    Holds at most ``limit`` chunks and starts anew beyond that, so that its memory is bounded whatever
    the corpus. Long chunks are not kept.
    """

    LONGEST = 64

    def __init__(self, encode: Callable[[Any], Any], limit: int = 1 << 19):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, chunk: Any) -> Any:
        ids = self.encode(chunk)
        if len(chunk) <= self.LONGEST:
            if len(self) >= self.limit:
                self.clear()
            self[chunk] = ids
        return ids
