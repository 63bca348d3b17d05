"""Best-fit packing into sequences of bounded length, in bulk-synchronous rounds.

Pieces of documents are range-sorted by length, so that each length is a run of neighbouring rows and every
row has a rank in its run. Lengths and gaps are whole numbers up to the capacity; pieces of one length, and
sequences with one gap, are interchangeable. A round therefore works on runs: the tasks count their own, and
at most ``partitions + capacity`` counts meet in the driver. A round takes the longest documents left, all of
one length at once, and sweeps them over the gaps from their length upward: each goes to its successor, the
smallest gap that holds it. Where more want a gap than there are, lower ranks win and the others go on to the
next larger gap, or open sequences where none is left. Gaps are then updated, and the next round begins. The
rounds give each run of ranks its sequences; the tasks place their own rows by rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluicegate.llm.rows import map_arrow, map_rows
from sluicegate.scratch import written

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)
_PLACED = [*PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]


@dataclass(frozen=True)
class Placement:
    """Pieces of one length, by rank: ``per`` in each sequence from ``sequence`` on, the first at ``offset``."""

    length: int
    first_rank: int
    count: int
    sequence: int
    per: int
    offset: int


class _Gaps:
    """Open sequences by the room they have: runs of neighbouring sequences, as first and count."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def put(self, size: int, first: int, count: int) -> None:
        if size and count:
            if size not in self.runs:
                insort(self.sizes, size)
            self.runs.setdefault(size, []).append((first, count))

    def successor(self, length: int) -> int | None:
        at = bisect_left(self.sizes, length)
        return self.sizes[at] if at < len(self.sizes) else None

    def take(self, size: int) -> tuple[int, int]:
        run = self.runs[size].pop()
        if not self.runs[size]:
            del self.runs[size], self.sizes[bisect_left(self.sizes, size)]
        return run


def plan(counts: Mapping[int, int], capacity: int) -> tuple[list[Placement], int]:
    """Placements for so many pieces of each length, and the number of sequences."""
    gaps, placed, sequences = _Gaps(), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            size = gaps.successor(length)
            if size is None:
                # As many new sequences as can be filled alike; the last few pieces open one more.
                size, first, count = capacity, sequences, max(1, left // (capacity // length))
                sequences += count
            else:
                first, count = gaps.take(size)
            # What is left of a gap that holds another piece of this length is the smallest that does.
            per = min(size // length, left)
            filled = min(count, left // per)
            placed.append(Placement(length, rank, filled * per, first, per, capacity - size))
            gaps.put(size, first + filled, count - filled)
            gaps.put(size - per * length, first, filled)
            rank, left = rank + filled * per, left - filled * per
    return placed, sequences


def _pieces(docs: DataFrame, encode: Callable[[], Callable[[str], bytes]], end_id: int, capacity: int) -> DataFrame:
    end = end_id.to_bytes(4, "little")

    def rule(keys: list, texts: list) -> Iterator[tuple]:
        to_ids = encode()
        for key, text in zip(keys, texts):
            ids = to_ids(text or "") + end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                own = ids[at : at + 4 * capacity]
                yield key, piece, at // 4, len(own) // 4, zlib.crc32(own)

    return map_rows(docs, ("doc_id", "text"), rule, PIECES)


def _ranked(pieces: DataFrame) -> DataFrame:
    """Pieces in ranges of length, each with its range and its place among that range's pieces of its length."""
    partitions = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("length", "doc_id", "piece", "ids_crc32")
    ranges = pieces.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    schema = T.StructType([*PIECES.fields, T.StructField("range", T.LongType()), T.StructField("nth", T.LongType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, length, seen = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = batch.column("length").to_numpy()
            turns = np.flatnonzero(np.diff(lengths, prepend=length))
            begins = np.zeros(len(lengths), dtype=np.int64)
            begins[turns] = turns
            begins = np.maximum.accumulate(begins)
            carried = seen if not len(turns) or turns[0] else 0
            nth = np.arange(len(lengths)) - begins
            if carried:
                nth[: turns[0] if len(turns) else len(nth)] += carried
            length, seen = int(lengths[-1]), int(nth[-1]) + 1
            extra = [pa.array(np.full(len(nth), here, dtype=np.int64)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=schema.names)

    return map_arrow(ranges.select(*PIECES.names), task, schema)


class _Lookup:
    """Placements by length and rank, as arrays: the plan as every task holds it."""

    def __init__(self, placed: list[Placement]):
        placed = sorted(placed, key=lambda p: (p.length, p.first_rank))
        columns = zip(*((p.first_rank, p.sequence, p.per, p.offset) for p in placed))
        self.rank, self.sequence, self.per, self.offset = (np.array(c, dtype=np.int64) for c in columns)
        lengths = [p.length for p in placed]
        self.span = {n: (bisect_left(lengths, n), bisect_left(lengths, n + 1)) for n in set(lengths)}

    def place(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.span[length]
        at = low + np.searchsorted(self.rank[low:high], ranks, side="right") - 1
        beyond = ranks - self.rank[at]
        return self.sequence[at] + beyond // self.per[at], self.offset[at] + beyond % self.per[at] * length


def pack_documents(
    docs: DataFrame, encode: Callable[[], Callable[[str], bytes]], end_id: int = 0, capacity: int = 2048
) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it.

    ``encode()`` gives a worker its encoder; ``end_id`` follows the ids of each document. Only documents
    longer than ``capacity`` are cut. A null text has the end id alone; null doc_ids stay null; repeated rows
    are packed each. The counts and the plan have a bound set by capacity and partitions, not by documents.
    """
    spark = docs.sparkSession
    ranked = written(_ranked(written(_pieces(docs, encode, end_id, capacity))))
    runs = ranked.groupBy("range", "length").count().collect()
    totals: dict[int, int] = defaultdict(int)
    base: dict[tuple[int, int], int] = {}
    for run in sorted(runs, key=lambda r: (r.length, r.range)):
        base[run.range, run.length] = totals[run.length]
        totals[run.length] += run["count"]
    placed, _ = plan(totals, capacity)
    shared = spark.sparkContext.broadcast((base, _Lookup(placed) if placed else None))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, lookup = shared.value
        for batch in batches:
            lengths, ranges = batch.column("length").to_numpy(), batch.column("range").to_numpy()
            ranks, size = batch.column("nth").to_numpy(), len(lengths)
            sequence, offset = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
            key = ranges * (capacity + 1) + lengths
            order = np.argsort(key, kind="stable")
            for mine in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
                if len(mine):
                    length = int(lengths[mine[0]])
                    own = ranks[mine] + first[int(ranges[mine[0]]), length]
                    sequence[mine], offset[mine] = lookup.place(length, own)
            columns = [*batch.columns[: len(PIECES)], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[field.name for field in _PLACED])

    return map_arrow(ranked, task, T.StructType(_PLACED))
