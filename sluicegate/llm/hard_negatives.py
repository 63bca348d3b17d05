"""Hard negatives by coordinate pruning within length buckets.

Rows are sorted by the length of their vector and cut into buckets of bounded size. A bucket holds its rows and, for
every coordinate, their order by the unit vector's value there. An anchor that wants scores of at least t needs rows
within an angle of its own direction, so on each of its focus coordinates (those with the largest values) the row must
lie in a range that follows from t, the anchor's value and the bucket's greatest length. The ranges are found by binary
search, the sets of rows in them are intersected, and only what is left is scored exactly. A bucket whose rows are too
short for t is passed over whole. What an anchor has found raises its t from bucket to bucket, so nothing is lost.

Anchors go in blocks of bounded size; each block meets all buckets once for its positives, and once more, with the
score windows that follow from them, for its negatives.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.rows import map_arrow, slices
from sluicegate.llm.words import blocks
from sluicegate.scratch import written

POSITIVES, NEGATIVES = 5, 10
# Hundredths of the positive's score that a negative's must have, at least and at most.
LOW, HIGH = 30, 90
# Rows and bytes of a bucket, the least ratio of its lengths, and bytes of the anchors that are broadcast together.
BUCKET_ROWS, BUCKET_BYTES, NARROW, BLOCK = 4096, 4 << 20, 0.9, 32 << 20
FOCUS = 4
# Room for the rounding of lengths and unit values.
SLACK = 1e-9
# Whole numbers in doubles are exact below.
EXACT = 2.0**53
LONG = (-(1 << 63), (1 << 63) - 1)


def feasible(value: float, cosine: float) -> tuple[float, float]:
    """The range of a coordinate among unit vectors whose cosine with a unit vector is at least ``cosine``, where that
    one has ``value`` there: those within an angle of a direction that itself is at an angle from the axis."""
    own, room = math.acos(min(1.0, max(-1.0, value))), math.acos(min(1.0, max(-1.0, cosine)))
    return math.cos(min(math.pi, own + room)) - SLACK, math.cos(max(0.0, own - room)) + SLACK


@dataclass(frozen=True)
class Anchor:
    row: int
    vec_id: int
    label: int
    length: float
    vector: np.ndarray
    focus: tuple[tuple[int, float], ...]  # coordinates with the largest unit values, and these

    @classmethod
    def of(cls, r: Row) -> Anchor:
        vector = np.frombuffer(bytes(r.vector))
        unit = vector / r.length if r.length > 0 else vector
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS].tolist()
        return cls(r.row, r.vec_id, r.label, r.length, vector, tuple((f, float(unit[f])) for f in focus))


class Bucket:
    """Rows of about one length and one number of coordinates, sorted on every coordinate of their unit vectors."""

    def __init__(self, row: dict):
        self.rows, self.ids, self.labels = (np.frombuffer(row[name], dtype=np.int64) for name in ("rows", "ids", "labels"))
        self.named = np.frombuffer(row["named"], dtype=bool)
        lengths = np.frombuffer(row["lengths"])
        self.longest, self.dim = float(lengths.max()), row["dim"]
        self.vectors = np.frombuffer(row["vectors"]).reshape(len(self.rows), self.dim)
        self.orders = np.frombuffer(row["orders"], dtype=np.uint16).reshape(self.dim, len(self.rows))
        self.values = np.take_along_axis(_units(self.vectors, lengths).T, self.orders.astype(np.int64), axis=1)

    def within(self, anchor: Anchor, least: int | None) -> np.ndarray:
        """The rows that can have a score of at least ``least`` with the anchor."""
        everything = np.arange(len(self.rows))
        if least is None or least <= 0:
            return everything
        reach = anchor.length * self.longest
        cosine = least / reach * (1 - SLACK) if reach > 0 else math.inf
        if cosine > 1:
            return everything[:0]
        ranges = []
        for f, value in anchor.focus:
            low, high = feasible(value, cosine)
            ranges.append((np.searchsorted(self.values[f], low), np.searchsorted(self.values[f], high, "right"), f))
        left = None
        for start, end, f in sorted(ranges, key=lambda r: r[1] - r[0]):
            if end - start < len(everything):
                inside = np.zeros(len(everything), dtype=bool)
                inside[self.orders[f, start:end]] = True
                left = inside if left is None else left & inside
        return everything if left is None else np.flatnonzero(left)

    def scores(self, anchor: Anchor, at: np.ndarray) -> np.ndarray:
        """Exact inner products, held within the range of a long."""
        vectors = self.vectors[at]
        if anchor.length * self.longest < EXACT:  # and so is every partial sum
            return (vectors @ anchor.vector).astype(np.int64)
        own = [int(x) for x in anchor.vector.tolist()]
        exact = (sum(int(x) * y for x, y in zip(row, own)) for row in vectors.tolist())
        return np.array([min(max(score, LONG[0]), LONG[1]) for score in exact], dtype=np.int64)


class Best:
    """At most ``top`` scores, highest first, then by ascending vec_id; rows without one come last."""

    def __init__(self, top: int):
        self.top = top
        self.kept: list[tuple[int, bool, int]] = []

    @property
    def floor(self) -> int | None:
        return -self.kept[-1][0] if len(self.kept) == self.top else None

    def offer(self, bucket: Bucket, at: np.ndarray, scores: np.ndarray) -> None:
        floor = self.floor
        if len(scores) > self.top:
            last = int(np.partition(scores, len(scores) - self.top)[len(scores) - self.top])
            floor = last if floor is None else max(floor, last)
        if floor is not None:
            high = scores >= floor
            at, scores = at[high], scores[high]
        if len(at):
            fresh = zip((-scores).tolist(), (~bucket.named[at]).tolist(), bucket.ids[at].tolist())
            self.kept = sorted([*self.kept, *fresh])[: self.top]

    def rows(self) -> Iterator[tuple[int | None, int]]:
        return ((None if unnamed else vec_id, -score) for score, unnamed, vec_id in self.kept)


class Hunt:
    """An anchor's search for negatives beside one positive: scores from ``low`` to ``high``, the best of them kept."""

    def __init__(self, place: int, vec_id: int | None, score: int, share: tuple[int, int], top: int):
        self.place, self.positive, self.score = place, vec_id, score
        self.low, self.high = -(-share[0] * score // 100), share[1] * score // 100
        self.best = Best(top)

    @property
    def least(self) -> int:
        return max(self.low, self.low if self.best.floor is None else self.best.floor)


def _units(vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return vectors / np.where(lengths > 0, lengths, 1.0)[:, None]


_PLACED = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("label", T.LongType()),
        T.StructField("anchor", T.BooleanType()),
        T.StructField("dim", T.IntegerType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("vector", T.BinaryType()),
    ]
)
_BUCKET = T.StructType(
    [
        T.StructField("dim", T.IntegerType()),
        *(T.StructField(name, T.BinaryType()) for name in ("rows", "ids", "named", "labels", "lengths", "vectors", "orders")),
    ]
)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of whole numbers, with their lengths."""
    for batch in batches:
        for piece in slices(batch):
            vectors = [np.floor(256 * np.array(v, dtype=np.float64)) for v in piece.column("vector").to_pylist()]
            columns = [
                *(piece.column(name) for name in ("vec_id", "label", "anchor")),
                pa.array([len(v) for v in vectors], pa.int32()),
                pa.array([math.sqrt(float(v @ v)) for v in vectors], pa.float64()),
                pa.array([v.tobytes() for v in vectors], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_PLACED.names)


def _bucket(rows: list[tuple]) -> tuple:
    number, ids, labels, dims, lengths, vectors = zip(*rows)
    matrix = np.frombuffer(b"".join(vectors)).reshape(len(rows), dims[0])
    lengths = np.array(lengths)
    return (
        dims[0],
        np.array(number, dtype=np.int64).tobytes(),
        np.array([i or 0 for i in ids], dtype=np.int64).tobytes(),
        np.array([i is not None for i in ids]).tobytes(),
        np.array(labels, dtype=np.int64).tobytes(),
        lengths.tobytes(),
        matrix.tobytes(),
        np.argsort(_units(matrix, lengths), axis=0, kind="stable").T.astype(np.uint16).tobytes(),
    )


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, cut into buckets."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([value]) for value in _bucket(rows)]
        return pa.RecordBatch.from_arrays([columns[0].cast(pa.int32()), *columns[1:]], names=_BUCKET.names)

    held: list[tuple] = []
    for given in batches:
        for piece in slices(given):
            for row in zip(*(piece.column(name).to_pylist() for name in ("row", "vec_id", "label", "dim", "length", "vector"))):
                if held and (
                    row[3] != held[0][3]
                    or row[4] < NARROW * held[0][4]
                    or len(held) >= min(BUCKET_ROWS, max(1, BUCKET_BYTES // max(8, 8 * row[3])))
                ):
                    yield batch(held)
                    held = []
                held.append(row)
    if held:
        yield batch(held)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    for batch in batches:
        for number in range(batch.num_rows):
            yield Bucket(batch.slice(number, 1).to_pylist()[0])


_FOUND = T.StructType(
    [T.StructField("row", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())]
)
_MINED = T.StructType(
    [
        *(T.StructField(name, T.LongType()) for name in ("row", "place", "anchor_id", "positive_id", "negative_id")),
        *(T.StructField(name, T.LongType()) for name in ("positive_score", "negative_score")),
    ]
)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(schema.names))], names=schema.names
    )


def _positives(anchors, count: int):
    """The best rows of each anchor's label among a task's buckets."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(anchor, Best(count)) for anchor in anchors.value]
        for bucket in _read(batches):
            for anchor, best in held:
                if bucket.dim == len(anchor.vector):
                    at = bucket.within(anchor, best.floor)
                    at = at[(bucket.labels[at] == anchor.label) & (bucket.rows[at] != anchor.row)]
                    best.offer(bucket, at, bucket.scores(anchor, at))
        yield _batch([(anchor.row, *found) for anchor, best in held for found in best.rows()], _FOUND)

    return task


def _negatives(anchors, positives, share: tuple[int, int], count: int):
    """The best rows of other labels within each score window, among a task's buckets."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for anchor in anchors.value:
            hunts = [Hunt(*found, share, count) for found in positives.value.get(anchor.row, ())]
            held.append((anchor, [hunt for hunt in hunts if hunt.low <= hunt.high]))
        for bucket in _read(batches):
            for anchor, hunts in held:
                if hunts and bucket.dim == len(anchor.vector):
                    at = bucket.within(anchor, min(hunt.least for hunt in hunts))
                    at = at[bucket.labels[at] != anchor.label]
                    scores = bucket.scores(anchor, at)
                    for hunt in hunts:
                        inside = (scores >= hunt.least) & (scores <= hunt.high)
                        hunt.best.offer(bucket, at[inside], scores[inside])
        rows = [
            (anchor.row, hunt.place, anchor.vec_id, hunt.positive, negative, hunt.score, score)
            for anchor, hunts in held
            for hunt in hunts
            for negative, score in hunt.best.rows()
        ]
        yield _batch(rows, _MINED)

    return task


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    share: tuple[int, int] = (LOW, HIGH),
) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding and label. A score is the inner product of floor(256 x), held within the range of a
    long. An anchor's positives are the ``positives`` best other rows of its label; a positive's negatives the ``negatives``
    best rows of other labels whose score is between the two hundredths of the positive's (``share``). Higher scores come
    first, then smaller vec_ids, rows without a vec_id last. Positives with a score below 0 have no negatives.

    Rows with a null label, a null vector, or a null or non-finite component (also after the factor 256) take no part.
    Rows are compared with rows of as many coordinates only. Every row counts for itself, also where vec_ids or whole
    rows repeat: another row with the anchor's vec_id is another row, and each anchor row has its own result.
    """
    spark = vectors.sparkSession
    vector = F.col("embedding").cast("array<double>").alias("vector")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(256 * x) < F.lit(float("inf"))))
    anchor = F.coalesce(is_anchor, F.lit(False)).alias("anchor")
    given = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), anchor, vector)
    given = given.where("label is not null and vector is not null").where(fine)
    rows = written(map_arrow(given, _whole, _PLACED).withColumn("row", F.monotonically_increasing_id()))
    order = (F.col("dim"), F.desc("length"), F.xxhash64("row"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = written(map_arrow(rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order), _buckets, _BUCKET))
    mined = spark.createDataFrame([], _MINED)
    # The positives of an anchor count as well; they come to the driver with their block.
    size = F.octet_length("vector").cast("long") + F.lit(64 * (1 + positives))
    for block in blocks(rows.where("anchor"), "row", size, BLOCK):
        anchors = spark.sparkContext.broadcast([Anchor.of(r) for r in block])
        best = _first(map_arrow(index, _positives(anchors, positives), _FOUND), ["row"], "score", "vec_id", positives)
        own: dict[int, list[tuple]] = {}
        for r in best.collect():
            own.setdefault(r.row, []).append((r["rank"], r.vec_id, r.score))
        windows = spark.sparkContext.broadcast(own)
        mined = mined.unionByName(map_arrow(index, _negatives(anchors, windows, share, negatives), _MINED))
    ranked = _first(mined, ["row", "place"], "negative_score", "negative_id", negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _first(found: DataFrame, keys: Sequence[str], score: str, vec_id: str, count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(vec_id))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
