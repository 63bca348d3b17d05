"""Nearest neighbours by an inverted multi-index.

Vectors are cut in two halves, each quantised by centroids of its own; a pair of centroids is a cell. A query
visits cells in the order of the summed nearness of their two centroids, taken from a heap, until the cells
hold enough entries; the entries are then ranked by their exact inner product. How many entries are enough is
calibrated on the sample that the centroids come from: the share of all rows at which the true neighbours of
sampled queries are found. Every row is in the index; only centroids and the share come from the sample. Rows of
another number of coordinates have an index of their own.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from sluicegate.llm.rows import map_arrow, slices
from sluicegate.scratch import written

# Centroids of a half: as many as this times the root of the rows, within limits, so that cells stay small.
CENTROIDS_OF_ROOT, LEAST_CENTROIDS, MOST_CENTROIDS = 0.2, 16, 256
# Vectors that centroids and share are fitted on: at most about so many, of so many bytes; and queries among them.
SAMPLE, SAMPLE_BYTES, CALIBRATION = 20_000, 64 << 20, 200
TOP = 20
# The share of entries that a query visits finds so much of its neighbours; a few times TOP entries are the least.
TARGET_RECALL, LEAST_ENTRIES = 0.94, 4 * TOP
# Entries of one share of the index: of first centroids with few entries, together, or of one with more.
CHUNK = 4096


@dataclass(frozen=True)
class Codebooks:
    first: np.ndarray
    second: np.ndarray
    share: float

    @property
    def cut(self) -> int:
        return self.first.shape[1]

    def nearness(self, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.first @ vector[: self.cut], self.second @ vector[self.cut :]


def _centroids(rows: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's rounds from rows spread over the sample; a centroid without rows stays."""
    if not rows.shape[1]:
        return np.zeros((1, 0))
    distinct = np.unique(rows, axis=0)
    centres = distinct[np.linspace(0, len(distinct) - 1, min(count, len(distinct))).astype(int)].copy()
    for _ in range(rounds):
        nearest = _nearest(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        held = np.bincount(nearest, minlength=len(centres))
        centres[held > 0] = sums[held > 0] / held[held > 0, None]
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * rows @ centres.T).argmin(1)


def visited(one: np.ndarray, other: np.ndarray, counts: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """Filled cells in descending order of summed nearness, until they hold ``wanted`` entries.

    The heap holds the border of what was visited: a pair enters once the pairs before it in both orders are out.
    """
    rows, columns = np.argsort(-one, kind="stable"), np.argsort(-other, kind="stable")
    near_one, near_other = one[rows].tolist(), other[columns].tolist()
    filled, rows, columns = counts[rows][:, columns].tolist(), rows.tolist(), columns.tolist()
    heap, out, held = [(-(near_one[0] + near_other[0]), 0, 0)], [], 0
    out_of = [0] * len(near_one)  # by row of the grid: how many of its pairs are out
    while heap and held < wanted:
        _, r, c = heapq.heappop(heap)
        if filled[r][c]:
            out.append((rows[r], columns[c]))
            held += filled[r][c]
        out_of[r] = c + 1
        # The pair to the right waits for the one above it to be out, the pair below for the one to its left.
        if c + 1 < len(near_other) and (r == 0 or out_of[r - 1] > c + 1):
            heapq.heappush(heap, (-(near_one[r] + near_other[c + 1]), r, c + 1))
        if r + 1 < len(near_one) and out_of[r + 1] == c:
            heapq.heappush(heap, (-(near_one[r + 1] + near_other[c]), r + 1, c))
    return out


def centroids_for(rows: int) -> int:
    return min(MOST_CENTROIDS, max(LEAST_CENTROIDS, round(CENTROIDS_OF_ROOT * math.sqrt(rows))))


def single_cell(dim: int) -> Codebooks:
    """For rows without a sample: all in one cell, all visited."""
    cut = max(1, dim // 2)
    return Codebooks(np.zeros((1, cut)), np.zeros((1, dim - cut)), 1.0)


def fit(sample: np.ndarray, centroids: int) -> Codebooks:
    """Centroids of both halves, and the share of entries that finds TARGET_RECALL of true neighbours."""
    cut = max(1, sample.shape[1] // 2)
    books = Codebooks(_centroids(sample[:, :cut], centroids), _centroids(sample[:, cut:], centroids), 1.0)
    i, j = _nearest(sample[:, :cut], books.first), _nearest(sample[:, cut:], books.second)
    counts = np.zeros((len(books.first), len(books.second)), dtype=np.int64)
    np.add.at(counts, (i, j), 1)
    places = []
    for query in np.linspace(0, len(sample) - 1, min(CALIBRATION, len(sample))).astype(int):
        scores = sample @ sample[query]
        scores[query] = -np.inf
        true = np.argsort(-scores, kind="stable")[: min(TOP, len(sample) - 1)]
        one, other = books.nearness(sample[query])
        order = np.argsort(-(one[:, None] + other[None, :]).ravel(), kind="stable")
        through = np.empty(len(order), dtype=np.int64)
        through[order] = np.cumsum(counts.ravel()[order])
        places.extend(through[i[true] * len(books.second) + j[true]] / len(sample))
    share = float(np.quantile(places, TARGET_RECALL, method="higher")) if places else 1.0
    return Codebooks(books.first, books.second, min(1.0, share))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (doubles) and dim of rows that take part, equal rows once.

    Left out: rows without vec_id, null, empty and zero vectors, and those with a null or non-finite component.
    """
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select("vec_id", vector.alias("vector")).where("vec_id is not null and vector is not null")
    rows = rows.where(fine & F.exists("vector", lambda x: x != 0)).distinct()
    return rows.withColumns({"dim": F.size("vector"), "row": F.monotonically_increasing_id()})


def _sampled(rows: DataFrame, totals: dict[int, int]) -> dict[int, np.ndarray]:
    """Rows drawn by a hash, by number of coordinates; they come to the driver as packed doubles."""
    size = sum(8 * dim * count for dim, count in totals.items())
    part = min(1.0, SAMPLE / sum(totals.values()), SAMPLE_BYTES / size)
    drawn = F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1 << 30)) < F.lit(int(part * (1 << 30)))
    table = rows.where(drawn).orderBy("vec_id", "vector").select("dim", "vector").toArrow()
    dims, vectors = table.column("dim").to_numpy(), table.column("vector").combine_chunks()
    values, ends = vectors.values.to_numpy(), vectors.offsets.to_numpy()
    return {
        int(dim): np.stack([values[ends[at] : ends[at + 1]] for at in np.flatnonzero(dims == dim).tolist()])
        for dim in np.unique(dims).tolist()
    }


def _groups(held: Sequence[int]) -> list[int]:
    """A group for each first centroid: neighbours that hold about CHUNK entries together."""
    groups, group, filled = [], 0, 0
    for entries in held:
        if filled and filled + entries > CHUNK:
            group, filled = group + 1, 0
        groups.append(group)
        filled += entries
    return groups


def search(vectors: DataFrame, is_query: Column, top: int = TOP, share: float | None = None) -> DataFrame:
    """The ``top`` nearest rows of each query row among all others: query_id, rank, vec_id, score.

    Nearness is the largest inner product in double precision, ties go to the smaller vec_id. A query gets all
    candidates where there are fewer. A query without other rows gives none. ``share`` is the part of the rows that a
    query visits; without it, it is fitted for a recall of TARGET_RECALL, and 1.0 gives the exact answer.

    Rows with different vectors under one vec_id are each a candidate, and a query; equal rows count once. A query
    meets the rows of its own number of coordinates only.
    """
    spark = vectors.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(usable(vectors))
    totals = {r.dim: r["count"] for r in rows.groupBy("dim").count().collect()}
    if not totals:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = _sampled(rows, totals) if share is None or share < 1 else {}
    fitted = {dim: fit(own, centroids_for(totals[dim])) for dim, own in sample.items()}
    fitted = {dim: fitted.get(dim) or single_cell(dim) for dim in totals}
    books = spark.sparkContext.broadcast(fitted)
    entries = written(map_arrow(rows, _assign(books), _ENTRY))
    counts = {dim: np.zeros((len(b.first), len(b.second)), dtype=np.int64) for dim, b in fitted.items()}
    for cell in entries.groupBy("dim", "i", "j").count().collect():
        counts[cell.dim][cell.i, cell.j] = cell["count"]
    groups = {dim: _groups(own.sum(1).tolist()) for dim, own in counts.items()}
    chunks: dict[tuple[int, int], int] = {}
    for dim, own in counts.items():
        filled = np.bincount(groups[dim], weights=own.sum(1))
        chunks |= {(dim, group): max(1, math.ceil(held / CHUNK)) for group, held in enumerate(filled.tolist())}
    wanted = {
        dim: max(LEAST_ENTRIES, 4 * top, math.ceil((fitted[dim].share if share is None else share) * total)) + 1
        for dim, total in totals.items()
    }  # the query itself is among them
    plan = spark.createDataFrame(
        [(dim, i, group, chunks[dim, group], len(fitted[dim].second)) for dim, own in groups.items() for i, group in enumerate(own)],
        "dim int, i int, `group` int, chunks int, width int",
    )
    # At most MOST_CENTROIDS rows for every number of coordinates.
    dealt = entries.join(F.broadcast(plan), ["dim", "i"])
    chunk, cell = F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int"), F.col("i") * F.col("width") + F.col("j")
    dealt = dealt.withColumns({"chunk": chunk, "kind": F.lit(0), "cells": F.unhex(F.lpad(F.hex(cell), 8, "0"))})
    index = spark.sparkContext.broadcast((counts, groups, chunks, wanted))
    probes = map_arrow(entries.where(is_query), _probe(books, index), _DEALT)
    place = ("dim", "group", "chunk")
    met = dealt.select(*_DEALT.names).unionByName(probes).repartition(partitions, *place).sortWithinPartitions(*place, "kind")
    found = map_arrow(met, _rank(top), _FOUND)
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


_ENTRY = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("dim", T.IntegerType()),
        T.StructField("i", T.IntegerType()),
        T.StructField("j", T.IntegerType()),
        T.StructField("vector", T.BinaryType()),
    ]
)
# kind 0: an entry with its cell; kind 1: a query with the cells it visits in this share.
_DEALT = T.StructType(
    [
        T.StructField("dim", T.IntegerType()),
        T.StructField("group", T.IntegerType()),
        T.StructField("chunk", T.IntegerType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("row", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("cells", T.BinaryType()),
        T.StructField("vector", T.BinaryType()),
    ]
)
_FOUND = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def _assign(books):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                held = [np.array(v, dtype=np.float64) for v in piece.column("vector").to_pylist()]
                i, j = np.zeros(len(held), dtype=np.int32), np.zeros(len(held), dtype=np.int32)
                dims = piece.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    at, own = np.flatnonzero(dims == dim), books.value[dim]
                    matrix = np.stack([held[n] for n in at.tolist()])
                    i[at], j[at] = _nearest(matrix[:, : own.cut], own.first), _nearest(matrix[:, own.cut :], own.second)
                vectors = pa.array([row.tobytes() for row in held], pa.binary())
                columns = [piece.column("row"), piece.column("vec_id"), piece.column("dim"), pa.array(i), pa.array(j), vectors]
                yield pa.RecordBatch.from_arrays(columns, names=_ENTRY.names)

    return task


def _probe(books, index):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, groups, chunks, wanted = index.value
        for batch in batches:
            for piece in slices(batch):
                made = []
                for row, key, dim, vector in zip(*(piece.column(n).to_pylist() for n in ("row", "vec_id", "dim", "vector"))):
                    cells: dict[int, list[int]] = {}
                    own, width = groups[dim], counts[dim].shape[1]
                    near = books.value[dim].nearness(np.frombuffer(vector))
                    for i, j in visited(*near, counts[dim], wanted[dim]):
                        cells.setdefault(own[i], []).append(i * width + j)
                    for group, held in cells.items():
                        packed = np.array(held, dtype=np.int32).tobytes()
                        made.extend((dim, group, chunk, 1, row, key, packed, vector) for chunk in range(chunks[dim, group]))
                if made:
                    kinds = (*[pa.int32()] * 4, pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    columns = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names=_DEALT.names)

    return task


class _Share:
    """The entries of one share, by cell, and the ranking of queries against them."""

    def __init__(self, place: tuple[int, ...]):
        self.place, self.rows, self.ids, self.cells, self.vectors = place, [], [], [], []
        self.known = np.zeros(0, dtype=np.int64)
        self.place_of: dict[int, int] = {}
        self.ready = False

    def settle(self) -> None:
        self.place_of = {row: n for n, row in enumerate(self.rows)}
        self.ids = np.array(self.ids, dtype=np.int64)
        self.known, self.cells = np.unique(np.array(self.cells, dtype=np.int64), return_inverse=True)
        self.vectors = np.array(self.vectors).reshape(len(self.ids), -1)
        self.ready = True

    def rank(self, rows: list[int], keys: list[int], cells: list[np.ndarray], vectors: np.ndarray, top: int) -> list[tuple]:
        """(row, query_id, vec_ids, scores) of each query that finds something here."""
        if not self.ready:
            self.settle()
        if not len(self.ids):
            return []
        visits = np.zeros((len(keys), len(self.known)), dtype=bool)
        for n, own in enumerate(cells):
            visits[n] = np.isin(self.known, own, assume_unique=True)
        scores = vectors @ self.vectors.T
        scores[~visits[:, self.cells]] = -np.inf
        out = []
        for own_row, key, vector, row in zip(rows, keys, vectors, scores):
            if own_row in self.place_of:
                row[self.place_of[own_row]] = -np.inf
            bound = -np.inf
            if len(row) > top:
                last = np.partition(row, len(row) - top)[len(row) - top]
                # Products of a matrix may differ in their last bits from exact sums; those near the bound stay.
                bound = last - 1e-9 * max(1.0, abs(last)) if np.isfinite(last) else -np.inf
            chosen = np.flatnonzero((row >= bound) & (row > -np.inf))
            exact = np.zeros(len(chosen))
            for d in range(len(vector)):
                exact += vector[d] * self.vectors[chosen, d]
            best = np.lexsort((self.ids[chosen], -exact))[:top]
            if len(best):
                out.append((own_row, key, self.ids[chosen][best], exact[best]))
        return out


def _rank(top: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share: _Share | None = None
        for batch in batches:
            for piece in slices(batch):
                place = [piece.column(n).to_numpy() for n in ("dim", "group", "chunk", "kind")]
                rows, keys, cells, vectors = (piece.column(n).to_pylist() for n in ("row", "vec_id", "cells", "vector"))
                turns = np.flatnonzero(np.any([np.diff(p) != 0 for p in place], axis=0)) + 1
                for a, b in zip([0, *turns.tolist()], [*turns.tolist(), len(keys)]):
                    where, kind = tuple(int(p[a]) for p in place[:3]), int(place[3][a])
                    if share is None or share.place != where:
                        share = _Share(where)
                    own = np.frombuffer(b"".join(vectors[a:b])).reshape(b - a, -1)
                    if kind == 0:
                        share.rows.extend(rows[a:b])
                        share.ids.extend(keys[a:b])
                        share.cells.extend(int.from_bytes(c, "big") for c in cells[a:b])
                        share.vectors.extend(own)
                        continue
                    visits = [np.frombuffer(c, dtype=np.int32) for c in cells[a:b]]
                    found = share.rank(rows[a:b], keys[a:b], visits, own, top)
                    if found:
                        many = [len(ids) for _, _, ids, _ in found]
                        columns = [
                            pa.array(np.repeat([f[0] for f in found], many)),
                            pa.array(np.repeat([f[1] for f in found], many)),
                            pa.array(np.concatenate([f[2] for f in found])),
                            pa.array(np.concatenate([f[3] for f in found])),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, names=_FOUND.names)

    return task
