"""Ranked lexical search in reverse: the items are indexed, the documents stream past the index.

A first pass over the documents counts the terms that items ask for. Document frequencies come from these counts. A
second pass over the counts scores each document against the postings of its terms, that is the items that hold
them, and keeps per task a bounded heap of the best documents of each item; the heaps are merged in two levels.
Items go in blocks of bounded size, so that the broadcast index stays small whatever the number of items.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.rows import map_arrow, map_rows, slices
from sluicegate.llm.words import blocks, numbers, texts, words
from sluicegate.scratch import written

TOP = 20
# Bytes of the items' terms in one broadcast index, and postings that are added up at a time.
BLOCK, TOGETHER = 4 << 20, 1 << 21
MERGE_GROUPS = 64


class Postings:
    """For each term the items that hold it and how often, in one run of arrays. ``rows`` are item id, term, times."""

    def __init__(self, rows: Sequence[tuple[int | None, bytes, int]]):
        self.terms = {term: n for n, term in enumerate(sorted({term for _, term, _ in rows}))}
        self.items = sorted({item for item, _, _ in rows}, key=lambda item: (item is None, item or 0))
        place = {item: n for n, item in enumerate(self.items)}
        term = np.array([self.terms[t] for _, t, _ in rows], dtype=np.int64)
        order = np.argsort(term, kind="stable")
        self.item = np.array([place[item] for item, _, _ in rows], dtype=np.int64)[order]
        self.times = np.array([times for *_, times in rows], dtype=np.int64)[order]
        self.begin = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        self.many = np.diff(self.begin)

    def scores(self, docs: int, doc: np.ndarray, term: np.ndarray, value: np.ndarray) -> np.ndarray:
        """A row per document, a column per item: the sum of the values of the document's terms that the item holds."""
        total = np.zeros(docs * len(self.items), dtype=np.int64)
        many = self.many[term]
        spread = np.repeat(np.arange(len(term)), many)
        posting = np.repeat(self.begin[term] - (np.cumsum(many) - many), many) + np.arange(len(spread))
        np.add.at(total, doc[spread] * len(self.items) + self.item[posting], value[spread] * self.times[posting])
        return total.reshape(docs, len(self.items))


class Heaps:
    """The best documents of each item: at most ``top``, by score, then by doc_id, documents without an id last."""

    def __init__(self, items: int, top: int):
        self.top, self.heaps = top, [[] for _ in range(items)]
        self.floor = np.ones(items, dtype=np.int64)  # scores below can't enter

    def offer(self, ids: list[int | None], scores: np.ndarray) -> None:
        for row, item in zip(*(place.tolist() for place in np.nonzero(scores >= self.floor))):
            heap, doc = self.heaps[item], ids[row]
            entry = (int(scores[row, item]), doc is not None, -doc if doc is not None else 0)
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.floor[item] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for item, heap in enumerate(self.heaps):
            for score, named, doc in heap:
                yield item, -doc if named else None, score


_COUNTED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("terms", T.BinaryType()),
        T.StructField("times", T.BinaryType()),
    ]
)


def _count(index):
    """Per document its number of terms, and the numbers of the indexed ones with how often they occur."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value.terms
        for batch in batches:
            for piece in slices(batch):
                own = [numbers(text, known) for text in texts(piece.column("text"))]
                doc = np.repeat(np.arange(len(own)), [len(o) for o in own])
                term = np.concatenate([np.empty(0, dtype=np.int32), *own])
                held = term >= 0
                pairs, times = np.unique(doc[held] * len(known) + term[held], return_counts=True)
                cut = np.searchsorted(pairs, np.arange(len(own) + 1) * len(known))
                term, times = (pairs % max(1, len(known))).astype(np.int32), times.astype(np.int32)
                runs = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
                columns = [
                    piece.column("doc_id"),
                    pa.array([len(o) for o in own], pa.int64()),
                    pa.array([term[a:b].tobytes() for a, b in runs], pa.binary()),
                    pa.array([times[a:b].tobytes() for a, b in runs], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_COUNTED.names)

    return task


def _numbers_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(run, dtype=np.int32) for run in column.to_pylist()]


def _frequencies(terms: int):
    """Documents per term, added up within a task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, dtype=np.int64)
        for batch in batches:
            for run in _numbers_of(batch.column(0)):
                total[run] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    return task


_BEST = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]
)


def _best(index, weights, n_docs: int, n_terms: int, top: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings, weight = index.value, weights.value
        heaps = Heaps(len(postings.items), top)
        for batch in batches:
            for piece in slices(batch):
                ids, n = piece.column("doc_id").to_pylist(), piece.column("n").to_numpy()
                terms, times = _numbers_of(piece.column("terms")), _numbers_of(piece.column("times"))
                work = [int(postings.many[t].sum()) + len(postings.items) for t in terms]
                start = 0
                while start < len(ids):
                    end, sum_of = start + 1, work[start]
                    while end < len(ids) and sum_of + work[end] <= TOGETHER:
                        sum_of += work[end]
                        end += 1
                    doc = np.repeat(np.arange(end - start), [len(t) for t in terms[start:end]])
                    term = np.concatenate(terms[start:end]).astype(np.int64)
                    tf = np.concatenate(times[start:end]).astype(np.int64)
                    m = 100 - 25 + (25 * n[start:end] * n_docs) // n_terms
                    value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
                    heaps.offer(ids[start:end], postings.scores(end - start, doc, term, value))
                    start = end
        rows = [(postings.items[item], doc, score) for item, doc, score in heaps.rows()]
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(columns, names=_BEST.names)

    return task


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, times. Equal rows count once; the terms of rows that share an item_id add up."""

    def rule(ids: list, given: list) -> Iterator[tuple]:
        for item, text in zip(ids, given):
            for term, times in Counter(words((text or "").encode())).items():
                yield item, term, times

    schema = T.StructType(
        [T.StructField("item_id", T.LongType()), T.StructField("term", T.BinaryType()), T.StructField("times", T.LongType())]
    )
    rows = map_rows(items.select("item_id", "text").distinct(), ("item_id", "text"), rule, schema)
    return rows.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of each item with the highest scores above 0: item_id, rank, doc_id, score.

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), with N documents that have terms and df that have this
    one. A document of n terms gets, for each of the item's terms, repeats included, the weight times
    (10^9 tf) div (1000 tf + 12 m), where m = 75 + (25 n N) div L and L is the number of all terms. All but the weights is
    whole-number arithmetic. Equal scores go by ascending doc_id, documents without an id come last. Every row of ``docs`` is a document, also where ids or texts
    repeat; null and empty texts have no terms, count for nothing and are never found. Items without terms and items
    that no document shares a term with give no row; rows that share an item_id are one item.
    """
    spark = docs.sparkSession
    terms, found = written(item_terms(items)), spark.createDataFrame([], _BEST)
    size = F.octet_length("term").cast("long") + 24
    for block in blocks(terms, "item_id", size, BLOCK):
        index = spark.sparkContext.broadcast(Postings([(r.item_id, bytes(r.term), r.times) for r in block]))
        counted = written(map_arrow(docs.select("doc_id", "text"), _count(index), _COUNTED))
        n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if n_terms:
            df = np.zeros(len(index.value.terms), dtype=np.int64)
            parts = map_arrow(counted.select("terms"), _frequencies(len(df)), "term long, df long")
            for row in parts.groupBy("term").agg(F.sum("df").alias("df")).collect():
                df[row.term] = row.df
            weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()]
            weight = spark.sparkContext.broadcast(np.array(weights, dtype=np.int64))
            found = found.unionByName(map_arrow(counted, _best(index, weight, n_docs, n_terms, top), _BEST))
    return _merged(found, top)


def _merged(found: DataFrame, top: int) -> DataFrame:
    """Heaps of tasks merge in groups first, so that those of many tasks don't all meet in one."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    groups = Window.partitionBy("item_id", "group").orderBy(*order)
    some = found.withColumn("group", F.spark_partition_id() % MERGE_GROUPS)
    some = some.withColumn("rank", F.row_number().over(groups)).where(F.col("rank") <= top)
    best = Window.partitionBy("item_id").orderBy(*order)
    ranked = some.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
