"""Connected components of links between numbers, by alternating stars; nothing of it reaches the driver but counts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.rows import map_arrow
from sluicegate.scratch import Written

# Nodes whose local components a task holds at a time.
LOCAL = 1 << 18


class Forest:
    """Disjoint sets of numbers, each named by its least member."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def root(self, node: int) -> int:
        top = node
        while (up := self.above.get(top, top)) != top:
            top = up
        while node != top:
            self.above[node], node = top, self.above.get(node, node)
        return top

    def join(self, one: int, other: int) -> bool:
        """Whether the two were apart."""
        one, other = self.root(one), self.root(other)
        if one == other:
            return False
        low, high = min(one, other), max(one, other)
        self.above[high] = low
        self.above.setdefault(low, low)
        return True

    def stars(self) -> tuple[list[int], list[int]]:
        pairs = [(node, top) for node in list(self.above) if (top := self.root(node)) != node]
        return [p[0] for p in pairs], [p[1] for p in pairs]


def _stars_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()

    def batch() -> pa.RecordBatch:
        nodes, tops = forest.stars()
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(tops, pa.int64())], names=["u", "v"])

    for links in batches:
        for u, v in zip(links.column(0).to_pylist(), links.column(1).to_pylist()):
            if u != v:
                forest.join(u, v)
        if len(forest.above) > LOCAL:
            yield batch()
            forest = Forest()
    yield batch()


def with_least(rows: DataFrame, key: str, value: str, total: int) -> DataFrame:
    """The rows with the least ``value`` among those of their key beside them, as ``least``; no key is left to one task.

    ``total`` is at least the number of rows. A key with more than a quarter of a task's even share of them is hot. There are at
    most four times as many hot keys as tasks, so these are sent to every task, and their rows are not shuffled.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.groupBy(key).agg(F.min(value).alias("least"), F.count("*").alias("rows"))
    limit = total // (4 * partitions)
    hot = F.broadcast(found.where(F.col("rows") > limit).select(key, "least"))
    cold = found.where(F.col("rows") <= limit).select(key, "least")
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key))


def _large_star(links: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = with_least(both, "u", "v", 2 * total).where("v > u")
    return linked.select(F.col("v").alias("u"), F.least("u", "least").alias("v"))


def _small_star(links: DataFrame, total: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    linked = with_least(links.where("u > v"), "u", "v", total)
    others = linked.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return others.unionByName(linked.select("u", F.col("least").alias("v")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first())


def components(links: DataFrame, one: str, other: str) -> DataFrame:
    """node and component (its least member) for every linked node but the least ones themselves.

    Each half round is written to the shared folder, so that a lost executor costs one at most; what it was made from
    is dropped then.
    """
    pairs = links.select(F.col(one).cast("long").alias("u"), F.col(other).cast("long").alias("v"))
    now = Written(map_arrow(pairs, _stars_of_task, "u long, v long"))
    state = _state(now.rows)
    while state[0]:
        half = Written(_large_star(now.rows, state[0]))
        now.drop()
        now = Written(_small_star(half.rows, state[0]).distinct())
        half.drop()
        after = _state(now.rows)
        if after == state:
            break
        state = after
    return now.rows.select(F.col("u").alias("node"), F.col("v").alias("component"))
