"""Near-duplicates by an LSH forest over MinHash signatures, confirmed on whole shingle sets.

Equal texts are one node from the start. The other nodes get a MinHash signature, cut into several orders of
some levels each, as many as the wanted similarity needs (36 of eight for 0.85, 49 of seven for 0.8). In each
order the signatures are sorted, and nodes become candidates when they stand together with a common prefix that
is long enough: all levels but two where few nodes share those, all levels in crowded regions. A region is chained by set size, and the chain ends where sizes differ too much for a link.
Chains of all orders together make groups within which links lie; the chance that a pair at the threshold
shares no region is about 1e-5 in crowded regions and less elsewhere. Groups are then compared on their whole
sets, in blocks where they are large, and the links found make the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.components import Forest, components, with_least
from sluicegate.llm.rows import map_arrow, map_rows, slices
from sluicegate.scratch import written

WORDS = 5
# Links need 100 * intersection >= least * union; this is the least of op4.
LEAST = 85
# Of the shapes with at most so many levels and orders, one with most levels is taken whose orders all miss a pair
# at the threshold with at most this chance.
MOST_LEVELS, MOST_ORDERS, MISSED = 8, 50, 1.1e-5
# A region of more nodes than this is crowded.
CROWDED, HELD = 64, 1 << 14
# Shingles of one block of a group, to be compared with another block in one task.
BLOCK = 200_000
_LEVEL_BYTES = 2


class Shape(NamedTuple):
    """Orders and levels of the signatures for links of ``least`` hundredths."""

    least: int
    orders: int
    levels: int

    @property
    def functions(self) -> int:
        return self.orders * self.levels

    @property
    def key(self) -> int:
        return self.levels * _LEVEL_BYTES

    @property
    def few(self) -> int:
        """Levels that the nodes of any region have in common."""
        return max(1, self.levels - 2)


def shape(least: int) -> Shape:
    if not 1 <= least <= 100:
        raise ValueError(f"a similarity of {least} hundredths")
    for levels in range(MOST_LEVELS, 0, -1):
        same = (least / 100) ** levels
        orders = math.ceil(math.log(MISSED) / math.log1p(-same)) if same < 1 else 1
        if orders <= MOST_ORDERS:
            return Shape(least, orders, levels)
    raise ValueError(f"no shape of signatures finds pairs of {least} hundredths")


ORDERS, LEVELS = shape(LEAST)[1:]
_RANDOM = np.random.default_rng(20_250_101)
_MULTIPLY = _RANDOM.integers(0, 2**63, ORDERS * LEVELS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RANDOM.integers(0, 2**64, ORDERS * LEVELS, dtype=np.uint64)
# Those of shapes that need more.
_MORE = MOST_ORDERS * MOST_LEVELS - ORDERS * LEVELS
_MULTIPLY = np.append(_MULTIPLY, _RANDOM.integers(0, 2**63, _MORE, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
_FLIP = np.append(_FLIP, _RANDOM.integers(0, 2**64, _MORE, dtype=np.uint64))
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, with A to Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes]) -> np.ndarray:
    """The set of hashes of five words in a row, sorted; of fewer words the whole sequence is the one member."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    size = min(WORDS, len(words))
    hashes = np.array(list(map(xxhash.xxh3_64_intdigest, words)), dtype=np.uint64)
    n = len(hashes) - size + 1
    made = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        made = (made ^ (made >> np.uint64(32))) * _BASE + hashes[i : i + n]
    made = (made ^ (made >> np.uint64(32))) * _MIX
    return np.unique(made ^ (made >> np.uint64(29)))


def signature(own: np.ndarray, functions: int = ORDERS * LEVELS) -> bytes:
    """Two bytes of the least hash under each function, order by order."""
    least = np.full(functions, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(own), 2048):
        part = own[at : at + 2048]
        for f in range(0, len(least), 32):
            to = min(f + 32, len(least))
            hashes = (part[None, :] ^ _FLIP[f:to, None]) * _MULTIPLY[f:to, None]
            np.minimum(least[f:to], hashes.min(1), out=least[f:to])
    return (least >> np.uint64(16)).astype(np.uint16).astype(">u2").tobytes()


_SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("raw", T.LongType()),
        T.StructField("same", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("signature", T.BinaryType()),
    ]
)


def _sign(keys: list, raws: list, texts: list, functions: int) -> Iterator[tuple]:
    for key, raw, text in zip(keys, raws, texts):
        words = words_of(text)
        own = shingles(words)
        same = xxhash.xxh3_128_digest(b" ".join(words)) if words else None
        yield key, raw, same, len(own), signature(own, functions) if len(own) else None


_PAIR = "one long, other long"


def _raw() -> Column:
    """With the doc_id this finds a text again."""
    return F.xxhash64("text").alias("raw")


def _pairs(one: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(other, pa.int64())], names=["one", "other"])


def _common(key: np.ndarray, levels: int) -> np.ndarray:
    """How many levels each key has in common with the one before it."""
    same = (key[1:] == key[:-1]).reshape(-1, levels, _LEVEL_BYTES).all(2)
    return np.concatenate(([0], np.cumprod(same, axis=1).sum(1)))


def _chained(form: Shape, key: np.ndarray, n: np.ndarray, node: np.ndarray, region: np.ndarray) -> pa.RecordBatch:
    """Neighbours by size within regions, each as deep as it must be to hold few nodes.

    A node's region are the nodes that share a prefix of the least depth, level by level deeper as long as more
    than CROWDED nodes share it; at full depth it may hold any number. Regions come from the common prefixes of
    sorted neighbours.
    """
    common = _common(key, form.levels)
    apart = np.concatenate(([True], region[1:] != region[:-1]))
    part, open_ = np.zeros(len(region), dtype=np.int64), np.ones(len(region), dtype=bool)
    for depth in range(form.few, form.levels + 1):
        inside = np.cumsum(apart | (common < depth)) - 1
        settled = open_ & ((np.bincount(inside)[inside] <= CROWDED) | (depth == form.levels))
        part[settled] = depth * (len(region) + 1) + inside[settled]
        open_ &= ~settled
    by_size = np.lexsort((node, n, part))
    part, n, node = part[by_size], n[by_size], node[by_size]
    # All sizes between those of two that link are closer to each other, so no link crosses a wider step.
    near = np.minimum(n[1:], n[:-1]) * 100 >= np.maximum(n[1:], n[:-1]) * form.least
    chosen = (part[1:] == part[:-1]) & near
    return _pairs(node[:-1][chosen], node[1:][chosen])


def _chains(batches: Iterator[pa.RecordBatch], form: Shape) -> Iterator[pa.RecordBatch]:
    """Chains of one range of the sorted orders: columns order, key, n, node, sorted by them.

    A region that goes on in the next batch waits for it while it has at most HELD nodes. A longer one is chained
    piece by piece: the last nodes of a piece, as many as a region of less than full depth can hold, come again
    before the next, and nodes with equal keys are sorted by size, so that no neighbours are parted.
    Where a range ends inside a region, its chain is cut; its nodes meet in the other orders as likely as there.
    """
    few, held = form.few * _LEVEL_BYTES, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in ("order", "n", "node")]
        key = np.frombuffer(b"".join(batch.column("key").to_pylist()), dtype=np.uint8).reshape(-1, form.key)
        if held is not None:
            columns, key = [np.concatenate(c) for c in zip(held[0], columns)], np.concatenate((held[1], key))
        order, n, node = columns
        apart = (order[1:] != order[:-1]) | (key[1:, :few] != key[:-1, :few]).any(1)
        region = np.cumsum(np.concatenate(([0], apart)))
        last = int(np.searchsorted(region, region[-1]))
        done = len(region) if len(region) - last > HELD else last
        if done:
            yield _chained(form, key[:done], n[:done], node[:done], region[:done])
        last = max(last, len(region) - CROWDED) if done > last else last
        held = [c[last:] for c in columns], key[last:]
    if held is not None and len(held[1]):
        _, n, node = held[0]
        yield _chained(form, held[1], n, node, np.zeros(len(n), dtype=np.int64))


def candidate_groups(nodes: DataFrame, form: Shape) -> DataFrame:
    """node and component of all nodes that may link with another, the least node of a group included."""
    partitions = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    orders = nodes.withColumn("order", F.explode(F.sequence(F.lit(0), F.lit(form.orders - 1))))
    rows = orders.select(
        "order",
        F.substring("signature", F.col("order") * form.key + 1, F.lit(form.key)).alias("key"),
        F.col("n_shingles").cast("int").alias("n"),
        "node",
    )
    sort = ("order", "key", "n", "node")
    ranges = rows.repartitionByRange(partitions, *sort).sortWithinPartitions(*sort)
    found = components(map_arrow(ranges, partial(_chains, form=form), _PAIR), "one", "other")
    least = found.select(F.col("component").alias("node"), "component").distinct()
    return found.unionByName(least)


_MEMBER = T.StructType(
    [
        T.StructField("component", T.LongType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("against", T.IntegerType()),
        T.StructField("node", T.LongType()),
        T.StructField("shingles", T.BinaryType()),
    ]
)


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Places of linked sets, one of ``left`` and one of ``right``, by counting what each shares with all others."""
    sizes = np.array([len(s) for s in sets])
    members = np.repeat(np.arange(len(sets)), sizes)
    distinct, of = np.unique(np.concatenate(sets), return_inverse=True)
    by_shingle = np.argsort(of, kind="stable")
    members_of = members[by_shingle]
    ends = np.cumsum(np.bincount(of, minlength=len(distinct)))
    starts = np.concatenate(([0], ends[:-1]))
    places = np.concatenate(([0], np.cumsum(sizes)))
    for x in np.flatnonzero(left).tolist():
        own = of[places[x] : places[x + 1]]
        lengths = ends[own] - starts[own]
        own, lengths = own[lengths > 1], lengths[lengths > 1]
        if not len(own):
            continue
        offsets = np.repeat(starts[own] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        shared = np.bincount(members_of[offsets + np.arange(len(offsets))], minlength=len(sets))
        linked = shared * 100 >= least * (sizes[x] + sizes - shared)
        for y in np.flatnonzero(linked & right).tolist():
            if y != x:
                yield x, y


def _compare(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Links within each (component, block, against), as few as connect what is linked."""
    place, nodes, blocks, sets = None, [], [], []

    def settle() -> pa.RecordBatch:
        forest, kept = Forest(), []
        block = np.array(blocks)
        for x, y in _links(sets, block == place[1], block == place[2], least):
            if forest.join(nodes[x], nodes[y]):
                kept.append((nodes[x], nodes[y]))
        return _pairs(np.array([k[0] for k in kept], np.int64), np.array([k[1] for k in kept], np.int64))

    for batch in batches:
        for piece in slices(batch):
            for component, low, high, own, node, packed in zip(*(c.to_pylist() for c in piece.columns)):
                if place != (component, low, high):
                    if place is not None and len(nodes) > 1:
                        yield settle()
                    place, nodes, blocks, sets = (component, low, high), [], [], []
                if nodes and nodes[-1] == node and sets[-1].tobytes() == packed:
                    continue  # a repeated row
                nodes.append(node)
                blocks.append(own)
                sets.append(np.frombuffer(packed, dtype=np.uint64))
    if place is not None and len(nodes) > 1:
        yield settle()


def confirmed_links(docs: DataFrame, nodes: DataFrame, groups: DataFrame, least: int) -> DataFrame:
    """Pairs of linked nodes that connect all that is linked, from the whole texts of the groups' members.

    A group of many shingles is cut into blocks; each block meets each other one in a task of its own.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = groups.join(nodes.select("node", "doc_id", "raw", "same", "n_shingles"), "node")
    weights = sized.groupBy("component").agg(F.sum("n_shingles").alias("weight"))
    blocks = F.ceil(F.col("weight") / BLOCK).cast("int")
    placed = written(sized.join(weights.select("component", blocks.alias("blocks")), "component"))
    # Members grow with the documents, so they are never sent to every task: one plan at every size.
    texts = docs.select("doc_id", _raw(), "text").join(placed.hint("merge"), ["doc_id", "raw"])

    def rule(tops: list, members: list, wanted: list, counts: list, documents: list) -> Iterator[tuple]:
        for component, node, same, count, text in zip(tops, members, wanted, counts, documents):
            words = words_of(text)
            # Another text with the same short hash under the same doc_id is another node.
            if xxhash.xxh3_128_digest(b" ".join(words)) == same:
                block = xxhash.xxh3_64_intdigest(node.to_bytes(8, "little", signed=True)) % count
                yield component, block, count, node, shingles(words).tobytes()

    own = map_rows(texts, ("component", "node", "same", "blocks", "text"), rule, _MEMBER)
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("against") - 1)))
    low, high = F.least("block", "other").cast("int"), F.greatest("block", "other").cast("int")
    met = own.select("component", low.alias("low"), high.alias("high"), "block", "node", "shingles")
    met = met.repartition(partitions, "component", "low", "high").sortWithinPartitions("component", "low", "high", "node")
    return map_arrow(met, partial(_compare, least=least), _PAIR)


def _resolved(docs: DataFrame, least: int) -> DataFrame:
    """Every row's doc_id, raw, same and n_shingles, and the first (doc_id, raw) of its component: first_id, first_raw.

    A node is a text, whatever doc_ids it has: it bears a number of its own, and its least doc_id and hash tell
    where to find it.
    """
    form = shape(least)
    rows = docs.select("doc_id", _raw(), "text")
    signed = written(map_rows(rows, ("doc_id", "raw", "text"), partial(_sign, functions=form.functions), _SIGNED))
    named = signed.where("doc_id is not null and same is not null")
    distinct = named.groupBy("same").agg(
        F.min(F.struct("doc_id", "raw")).alias("first"),
        F.min("n_shingles").alias("n_shingles"),
        F.min("signature").alias("signature"),
    )
    numbered = distinct.select("first.*", "same", "n_shingles", "signature", F.monotonically_increasing_id().alias("node"))
    nodes = written(numbered)
    groups = written(candidate_groups(nodes, form))
    links = written(confirmed_links(docs, nodes, groups, least))
    reached = components(links, "one", "other")
    first = nodes.select("node", "same", F.struct("doc_id", "raw").alias("own")).join(reached, "node", "left")
    first = written(first.select("same", F.coalesce("component", "node").alias("component"), "own"))
    first = with_least(first, "component", "own", first.count())
    first = first.select("same", F.col("least.doc_id").alias("first_id"), F.col("least.raw").alias("first_raw"))
    return signed.drop("signature").join(first, "same", "left")


def near_duplicates(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per document.

    Documents link when their sets of shingles have a Jaccard similarity of at least ``least`` hundredths.
    component_id is the least doc_id reachable over links; kept marks the document that bears it. A null or
    blank text has no shingles and links with nothing. Rows without doc_id link with nothing and are kept, with
    a null component_id. Rows that repeat a doc_id with the same text are one document; with different texts
    each row goes by its own text.
    """
    rows = _resolved(docs, least)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first_id", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def without_near_duplicates(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One document of each component, with all columns of the input: that of the least doc_id, and among different
    texts of this doc_id one of them. Rows of one doc_id with the same text are one document and stay or go together.
    """
    others = ~(F.col("doc_id").eqNullSafe(F.col("first_id")) & F.col("raw").eqNullSafe(F.col("first_raw")))
    found = _resolved(docs, least).where("doc_id is not null and first_id is not null").where(others)
    gone = written(found.select(F.col("doc_id").alias("gone_id"), F.col("raw").alias("gone_raw")).distinct())
    same = (docs["doc_id"] == gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_raw"])
    return docs.join(gone.hint("merge"), same, "left_anti").select(*(F.col(f"`{name}`") for name in docs.columns))
