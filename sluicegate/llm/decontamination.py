"""Benchmark decontamination: windows of benchmark items are looked for in all documents.

The windows of the items (ten words, all words of shorter items) are numbered words in a broadcast hash set: sorted
rolling hashes with a table of their leading bits before them. A task numbers the words of its documents by the items'
vocabulary, rolls the same hash over them, and verifies each hit word by word, so that a chance equal hash never counts.
Items go in blocks of bounded size, whatever the benchmark; further blocks are further passes over the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.rows import map_arrow, map_rows, slices
from sluicegate.llm.words import UNKNOWN, blocks, numbers, texts, words
from sluicegate.scratch import written

WINDOW = 10
# Windows of one piece of a long item, and bytes of the items' words in one broadcast set, which is some twenty times as
# large in a worker.
PIECE, BLOCK = 4096, 4 << 20
# Leading bits of a hash that are looked up before the hash itself.
LEADING = 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_MARKS = (
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "end")]))),
    T.StructField("items", T.ArrayType(T.LongType())),
)
_ARROW_HITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def rolled(ids: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every ``length`` numbers in a row; other numbers hardly ever have the same."""
    wide = ids.astype(np.uint64) + np.uint64(2)
    hashes = wide[: len(wide) - length + 1].copy()
    for i in range(1, length):
        hashes *= _FACTOR
        hashes += wide[i : len(wide) - length + 1 + i]
    hashes ^= hashes >> np.uint64(29)
    hashes *= _FACTOR
    return hashes


class _Set:
    """The distinct windows of one length: hash, first place in the items' words, and the items that hold them."""

    def __init__(self, flat: np.ndarray, places: np.ndarray, owners: np.ndarray, length: int):
        self.flat, self.length = flat, length
        hashes = rolled(flat, length)[places]
        order = np.argsort(hashes, kind="stable")
        hashes, places, owners = hashes[order], places[order], owners[order]
        fresh = np.ones(len(hashes), dtype=bool)
        if len(hashes) > 1:
            fresh[1:] = (hashes[1:] != hashes[:-1]) | ~self._same(flat, places[1:], places[:-1])
        first = np.flatnonzero(fresh)
        self.hashes, self.places, self.owners = hashes[first], places[first], owners
        self.owned = np.append(first, len(owners))
        self.leading = np.zeros(1 << LEADING, dtype=bool)
        self.leading[(self.hashes >> np.uint64(64 - LEADING)).astype(np.int64)] = True

    def _same(self, ids: np.ndarray, at: np.ndarray, places: np.ndarray) -> np.ndarray:
        same = np.ones(len(at), dtype=bool)
        for i in range(self.length):
            same &= ids[at + i] == self.flat[places + i]
        return same

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows start in ``ids``, and which ones; verified word by word."""
        none = np.empty(0, dtype=np.int64)
        if len(ids) < self.length:
            return none, none
        hashes = rolled(ids, self.length)
        at = np.flatnonzero(self.leading[(hashes >> np.uint64(64 - LEADING)).astype(np.int64)])
        left = np.searchsorted(self.hashes, hashes[at], "left")
        many = np.searchsorted(self.hashes, hashes[at], "right") - left
        spread = np.repeat(np.arange(len(at)), many)
        which = left[spread] + np.arange(len(spread)) - np.repeat(np.cumsum(many) - many, many)
        at = at[spread]
        right = self._same(ids, at, self.places[which])
        return at[right], which[right]

    def items(self, which: np.ndarray) -> np.ndarray:
        parts = [self.owners[self.owned[w] : self.owned[w + 1]] for w in np.unique(which).tolist()]
        return np.unique(np.concatenate(parts)) if parts else np.empty(0, dtype=np.int64)


class Windows:
    """The windows of a block of items. ``pieces`` are pairs of an item's id and consecutive words of it."""

    def __init__(self, pieces: Sequence[tuple[int | None, bytes]]):
        self.known: dict[bytes, int] = {}
        self.names = sorted({item for item, _ in pieces if item is not None})
        place_of = {name: n for n, name in enumerate(self.names)}
        flat, starts, at = [], {}, 0
        for item, text in pieces:
            ids = [self.known.setdefault(word, len(self.known)) for word in text.split()]
            length, owner = min(WINDOW, len(ids)), place_of.get(item, -1)
            starts.setdefault(length, []).append((at, len(ids) - length + 1, owner))
            flat.append(np.array(ids, dtype=np.int32))
            at += len(ids)
        self.flat = np.concatenate([np.empty(0, dtype=np.int32), *flat])
        self.sets = []
        for length, runs in sorted(starts.items()):
            places = np.concatenate([np.arange(start, start + many) for start, many, _ in runs])
            owners = np.repeat([owner for *_, owner in runs], [many for _, many, _ in runs])
            self.sets.append(_Set(self.flat, places, owners, length))

    def mark(self, given: list[bytes]) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
        """For each text its number of words, the ranges of words that are hit, and the ids of the items found."""
        own = [numbers(text, self.known) for text in given]
        # A word that no item has parts the texts, so that no window reaches from one into the next.
        part = np.array([UNKNOWN], dtype=np.int32)
        ids = np.concatenate([part, *(x for o in own for x in (o, part))])
        begins = np.cumsum([1, *(len(o) + 1 for o in own)])
        found = [(s, *s.find(ids)) for s in self.sets]
        change = np.zeros(len(ids) + 1, dtype=np.int64)
        for s, at, _ in found:
            np.add.at(change, at, 1)
            np.add.at(change, at + s.length, -1)
        hit = np.append(np.cumsum(change)[:-1] > 0, False)
        edges = np.flatnonzero(np.diff(hit.astype(np.int8))) + 1
        out = [(len(o), [], []) for o in own]
        for start, end in edges.reshape(-1, 2).tolist():
            row = int(np.searchsorted(begins, start, "right")) - 1
            # Windows that touch at the parting word can't be: it is never hit.
            out[row][1].append((start - int(begins[row]), end - int(begins[row])))
        for s, at, which in found:
            rows = np.searchsorted(begins, at, "right") - 1
            for row in np.unique(rows).tolist():
                owners = s.items(which[rows == row])
                out[row][2].extend(self.names[o] for o in owners.tolist() if o >= 0)
        return out


def _pieces(items: DataFrame) -> DataFrame:
    """Distinct item_id and words (joined by spaces), long items in pieces that share all windows between them."""

    def rule(ids: list, given: list) -> Iterator[tuple]:
        for item, text in zip(ids, given):
            own = words((text or "").encode())
            for start in range(0, max(1, len(own) - WINDOW + 1), PIECE):
                piece = own[start : start + PIECE + WINDOW - 1]
                if piece:
                    yield item, b" ".join(piece)

    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("words", T.BinaryType())])
    return map_rows(items, ("item_id", "text"), rule, schema).distinct()


def _merged(one: list[tuple[int, int]], other: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(one + other):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _marking(index, first: bool, last: bool, schema: T.StructType):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                marks = index.value.mark(texts(piece.column("text")))
                if not first:
                    hits, items = piece.column("hits").to_pylist(), piece.column("items").to_pylist()
                    marks = [
                        (n, _merged([(h["start"], h["end"]) for h in before], now), sorted({*owners, *found}))
                        for (n, now, found), before, owners in zip(marks, hits, items)
                    ]
                columns = [
                    piece.column("row"),
                    *([] if last else [piece.column("text")]),
                    pa.array([n for n, _, _ in marks], pa.int64()),
                    pa.array([[{"start": s, "end": e} for s, e in hits] for _, hits, _ in marks], _ARROW_HITS),
                    pa.array([sorted(set(found)) for _, _, found in marks], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return task


def mark(docs: DataFrame, items: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """What of each document also stands in an item: row, n_words, hits, items.

    ``row`` is a struct of the document's columns (``keep``: only those), so that no name of theirs can clash. ``hits`` are
    the ranges of words (from 0, end exclusive, in order, apart) inside an occurring window, ``items`` the sorted ids
    of the items with such windows. Null and empty texts have no words and are never hit; items without words have no
    window. Rows that share an item_id are one item with the windows of all; an item without an id marks words, but
    is not listed. Repeated documents are marked each.
    """
    spark = docs.sparkSession
    row = F.struct(*[F.col(f"`{n}`") for n in keep]) if keep is not None else F.struct("*")
    now = docs.select(row.alias("row"), F.col("text"))
    plain = now.schema
    pieces = written(_pieces(items))
    found = blocks(pieces, "words", F.octet_length("words").cast("long") + 16, BLOCK)
    block, first = next(found, []), True
    while block is not None:
        following = next(found, None)
        schema = T.StructType([plain["row"], *([plain["text"]] if following else []), *_MARKS])
        index = spark.sparkContext.broadcast(Windows([(r.item_id, bytes(r.words)) for r in block]))
        now = map_arrow(now, _marking(index, first, following is None, schema), schema)
        now = written(now) if following else now
        block, first = following, False
    return now


def without_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no window of an item, with all their columns."""
    return mark(docs, items).where(F.size("hits") == 0).select("row.*")


def without_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """All documents with their columns; from their texts every range of hit words is cut, from its first character
    to its last. n_chars follows where a text changed."""
    marked = mark(docs, items)
    text, n_chars = marked.schema["row"].dataType["text"], "n_chars" in marked.schema["row"].dataType.names
    cut = map_arrow(marked.select("row", F.col("row.text").alias("text"), "hits"), _cut, T.StructType([marked.schema["row"], text]))
    changed = F.col("row").withField("text", F.col("text"))
    if n_chars:
        length = F.when(F.col("row.text").eqNullSafe(F.col("text")), F.col("row.n_chars")).otherwise(F.char_length("text"))
        changed = changed.withField("n_chars", length.cast(marked.schema["row"].dataType["n_chars"].dataType))
    return cut.select(changed.alias("row")).select("row.*")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            given, hits = piece.column("text").to_pylist(), piece.column("hits").to_pylist()
            left = [without(text, [(h["start"], h["end"]) for h in own]) for text, own in zip(given, hits)]
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(left, pa.string())], names=["row", "text"])


def without(text: str | None, hits: list[tuple[int, int]]) -> str | None:
    """The text without the given ranges of its words."""
    if not hits:
        return text
    spans = [m.span() for m in WORD.finditer(text)]
    parts, at = [], 0
    for start, end in hits:
        parts.append(text[at : spans[start][0]])
        at = spans[end - 1][1]
    return "".join(parts) + text[at:]


def summarise(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (hit words), n_items, items_sha256 (of their ids, sorted as texts and
    joined by commas) and contaminated."""
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, h: total + h["end"] - h["start"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return mark(docs, items, ("doc_id",)).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
