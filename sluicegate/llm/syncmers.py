"""Fingerprints from closed syncmers.

A k-mer of characters is an anchor when the least of its inner s-mers stands first or last in it. That
depends on the k-mer alone, so equal passages give equal anchors wherever they stand. A fingerprint holds the
anchors with the least hashes and their positions. Two fingerprints are compared on the least hashes of both
together; an anchor counts as shared when both hold it and the two places differ by the usual shift.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.rows import map_arrow, prepare_workers, slices

K, S = 20, 8
ANCHORS = 64
# Characters that are hashed at a time; a window overlaps the next by K - 1.
WINDOW = 1 << 18
# Places further apart than this from the usual shift are not the same passage in the same order.
DRIFT = 8
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_ANCHOR = np.dtype([("hash", ">u4"), ("place", ">u4")])


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def _rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all substrings of a length, by doubling: longer ones are made of two shorter."""
    hashes, length, power = codes + np.uint64(1), 1, _BASE
    powers, parts = {1: (hashes, power)}, []
    while 2 * length <= size:
        hashes = hashes[: len(hashes) - length] * power + hashes[length:]
        power, length = power * power, 2 * length
        powers[length] = hashes, power
    made, done = None, 0
    for length in sorted(powers, reverse=True):
        while size - done >= length:
            own, power = powers[length]
            parts.append((own, done, power))
            done += length
    n = len(codes) - size + 1
    for own, at, power in parts:
        piece = own[at : at + n]
        made = piece if made is None else made * power + piece
    return _mixed(made)


def _window_anchors(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inner = _rolled(codes, S)
    count = K - S + 1
    least, width = inner, 1
    while 2 * width <= count:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    n = len(codes) - K + 1
    least = np.minimum(least[:n], least[count - width : count - width + n])
    places = np.flatnonzero((inner[:n] == least) | (inner[count - 1 : count - 1 + n] == least))
    return _rolled(codes, K)[places], places


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (32 bits) and places of all anchors; a text that has none, since it is short, is its own single anchor."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for at in range(0, len(codes) - K + 1, WINDOW):
            found, where = _window_anchors(codes[at : at + WINDOW + K - 1])
            parts.append((found, where + at))
        hashes, places = (np.concatenate(column) for column in zip(*parts))
        if not len(places):
            hashes, places = _rolled(codes, len(codes)), np.zeros(1, np.int64)
    return (hashes >> np.uint64(32)).astype(np.uint32), places


def fingerprint(text: str | None) -> str:
    """The ANCHORS least distinct anchor hashes with their first places, in hexadecimal; empty without text."""
    hashes, places = anchors(text or "")
    if len(hashes) > 4 * ANCHORS:
        # Repeated hashes may thin this out; then all are looked at.
        near = hashes <= np.partition(hashes, 4 * ANCHORS)[4 * ANCHORS]
        if len(np.unique(hashes[near])) >= ANCHORS:
            hashes, places = hashes[near], places[near]
    distinct, first = np.unique(hashes, return_index=True)
    made = np.zeros(min(ANCHORS, len(distinct)), dtype=_ANCHOR)
    made["hash"], made["place"] = distinct[:ANCHORS], np.minimum(places[first[:ANCHORS]], 2**32 - 1)
    return made.tobytes().hex()


def likeness(one: str, other: str) -> float:
    """Between 0 and 1: the Dice measure of the anchors, estimated on the least hashes; 1 for two empty ones."""
    if one == other:
        return 1.0
    a, b = (np.frombuffer(bytes.fromhex(x), dtype=_ANCHOR) for x in (one, other))
    if not len(a) or not len(b):
        return 0.0
    # Beyond the last hash of a full fingerprint nothing is known of its text.
    known = min([int(x["hash"][-1]) for x in (a, b) if len(x) == ANCHORS], default=2**32)
    a, b = a[a["hash"] <= known], b[b["hash"] <= known]
    _, mine, theirs = np.intersect1d(a["hash"], b["hash"], assume_unique=True, return_indices=True)
    if not len(mine):
        return 0.0
    shifts = b["place"][theirs].astype(np.int64) - a["place"][mine].astype(np.int64)
    usual = min(Counter(shifts.tolist()).items(), key=lambda x: (-x[1], abs(x[0]), x[0]))[0]
    shared = int((np.abs(shifts - usual) <= DRIFT).sum())
    return 2.0 * shared / (len(a) + len(b))


FINGERPRINTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_FIRST = -(2**63)
# Buckets per shuffle partition, so that partitions which get several come out even.
FINENESS = 4


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(doc_id: int | None, text: str, own: str, following: str, theirs: str) -> dict:
    edited = _edited(text, following)
    changed = own if edited == text else fingerprint(edited)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    values = (doc_id, len(text), digest, own, changed, likeness(own, changed), likeness(own, theirs))
    return dict(zip(_ARROW.names, values))


def _with_next(docs: DataFrame) -> DataFrame:
    """Rows dealt by ranges of doc_id, each range followed by the first rows of the next one.

    Columns: bucket, tail (1: a row of the next bucket), key, tie, doc_id, text. Only the bounds and least ids of the ranges reach the driver. Rows without doc_id come first.
    """
    spark = docs.sparkSession
    prepare_workers(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id"), F.lit(_FIRST)).cast("long")
    count = partitions * FINENESS
    shares = [i / count for i in range(1, count)]
    bounds = docs.select(F.percentile_approx(key, shares, 20 * count).alias("at")).first().at or []
    bounds = np.array(sorted(set(bounds)), dtype=np.int64)

    @F.pandas_udf(T.LongType())
    def bucket(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), side="right"))

    firsts = docs.select(key.alias("key")).groupBy(bucket("key").alias("bucket")).agg(F.min("key").alias("key"))
    least = {r.bucket: r.key for r in firsts.collect()}
    filled = sorted(least)
    # The bucket that also needs the rows of a bucket's least key: the one before, or the last for the first.
    before = {least[b]: filled[i - 1] for i, b in enumerate(filled)}
    rows = docs.select(key.alias("key"), F.xxhash64("text").alias("tie"), "doc_id", "text")
    keys = np.array(sorted(before), dtype=np.int64)
    to = np.array([before[k] for k in keys.tolist()], dtype=np.int64)

    @F.pandas_udf("array<struct<bucket:long,tail:long>>")
    def places(found: pd.Series) -> pd.Series:
        values = found.to_numpy()
        own = np.searchsorted(bounds, values, side="right")
        at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        least_key = keys[at] == values
        made = []
        for b, is_least, i in zip(own.tolist(), least_key.tolist(), at.tolist()):
            row = [{"bucket": b, "tail": 0}]
            if is_least:
                row.append({"bucket": int(to[i]), "tail": 1})
            made.append(row)
        return pd.Series(made)

    dealt = rows.withColumn("place", F.explode(places("key"))).select("place.*", "key", "tie", "doc_id", "text")
    order = ("bucket", "tail", "key", "tie")
    # Buckets hold about as many rows each, so each task takes as many buckets in a row.
    task = F.floor(F.col("bucket") * F.lit(partitions) / F.lit(len(bounds) + 1)).cast("int")
    return dealt.repartitionById(partitions, task).sortWithinPartitions(*order)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike the text is to both neighbours.

    The edited text is the text with its last half (rounded down) replaced by as many first characters of the
    next document by doc_id; the last document is followed by the first, a single one by itself. A null text
    is empty, an empty text has an empty fingerprint. Rows with equal doc_id are ordered by a hash of their
    text. Each text is shuffled once.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # bucket, doc_id, text and fingerprint of a row that lacks its next
        for batch in batches:
            for piece in slices(batch):
                made = []
                for bucket, tail, doc_id, text in zip(*(column.to_pylist() for column in piece.columns)):
                    text = text or ""
                    if tail and (waiting is None or waiting[0] != bucket):
                        continue  # a further row of the next bucket
                    own = fingerprint(text)
                    if waiting is not None and waiting[0] == bucket:
                        made.append(_row(waiting[1], waiting[2], waiting[3], text, own))
                    waiting = None if tail else (bucket, doc_id, text, own)
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema=_ARROW)

    return map_arrow(_with_next(docs).select("bucket", "tail", "doc_id", "text"), task, FINGERPRINTS)
