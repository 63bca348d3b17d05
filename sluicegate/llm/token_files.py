"""Token ids in files: Simple-8b blocks in ascending document order.

A file set is a Parquet table with one row per block, so that Spark commits it as a whole and any store
serves it. ``segment`` numbers the ranges of documents, ``block`` the blocks of a segment, ``first_id`` is
the number of ids before the block in its segment. ``payload`` is the block itself, little-endian:

    4 bytes  magic "S8B1"
    uint32   documents in the block, n
    uint32   words that follow the tables, w
    n x int64   doc_id
    n x uint8   1 if the doc_id is null
    (n + 1) x uint32   offset of each document's first id in the block; the last is the number of ids
    w x uint64  Simple-8b words of all ids of the block

A block holds whole documents, BLOCK_IDS ids or a few more; a longer document is a block of its own.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.rows import map_arrow, map_rows, slices
from sluicegate.llm.simple8b import pack, unpack
from sluicegate.scratch import scratch

MAGIC = b"S8B1"
BLOCK_IDS = 1 << 16
BLOCKS = T.StructType(
    [
        T.StructField("segment", T.LongType()),
        T.StructField("block", T.LongType()),
        T.StructField("first_id", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def to_block(keys: list[int | None], documents: list[bytes]) -> bytes:
    """A block from documents, each as 32-bit ids."""
    offsets = np.concatenate(([0], np.cumsum([len(d) // 4 for d in documents])))
    words = pack(np.frombuffer(b"".join(documents), dtype="<u4"))
    return b"".join(
        (
            MAGIC,
            struct.pack("<II", len(keys), len(words)),
            np.array([key or 0 for key in keys], dtype="<i8").tobytes(),
            bytes(key is None for key in keys),
            offsets.astype("<u4").tobytes(),
            words.astype("<u8").tobytes(),
        )
    )


def from_block(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Keys, offsets and ids of a block."""
    if payload[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n, w = struct.unpack_from("<II", payload, 4)
    keys = np.frombuffer(payload, "<i8", n, 12).tolist()
    missing = payload[12 + 8 * n : 12 + 9 * n]
    offsets = np.frombuffer(payload, "<u4", n + 1, 12 + 9 * n).astype(np.int64)
    ids = unpack(np.frombuffer(payload, "<u8", w, 16 + 13 * n))
    return [None if gone else key for key, gone in zip(keys, missing)], offsets, ids.astype("<u4")


def write_token_files(docs: DataFrame, encode: Callable[[], Callable[[str], bytes]], end_id: int, path: str) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending doc_id order.

    ``encode()`` gives a worker its encoder. Rows without doc_id come first; rows that share one are
    ordered by a hash of their text, and equal rows are all written. A null text has the end id only.
    One shuffle by ranges of doc_id; a doc_id that is very frequent is spread by the hash.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
    ordered = rows.repartitionByRange(partitions, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    end = struct.pack("<I", end_id)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, segment = encode(), TaskContext.get().partitionId()
        keys, documents, held, block, first = [], [], 0, 0, 0

        def row() -> pa.RecordBatch:
            values = (segment, block, first, held, to_block(keys, documents))
            return pa.RecordBatch.from_pylist([dict(zip(BLOCKS.names, values))], schema=arrow)

        arrow = pa.schema([*((name, pa.int64()) for name in BLOCKS.names[:-1]), ("payload", pa.binary())])
        for batch in batches:
            for piece in slices(batch):
                for key, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    ids = to_ids(text or "") + end
                    keys.append(key)
                    documents.append(ids)
                    held += len(ids) // 4
                    if held >= BLOCK_IDS:
                        yield row()
                        block, first = block + 1, first + held
                        keys, documents, held = [], [], 0
        if keys:
            yield row()

    map_arrow(ordered.select("doc_id", "text"), task, BLOCKS).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a file set: where its ids start among all ids, their number and crc32.

    The driver gets one total per segment; blocks are decoded where they lie, without a shuffle.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    totals = blocks.groupBy("segment").agg(F.sum("n_ids").alias("n_ids")).collect()
    before, base = 0, {}
    for total in sorted(totals, key=lambda r: r.segment):
        base[total.segment] = before
        before += total.n_ids

    def rule(segments: list, firsts: list, payloads: list) -> Iterator[tuple]:
        for segment, first, payload in zip(segments, firsts, payloads):
            keys, offsets, ids = from_block(payload)
            start = base[segment] + first
            for key, a, b in zip(keys, offsets[:-1].tolist(), offsets[1:].tolist()):
                yield key, start + a, b - a, zlib.crc32(ids[a:b].tobytes())

    return map_rows(blocks, ("segment", "first_id", "payload"), rule, DOCUMENTS)


def token_files(docs: DataFrame, encode: Callable[[], Callable[[str], bytes]], end_id: int) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    path = scratch(docs.sparkSession)
    write_token_files(docs, encode, end_id, path)
    return read_token_files(docs.sparkSession, path)
