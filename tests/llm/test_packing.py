import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from sluicegate.llm import packing
from sluicegate.llm.library_bpe import library_encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def checked(rows, capacity):
    """Every sequence is gapless from 0 and not too long; returns the number of sequences."""
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_close_to_the_bound(seed):
    chance = random.Random(seed)
    kinds = [lambda: chance.randint(1, 2048), lambda: min(2048, int(chance.lognormvariate(6, 1)) + 1), lambda: chance.choice([1, 700, 1024, 1025])]
    lengths = Counter(kinds[seed % 3]() for _ in range(3000))
    placed, sequences = packing.plan(lengths, 2048)
    ranks = defaultdict(list)
    fill = defaultdict(list)
    for p in placed:
        ranks[p.length] += range(p.first_rank, p.first_rank + p.count)
        for i in range(p.count):
            fill[p.sequence + i // p.per].append((p.offset + i % p.per * p.length, p.length))
    assert {length: sorted(r) for length, r in ranks.items()} == {length: list(range(n)) for length, n in lengths.items()}
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(fill) == sequences
    # First-fit decreasing on the same pieces, as a yardstick.
    gaps = []
    for length in sorted(lengths.elements(), reverse=True):
        for i, gap in enumerate(gaps):
            if gap >= length:
                gaps[i] -= length
                break
        else:
            gaps.append(2048 - length)
    assert sequences <= len(gaps) * 1.002 + 1


def test_pieces_of_every_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [(None, None, 1), (5, "", 1), (5, "", 1), (6, "word " * 5000, 1), (6, "word " * 5000, 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, length int").drop("length"))
    encode = library_encoder(PATH, False).encode
    rows = packing.pack_documents(docs, lambda: library_encoder(PATH, False).encode).collect()
    sequences = checked(rows, 2048)
    wanted = Counter()
    for row in docs.collect():
        ids = encode(row.text or "") + bytes(4)
        for piece, at in enumerate(range(0, len(ids), 8192)):
            own = ids[at : at + 8192]
            wanted[row.doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    assert sequences <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_nothing_to_pack(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, lambda: library_encoder(PATH, False).encode).collect() == []
