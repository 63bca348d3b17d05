import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluicegate.llm import token_files
from sluicegate.llm.library_bpe import library_encoder
from sluicegate.llm.simple8b import pack, unpack

ODD = [
    None, "", " ", "a", "  two  blanks \n\n and\tlines \n", "don't I'LL 'TIS we've!!! (x) ***", "Straße İstanbul ΑΣ Σ.",
    "naïve café ǆ漢字かな עברית ١٢٣ 🙂👩‍👩‍👧 é ​ x", "\x1c y \x85z 　w q", "É. ǅ! µm, ÿ;", "<|endoftext|> <|startoftext|>",
    "x" * 3000, "ab" * 500 + " " * 70 + "end", "a.b,c 'd' e's", "é́! ñ̃. a ́b",
]


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunks_give_the_ids_of_the_whole_text(spark, name, spaced):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    mine = library_encoder(path, spaced)
    for text in [*ODD, *texts]:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids)}I", mine.encode(text or ""))) == ids, text[:100]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_packing_round_trip(values):
    array = np.array(values, dtype=np.uint64)
    assert unpack(pack(array)).tolist() == values


def test_packing_is_dense():
    assert len(pack(np.zeros(480, np.uint64))) == 2
    assert len(pack(np.ones(60, np.uint64))) == 1
    assert len(pack(np.full(9, 2**20 - 1, np.uint64))) == 3
    assert pack(np.array([2**63 + 5], np.uint64)).tolist() == [0, 2**63 + 5]


def test_files_hold_every_document_in_order(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 300)
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [(i, t, "x") for i, t in enumerate(ODD, 10_000)] + [(None, "no key", "x"), (7, "again", "x"), (7, "again", "x")]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, start string").drop("start"))
    rows = token_files.token_files(docs, lambda: library_encoder(path, True).encode, 2).collect()
    assert len(rows) == docs.count()
    at = 0
    for row in sorted(rows, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    keys = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k)
    encode = library_encoder(path, True).encode
    wanted = sorted((r.doc_id or -1, zlib.crc32(encode(r.text or "") + struct.pack("<I", 2))) for r in docs.collect())
    assert sorted((r.doc_id or -1, r.ids_crc32) for r in rows) == wanted
    assert token_files.token_files(docs.limit(0), lambda: encode, 2).collect() == []
