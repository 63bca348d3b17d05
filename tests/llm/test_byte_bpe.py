import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from sluicegate.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [
    None,
    "",
    " ",
    "a",
    "  two  blanks \n\n and\tlines \n",
    "don't I'll 'tis we've!!! (x) ***",
    "naïve café ǆ漢字かな עברית ١٢٣ 🙂👩‍👩‍👧 é ​ x",
    "\x1c y \x85z 　w q",
    "x" * 3000,
    "<|endoftext|> <|startoftext|>",
    "ab" * 500 + " " * 70 + "end",
]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_text_as_the_library_encodes_it(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame(list(enumerate(ODD, 10_000)), "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = byte_bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = [int.from_bytes(row.ids[i : i + 4], "little") for i in range(0, len(row.ids), 4)]
        assert ids == library.encode_ordinary(texts[row.doc_id]), texts[row.doc_id][:200]
        assert bytes(row.decoded) == texts[row.doc_id].encode()


def test_digests(spark, library):
    rows = [(1, "some text", "x"), (1, "some text", "x"), (None, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = byte_bpe.encoding_digests(docs, PATH, public_tokenizers.PATTERN).collect()
    ids = library.encode_ordinary("some text")
    data = b"".join(i.to_bytes(4, "little") for i in ids)
    wanted = (1, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(b"some text").hexdigest())
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, got), key=str) == sorted([wanted, wanted, (None, 0, empty, empty)], key=str)
    assert byte_bpe.encoding_digests(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_appends_and_edits_give_the_encoding_of_the_result(library):
    ranks = byte_bpe.Ranks(PATH)
    text = "unbelievable internationalisation of things"
    grown = byte_bpe.PrefixEncoder(ranks)
    for i in range(len(text)):
        grown.append(text[i : i + 1].encode())
        assert grown.ids() == ranks.merged(text[: i + 1].encode())
    grown.replace(3, 10, b"forgett")
    assert grown.ids() == ranks.merged(b"unbforgett" + text[10:].encode())
    assert byte_bpe.PrefixEncoder(ranks).ids() == []


def test_pairs_agree_with_merging():
    ranks, chance = byte_bpe.Ranks(PATH), random.Random(5)
    tokens = list(ranks.standing.values())
    short = [t for t in tokens if t < 3000]
    for _ in range(20_000):
        left, right = chance.choice(tokens if _ % 2 else short), chance.choice(tokens if _ % 3 else short)
        assert ranks.beside[left, right] == (ranks.merged(ranks.token[left] + ranks.token[right]) == [left, right])


def test_chance_texts_of_letters_marks_and_white_space(library):
    chance = random.Random(23)
    mine = byte_bpe.Encoder(PATH, public_tokenizers.PATTERN)
    letters = [chr(c) for c in range(65, 0x250) if chr(c).isalpha()] + list("ẞǅΣα漢あ١²½́")
    gaps = [" ", " ", "  ", "\n", "\n", "\r\n", "\n\n", " \n", "\n ", "\t", " ", "\x1c", "\x85", "　", ""]
    parts = [letters, letters, list("!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"), gaps, gaps, ["don't", "I'LL", "the", "İ", "12", "<|endoftext|>"]]
    for _ in range(40_000):
        text = "".join(chance.choice(chance.choice(parts)) for _ in range(chance.randint(1, 14)))
        ids = mine.encode(text)
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == library.encode_ordinary(text), repr(text)
        assert mine.decode(ids) == text.encode()
