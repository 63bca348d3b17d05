import hashlib
import random

import numpy as np

from sluicegate.llm import syncmers
from sluicegate.llm.syncmers import K, S, anchors, fingerprint, fingerprint_documents, likeness

TEXT = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz ", k=3000))


def test_anchors_are_those_with_the_least_inner_part_at_an_edge():
    text = TEXT[:400] + "é漢🙂" + TEXT[500:700]
    with np.errstate(over="ignore"):
        codes = np.array([ord(c) for c in text], dtype=np.uint64)
        inner = syncmers._rolled(codes, S).tolist()
    wanted = []
    for i in range(len(text) - K + 1):
        own = inner[i : i + K - S + 1]
        if min(own) in (own[0], own[-1]):
            wanted.append(i)
    assert anchors(text)[1].tolist() == wanted


def test_anchors_do_not_depend_on_what_surrounds_them(monkeypatch):
    whole = dict(zip(*(x.tolist() for x in reversed(anchors(TEXT)))))
    part = dict(zip(*(x.tolist() for x in reversed(anchors(TEXT[700:1500])))))
    assert all(whole[p + 700] == h for p, h in part.items()) and len(part) > 50
    monkeypatch.setattr(syncmers, "WINDOW", 100)
    assert dict(zip(*(x.tolist() for x in reversed(anchors(TEXT))))) == whole


def test_likeness():
    assert likeness(fingerprint(TEXT), fingerprint(TEXT)) == 1.0
    assert likeness("", "") == 1.0 and likeness(fingerprint(TEXT), "") == 0.0
    assert likeness(fingerprint(TEXT), fingerprint(TEXT[::-1])) == 0.0
    assert 0.3 < likeness(fingerprint(TEXT), fingerprint(TEXT[:1500] + TEXT[:1500][::-1])) < 0.7
    assert likeness(fingerprint(TEXT), fingerprint("x" * 40 + TEXT)) > 0.9
    assert fingerprint("abc") != fingerprint("abd") and fingerprint(None) == fingerprint("") == ""
    assert fingerprint("a" * 100_000)


def test_every_document_meets_its_next(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-5, None), (70_000, ""), (70_001, "🙂é" * 30)], "doc_id long, text string"))
    texts = [(r.doc_id, r.text or "") for r in docs.orderBy("doc_id").collect()]
    got = {r.doc_id: r for r in fingerprint_documents(docs.repartition(7)).collect()}
    assert len(got) == len(texts)
    for (doc_id, text), (_, following) in zip(texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = got[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (fingerprint(text), fingerprint(edited))
        assert row.near_next == likeness(fingerprint(text), fingerprint(following))


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, "only", 5)], "doc_id long, text string, bucket int")
    assert fingerprint_documents(frame).first().edited_sha256 == hashlib.sha256(b"onon").hexdigest()
    assert fingerprint_documents(frame.limit(0)).collect() == []
    repeated = spark.createDataFrame([(1, "same text")] * 9 + [(None, "x"), (None, "y")], "doc_id long, text string")
    assert fingerprint_documents(repeated).count() == 11


def test_short_texts_have_anchors_of_their_own():
    chance = random.Random(5)
    for size in range(1, 41):
        texts = {"".join(chance.choices("abcdefghijklmnopqrstuvwxyz é🙂", k=size)) for _ in range(60)}
        made = [fingerprint(text) for text in texts]
        assert all(made) and len(set(made)) == len(texts)
        assert likeness(made[0], fingerprint("")) == 0.0
        assert size < K or likeness(made[0], made[-1]) == 0.0
