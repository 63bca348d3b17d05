"""Fingerprints and their likeness against versions in plain Python."""

import random
import struct
from collections import Counter

import pytest

from sluicegate.llm.syncmers import ANCHORS, DRIFT, K, S, fingerprint, fingerprint_documents, likeness

WORD = (1 << 64) - 1
BASE, MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def hashed(part):
    value = 0
    for c in part:
        value = (value * BASE + ord(c) + 1) & WORD
    value ^= value >> 31
    value = (value * MIX) & WORD
    return value ^ (value >> 29)


def plain_fingerprint(text):
    first = {}
    for i in range(len(text) - K + 1):
        inner = [hashed(text[j : j + S]) for j in range(i, i + K - S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            first.setdefault(hashed(text[i : i + K]) >> 32, i)
    if not first and text:
        first = {hashed(text) >> 32: 0}
    return b"".join(struct.pack(">II", h, first[h]) for h in sorted(first)[:ANCHORS]).hex()


def plain_likeness(one, other):
    def read(x):
        data = bytes.fromhex(x)
        return [struct.unpack(">II", data[i : i + 8]) for i in range(0, len(data), 8)]

    if one == other:
        return 1.0
    a, b = read(one), read(other)
    if not a or not b:
        return 0.0
    known = min([x[-1][0] for x in (a, b) if len(x) == ANCHORS], default=1 << 32)
    a, b = ({h: p for h, p in x if h <= known} for x in (a, b))
    shifts = [b[h] - a[h] for h in a.keys() & b.keys()]
    if not shifts:
        return 0.0
    usual = min(Counter(shifts).items(), key=lambda x: (-x[1], abs(x[0]), x[0]))[0]
    return 2.0 * sum(abs(s - usual) <= DRIFT for s in shifts) / (len(a) + len(b))


def texts():
    chance = random.Random(17)
    base = "".join(chance.choices("abcdefgh é漢🙂\n", k=1500))
    made = ["", "x", "short text", base[:19], base[:20], base[:21], base, base[::-1], base[700:] + base[:700], base + base, "ab" * 400, "z" * 900]
    for _ in range(12):
        cut = chance.randrange(1500)
        made.append(base[:cut] + "".join(chance.choices("qrs ", k=chance.randrange(60))) + base[cut + chance.randrange(40) :])
    return made


def test_fingerprints_of_all_kinds_of_texts():
    for text in texts():
        assert fingerprint(text) == plain_fingerprint(text), text[:40]


def test_likeness_of_all_pairs():
    made = [fingerprint(text) for text in texts()]
    for one in made:
        for other in made:
            assert likeness(one, other) == pytest.approx(plain_likeness(one, other))


def test_the_query_over_documents(spark):
    """Rows of the whole operator for a table with nulls, repeats and rows without doc_id."""
    given = [(i * 3, text) for i, text in enumerate(texts())] + [(500, None), (501, "")]
    rows = spark.createDataFrame(given, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint_documents(rows.repartition(5)).collect()}
    plain = [(d, t or "") for d, t in sorted(given)]
    for (doc_id, text), (_, following) in zip(plain, plain[1:] + plain[:1]):
        half = len(text) // 2
        own, edited = plain_fingerprint(text), plain_fingerprint(text[: len(text) - half] + following[:half])
        row = got[doc_id]
        assert (row.fingerprint, row.edited_fingerprint) == (own, edited)
        assert row.near_edited == pytest.approx(plain_likeness(own, edited))
        assert row.near_next == pytest.approx(plain_likeness(own, plain_fingerprint(following)))
