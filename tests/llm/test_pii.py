import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicegate.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(found):
    digits = [int(d) for d in found if d.isdigit()][::-1]
    return 12 <= len(digits) <= 19 and sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(digits)) % 10 == 0


def brute(text):
    """The base spans straight from their definition."""
    found = [("email", m) for m in EMAIL.finditer(text)]
    found += [("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m) for m in CARD.finditer(text) if plain_luhn(m[0])]
    found += [("phone", m) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    order = pii.BASE_KINDS.index
    return sorted(((k, m.start(), m.end()) for k, m in found), key=lambda s: (s[1], order(s[0])))


def base(text):
    return [(s.kind, s.start, s.end) for s in pii.find_spans(text) if s.kind in pii.BASE_KINDS]


CASES = [
    "write to a.b@c.example.org, or x@y, or a@b.c_x@d.e@f.g",
    "@@a@b.com@d.org a@@b.c",
    "at 10.0.0.1 not 256.1.1.1, 1.2.3.4.5.6.7.8 and 0000255.1.1.001",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112, 41111111111111111",
    "+49 (30) 123-456-78 and +1 2 or +123456789012345678",
    "🙂 Ünïcode +44 20 7946 0958 é a@b.de",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2 3",
    "",
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans(text):
    assert base(text) == brute(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@._-+() 0123456789é", max_size=60))
def test_base_spans_of_any_text(text):
    assert base(text) == brute(text)


def test_added_kinds():
    found = pii.find_spans("IBAN DE89 3704 0044 0532 0130 00, DE88 3704 0044 0532 0130 00; SSN 123-45-6789, part 123-45-6789")
    assert [(s.kind, s.start, s.end) for s in found if s.kind == "iban"] == [("iban", 5, 32)]
    assert any(s.kind == "ssn" for s in found)
    assert not pii.find_spans("part number 123-45-6789 of the list")
    near, far = pii.find_spans("phone: +49 30 1234567")[0], pii.find_spans("so +49 30 1234567")[0]
    assert near.score > far.score


def test_long_texts_are_quick():
    text = "1" * 300_000 + " " + "a" * 300_000 + "@ " + "a.b@" * 20_000 + "1.1." * 50_000
    assert [s for s in base(text) if s[0] == "card"] == []


def test_queries(spark):
    rows = [(1, "a@b.de, x", "k"), (1, "a@b.de, x", "k"), (2, None, "k"), (3, "", "k"), (None, "+49 30 1234567", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    got = {(r.doc_id, r.n_email, r.n_phone, r.spans) for r in pii.summarise(docs).collect()}
    assert got == {(1, 1, 0, "email:0:6"), (2, 0, 0, ""), (3, 0, 0, ""), (None, 0, 1, "phone:0:14")}
    assert pii.summarise(docs).where("doc_id = 2").first().base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.summarise(docs).count() == 5
    assert pii.detect(docs).count() == 3
    assert pii.detect(docs.limit(0)).count() == 0


def test_given_documents_match_the_definition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for row, text in zip(
        pii.summarise(docs).orderBy("doc_id").collect(), [r.text for r in docs.orderBy("doc_id").collect()]
    ):
        joined = ",".join("%s:%d:%d" % s for s in brute(text))
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_redacting_keeps_the_columns(spark):
    rows = [(1, "mail a@b.de now", "en", 15), (2, None, "en", None), (3, "clean", "en", 99)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    got = pii.redact(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(1, "mail <EMAIL> now", "en", 16), (2, None, "en", None), (3, "clean", "en", 99)]
    assert pii.masked("+49 30 1234567; 4111 1111 1111 1111 x") == "<PHONE>; <CARD> x"
