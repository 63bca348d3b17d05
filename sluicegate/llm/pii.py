"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Kinds and what confirms them: email (pattern), ip (each part at most 255), card (12 to 19 digits, Luhn),
phone (9 to 15 digits), iban (mod 97), ssn (three groups of digits that may be assigned; pattern alone is
weak, so a word of context is needed). All scans are linear in the text, and positions are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluicegate.llm.rows import map_batches, map_rows

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
# How sure a confirmed span is without context, what a context word adds, and what a span needs to count.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT_GAIN, LEAST_SCORE, CONTEXT_CHARS = 0.3, 0.5, 40
# Words that speak for a kind when they stand near a span.
CONTEXT = {
    "email": ("mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "tax id", "taxpayer"),
}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits can only match where the start of the run matches; looking back keeps
# the scan of long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_DIGITS = re.compile(r"[0-9]")
_NEAR = {kind: re.compile(r"\b(?:" + "|".join(map(re.escape, words)) + ")", re.IGNORECASE) for kind, words in CONTEXT.items()}


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain: the local part is the run of its characters before an @."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        floor = domain.end() if domain else at + 1
        if domain:
            yield start, floor
        at = text.find("@", floor)


def _confirmed(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found.split("."))
    if kind == "iban":
        plain = found.replace(" ", "")
        return 15 <= len(plain) <= 34 and mod97(plain)
    if kind == "card":
        digits = found.replace(" ", "").replace("-", "")
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_DIGITS.findall(found)) <= 15
    return True


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end
    if _DIGITS.search(text):
        patterns = {"ip": _IP, "card": _CARD, "iban": _IBAN, "ssn": _SSN}
        if "+" in text:
            patterns["phone"] = _PHONE
        for kind, pattern in patterns.items():
            for match in pattern.finditer(text):
                yield kind, match.start(), match.end()


def find_spans(text: str | None) -> list[Span]:
    """Confirmed spans by start, then kind. Kinds may overlap one another; an empty or null text has none."""
    spans = []
    for kind, start, end in _proposed(text or ""):
        if _confirmed(kind, text[start:end]):
            near = text[max(0, start - CONTEXT_CHARS) : start] + "\n" + text[end : end + CONTEXT_CHARS]
            score = min(1.0, SCORES[kind] + (CONTEXT_GAIN if _NEAR[kind].search(near) else 0.0))
            if score >= LEAST_SCORE:
                spans.append(Span(kind, start, end, score))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


def masked(text: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first names it."""
    spans = find_spans(text)
    if not spans:
        return text
    parts, at, end = [], 0, 0
    for span in spans:
        if span.start >= end:
            parts += [text[max(at, end) : span.start], f"<{span.kind.upper()}>"]
            at = span.end
        end = max(end, span.end)
    return "".join(parts) + text[end:]


FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def detect(docs: DataFrame) -> DataFrame:
    """One row per span. Null and empty texts give none; repeated rows give theirs again."""

    def rule(keys: list, texts: list) -> Iterator[tuple]:
        for key, text in zip(keys, texts):
            for s in find_spans(text):
                yield key, s.kind, s.start, s.end, s.score

    return map_rows(docs, ("doc_id", "text"), rule, FOUND)


COUNTED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *(T.StructField(f"n_{kind}", T.LongType()) for kind in BASE_KINDS),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def summarise(docs: DataFrame) -> DataFrame:
    """One row per document: spans of each base kind, a digest of the base spans, and all spans."""

    def rule(keys: list, texts: list) -> Iterator[tuple]:
        for key, text in zip(keys, texts):
            spans = find_spans(text)
            base = [s for s in spans if s.kind in BASE_KINDS]
            counts = [sum(s.kind == kind for s in base) for kind in BASE_KINDS]
            yield key, *counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)

    return map_rows(docs, ("doc_id", "text"), rule, COUNTED)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with ``masked`` texts; n_chars follows where a text changed, other columns stay."""

    def change(batch: pa.RecordBatch) -> pa.RecordBatch:
        before = batch.column("text").to_pylist()
        after = [masked(text) for text in before]
        columns, schema = list(batch.columns), batch.schema
        columns[schema.get_field_index("text")] = pa.array(after, schema.field("text").type)
        counts = schema.get_field_index("n_chars")
        if counts >= 0:
            known = columns[counts].to_pylist()
            n_chars = [k if a == b else len(a) for a, b, k in zip(after, before, known)]
            columns[counts] = pa.array(n_chars, schema.field(counts).type)
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    return map_batches(docs, change)
