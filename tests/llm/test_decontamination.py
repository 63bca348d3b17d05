import hashlib
import random
import re

import pytest

from sluicegate.llm import decontamination
from sluicegate.llm.decontamination import summarise, without_documents, without_spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC, ITEM = "doc_id long, text string", "item_id long, text string"
LETTERS = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def split(text):
    return WORD.findall((text or "").translate(str.maketrans(LETTERS)))


def plain(docs, items):
    windows = {}
    for item, text in items:
        own = split(text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(item)
    out = []
    for doc_id, text in docs:
        own, hit, found = split(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                held = windows.get(tuple(own[i : i + size]))
                if held:
                    hit |= set(range(i, i + size))
                    found |= held
        ids = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


def got(spark, docs, items):
    found = summarise(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def chance_tables(seed, vocabulary, docs=120, items=25):
    chance = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)] + ["É", "ñandú", "7"]
    gaps = [" ", ", ", "\n", "--", "\x00", "é ".strip() + " "]

    def text(n):
        return "".join(chance.choice(names) + chance.choice(gaps) for _ in range(n))

    held = [(chance.choice([i, i // 2, None]), text(chance.choice([0, 1, 4, 9, 10, 11, 30]))) for i in range(items)]
    rows = []
    for i in range(docs):
        parts = [text(chance.randint(0, 30)) for _ in range(2)]
        if chance.random() < 0.5:
            parts.insert(1, chance.choice(held)[1].upper().replace("É", "é"))
        rows.append((i // 2, " ".join(parts)))
    return rows, held


@pytest.mark.parametrize("vocabulary", [3, 40, 5000])
def test_like_brute_force(spark, vocabulary):
    docs, items = chance_tables(vocabulary, vocabulary)
    assert got(spark, docs, items) == plain(docs, items)


def test_blocks_and_pieces_change_nothing(spark, monkeypatch):
    docs, items = chance_tables(5, 30)
    docs.append((999, items[-1][1] * 3))
    items.append((77, " ".join(f"w{i % 29}" for i in range(200))))
    docs.append((998, "x " + items[-1][1][40:300] + " y"))
    monkeypatch.setattr(decontamination, "BLOCK", 500)
    monkeypatch.setattr(decontamination, "PIECE", 7)
    assert got(spark, docs, items) == plain(docs, items)


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    # A hash that looks at the last word only: every hit must be verified.
    monkeypatch.setattr(
        decontamination, "rolled", lambda ids, length: ids[length - 1 :].astype("uint64") << decontamination.np.uint64(50)
    )
    docs, items = chance_tables(9, 4)
    windows = decontamination.Windows([(i, b" ".join(w.encode() for w in split(t))) for i, t in items if split(t)])
    rows = windows.mark([(t or "").encode() for _, t in docs])
    marked = [(d, n, sum(e - s for s, e in hits), len(set(own))) for (d, _), (n, hits, own) in zip(docs, rows)]
    assert sorted(marked) == sorted((d, n, h, k) for d, n, h, k, _, _ in plain(docs, items))


def test_odd_rows(spark):
    ten = "one two three four five six seven eight nine ten"
    docs = [(1, None), (2, ""), (3, "?!"), (None, ten), (5, ten), (5, ten), (6, ten[4:]), (7, "short one"), (8, "SHORT,one two")]
    items = [(1, ten), (1, ten), (2, None), (3, ""), (4, "..."), (None, "two three"), (10, "Short ONE"), (9, ten + " x")]
    assert got(spark, docs, items) == plain(docs, items)
    none = [(d, n, 0, 0, hashlib.sha256(b"").hexdigest(), False) for d, n, *_ in plain(docs, items)]
    assert got(spark, docs, []) == none and got(spark, [], items) == []


def test_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr("sluicegate.llm.words.SPAN", 1000)
    long = " ".join(f"a{i}" for i in range(200_000))
    items = [(1, long[500_000:500_200]), (2, " ".join(f"b{i}" for i in range(20_000)))]
    docs = [(1, long), (2, items[1][1][100:]), (3, "x" * 3_000_000)]
    assert got(spark, docs, items) == plain(docs, items)


def test_removal_keeps_columns_and_the_rest_of_the_text(spark):
    ten = "one two three four five six seven eight nine ten"
    rows = [(1, f"Before, {ten.upper()}! After.", 5, "a"), (2, None, None, "b"), (3, "clean é text", 12, None), (4, ten, 48, "d")]
    schema = "doc_id long, text string, n_chars int, hits string"
    docs, items = spark.createDataFrame(rows, schema), spark.createDataFrame([(1, ten)], ITEM)
    cut = without_spans(docs, items)
    assert cut.schema.simpleString() == docs.schema.simpleString()
    left = sorted((tuple(r) for r in cut.collect()), key=repr)
    assert left == [(1, "Before, ! After.", 16, "a"), (2, None, None, "b"), (3, "clean é text", 12, None), (4, "", 0, "d")]
    kept = without_documents(docs, items)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == [rows[1], rows[2]]
    again = without_spans(docs.drop("n_chars"), items)
    assert again.columns == ["doc_id", "text", "hits"] and again.count() == 4
