import math
import random
import re
from collections import Counter

import pytest

from sluicegate.llm import reversed_search
from sluicegate.llm.reversed_search import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
DOC, ITEM = "doc_id long, text string, score string", "item_id long, text string, rank string"


def terms(text):
    return [t.translate(str.maketrans(LETTERS)) for t in TERM.findall(text or "")]


def plain(docs, items, top=20):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, length = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    wanted = {}
    for item, text in set(items):
        wanted.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scored = []
        for doc, c, n in counts:
            m = 100 - 25 + (25 * n * n_docs) // length
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, times in own.items()
                if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, unnamed, doc) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if unnamed else doc, -score))
    return sorted(out, key=repr)


def got(spark, docs, items, top=20):
    one = spark.createDataFrame([(*d, "x") for d in docs], DOC)
    other = spark.createDataFrame([(*i, "y") for i in items], ITEM)
    return sorted((tuple(r) for r in search(one, other, top).collect()), key=repr)


def chance_tables(seed, vocabulary, docs=200, items=15):
    chance = random.Random(seed)
    names = [f"W{i}" for i in range(vocabulary)] + ["É", "é", "x_y", "7"]

    def text(n):
        return "".join(chance.choice(names) + chance.choice([" ", ",", "\n", "\x00"]) for _ in range(n))

    rows = [(i % 150, text(chance.randint(0, 60))) for i in range(docs)]
    return rows + rows[:30], [(i // 2, text(chance.randint(0, 12))) for i in range(items)]


@pytest.mark.parametrize("vocabulary", [2, 30, 3000])
def test_like_brute_force(spark, vocabulary):
    docs, items = chance_tables(vocabulary, vocabulary)
    assert got(spark, docs, items) == plain(docs, items)
    assert got(spark, docs, items, 3) == plain(docs, items, 3)


def test_blocks_and_groups_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(reversed_search, "BLOCK", 200)
    monkeypatch.setattr(reversed_search, "TOGETHER", 40)
    monkeypatch.setattr(reversed_search, "MERGE_GROUPS", 2)
    docs, items = chance_tables(11, 30)
    assert got(spark, docs, items) == plain(docs, items)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "?!"), (None, "alpha beta"), (5, "alpha beta"), (5, "alpha beta"), (4, "Alpha beta"), (6, "gamma " * 50_000)]
    items = [(1, "alpha"), (1, "alpha"), (1, "beta alpha"), (2, None), (3, ""), (4, "unseen"), (None, "ALPHA gamma"), (7, "beta " * 3000)]
    assert got(spark, docs, items) == plain(docs, items)
    assert got(spark, [], items) == [] and got(spark, docs, []) == []
    assert got(spark, docs[:3], items) == []


def test_many_equal_documents(spark):
    docs = [(i, "one two three" if i < 3000 else "five six") for i in range(6000)] + [(-1, "four")]
    found = got(spark, docs, [(1, "two"), (2, "four two")])
    assert [d for i, _, d, _ in sorted(found) if i == 1] == list(range(20))
    assert found == plain(docs, [(1, "two"), (2, "four two")])
