"""The whole operator against a version without Spark, and what the pipeline's stage drops."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluicegate.llm import language


def plain(rows):
    """Language and score of each text, learned from all labelled rows that are not held out."""
    held = [zlib.crc32(str(d).encode()) % 4 == 2 for d, _, _ in rows]
    counts = defaultdict(lambda: defaultdict(Counter))
    sizes = Counter()

    def cut(text):
        return [w for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if w.isalpha()]

    def parts(word, n):
        wide = f" {word} " if n > 1 else word
        return [wide[i : i + n] for i in range(len(wide) - n + 1)]

    for (doc_id, text, lang), out in zip(rows, held):
        if text is not None and lang is not None and not out:
            sizes[lang] += 1
            for word in cut(text):
                counts[0][lang][word] += 1
                for n in (1, 2, 3, 4):
                    counts[n][lang].update(parts(word, n))
    langs = sorted(sizes)
    score = {
        n: {lang: {g: -math.log10(c / sum(own.values())) for g, c in own.items()} for lang, own in by.items()} for n, by in counts.items()
    }

    def of(n, gram):
        return [score[n].get(lang, {}).get(gram, 7.0) for lang in langs] if any(gram in score[n].get(lang, {}) for lang in langs) else None

    def word_scores(word):
        if of(0, word):
            return of(0, word)
        for n in (4, 3, 2, 1):
            found = [s for s in (of(n, g) for g in parts(word, n)) if s]
            if found:
                return [sum(s[i] for s in found) / len(found) for i in range(len(langs))]
        return None

    out = []
    for doc_id, text, _ in rows:
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        found = [s for s in (word_scores(w) for w in words if w.isalpha()) if s]
        if not found:
            out.append((min(langs, key=lambda x: (-sizes[x], x)) if any(map(str.isalpha, text or "")) else "und", 0.0))
            continue
        mean = [sum(s[i] for s in found) / len(found) for i in range(len(langs))]
        best = min(range(len(langs)), key=lambda i: mean[i])
        out.append((langs[best], 1 / sum(10 ** (mean[best] - m) for m in mean)))
    return out


def test_like_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = [(70_001, "Слово", None), (70_002, "x", "en"), (70_003, None, "en"), (70_004, "123", None), (70_005, "word " * 40_000 + "é" * 9, None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    rows = [tuple(r) for r in docs.collect()]
    wanted = {d: w for (d, _, _), w in zip(rows, plain(rows))}
    whole = language.predict(docs, language.fit(docs, kept=10**9)).collect()
    assert {r.doc_id: r.lang_pred for r in whole} == {d: w[0] for d, w in wanted.items()}
    worst = max(abs(r.score - wanted[r.doc_id][1]) for r in whole)
    assert worst < 1e-4, worst
    # The entries that the shipped model leaves out don't change a language.
    assert {r.doc_id: r.lang_pred for r in language.identify(docs).collect()} == {d: w[0] for d, w in wanted.items()}


def test_clean_documents_stay_whatever_the_number_of_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    strange = [(80_001, "Все люди рождаются свободными и равными", None, "s", 1), (80_002, "人人生而自由", None, "s", 1), (80_003, "?? 12", None, "s", 1)]
    for langs in (["en"], ["en", "de"], ["en", "de", "fr"], ["en", "de", "fr", "es"]):
        some = docs.where(F.col("lang").isin(langs))
        left = language.in_known_languages(some.unionByName(spark.createDataFrame(strange, docs.schema)))
        total = some.where("text rlike '[[:alpha:]]'").count()
        assert left.count() >= 0.999 * total and left.where("doc_id > 80000").count() == 0


def test_limits():
    assert language.least_score(4) == language.LEAST_SCORE == 0.3 and language.least_score(2) == 0.6
    one = language.Scorer(language.Model.of(("a",), [(0, "the", "a", 1.0)], "a"))
    assert one.knows("the") and not one.knows("qq") and not one.knows("the qq zz") and not one.knows(None)
