"""The index without a floor: recall and visited share as shipped, and the exact answer by parameter."""

import numpy as np
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from sluicegate.llm import multi_index
from sluicegate.llm.multi_index import centroids_for, fit, search
from sluicegate.llm.queries import ENTRIES
from sluicegate.llm.sql import NEAREST_SQL

TABLE = "/root/testdata/sf0.1/embeddings.parquet"


def test_recall_as_shipped(spark):
    given = spark.read.parquet(TABLE)
    rows = given.orderBy("vec_id").collect()
    vectors = np.array([r.embedding for r in rows], dtype=np.float64)
    found = {}
    for r in ENTRIES["op10_nearest_neighbours"].run(spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for query in found:
        scores = vectors @ vectors[query]
        scores[query] = -np.inf
        hits += len(found[query] & set(np.argsort(-scores, kind="stable")[:20].tolist()))
    recall = hits / (20 * len(found))
    share = fit(vectors, centroids_for(len(vectors))).share
    print(f"recall {recall:.3f}, share {share:.3f}")
    assert recall >= 0.92 and share < 0.75


def test_a_share_of_one_is_exact(spark):
    def run(session, sf_dir):
        return search(session.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, share=1.0)

    for sf in ("sf0.001", "sf0.1"):
        assert differences(spark, connect(f"/root/testdata/{sf}"), "exact", run, NEAREST_SQL, f"/root/testdata/{sf}") is None


def test_no_size_changes_the_way(spark):
    """A table of any size visits the fitted share; there is no floor that makes small ones exact."""
    assert multi_index.LEAST_ENTRIES <= 100 and centroids_for(2000) == 16 and centroids_for(10**12) == 256 and centroids_for(51_000) == 45


def brute(rows, top=20):
    kept = sorted({(i, tuple(v)) for i, v in rows})
    out = []
    for query, vector in kept:
        if query % 20 == 0:
            scored = [(-sum(a * b for a, b in zip(vector, v)), i) for i, v in kept if (i, v) != (query, vector) and len(v) == len(vector)]
            out += [(query, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def test_repeated_ids_and_several_lengths(spark):
    """Every different row is a candidate, and queries meet rows of their own length."""
    chance = np.random.default_rng(5)
    rows = [(i % 90, [float(x) for x in chance.integers(-9, 10, int(chance.choice([1, 2, 5])))]) for i in range(300)]
    rows = [(i, v) for i, v in rows if any(v)] + [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [9.0, 9.0]), (1, [8.0, 9.0])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, row string, dim int")
    got = sorted(tuple(r) for r in search(frame, F.col("vec_id") % 20 == 0, share=1.0).collect())
    assert got == brute(rows)
    some = search(frame, F.col("vec_id") % 20 == 0).collect()
    assert {r.query_id for r in some} == {q for q, *_ in got}


def test_the_sample_is_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "SAMPLE_BYTES", 40_000)
    rows = multi_index.usable(spark.read.parquet(TABLE))
    drawn = multi_index._sampled(rows, {64: 2000})
    assert 20 < len(drawn[64]) < 200 and drawn[64].shape[1] == 64
    monkeypatch.setattr(multi_index, "SAMPLE_BYTES", 1)
    frame = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "vec_id long, embedding array<double>")
    got = search(frame, F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in got] == list(range(1, 21)) and pytest.approx(1.0) == got[0].score
