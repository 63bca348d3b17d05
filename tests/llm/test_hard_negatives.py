import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicegate.llm import hard_negatives
from sluicegate.llm.hard_negatives import feasible, mine

SCHEMA = "vec_id long, embedding array<double>, label int, score string"


def plain(rows, share=(30, 90)):
    taken = []
    for vec_id, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            taken.append((vec_id, [math.floor(256 * x) for x in vector], label))

    def scored(anchor, same):
        others = []
        for number, (vec_id, vector, label) in enumerate(taken):
            if number != anchor and len(vector) == len(taken[anchor][1]) and (label == taken[anchor][2]) == same:
                score = sum(a * b for a, b in zip(taken[anchor][1], vector))
                others.append((-min(max(score, -(2**63)), 2**63 - 1), vec_id is None, vec_id or 0))
        return [(None if unnamed else vec_id, -score) for score, unnamed, vec_id in sorted(others)]

    out = []
    for number, (vec_id, _, _) in enumerate(taken):
        if vec_id is None or vec_id % 100:
            continue
        others = scored(number, False)
        for positive, p in scored(number, True)[:5]:
            fitting = [(i, s) for i, s in others if share[0] * p <= 100 * s <= share[1] * p][:10]
            out += [(vec_id, positive, rank, i, p, s) for rank, (i, s) in enumerate(fitting, 1)]
    return sorted(out, key=repr)


def got(spark, rows):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in mine(frame, F.col("vec_id") % 100 == 0).collect()), key=repr)


def test_ranges_hold_all_feasible_values():
    chance = np.random.default_rng(1)
    units = chance.normal(size=(4000, 5))
    units /= np.linalg.norm(units, axis=1)[:, None]
    for anchor in units[:40]:
        for least in (-0.5, 0.0, 0.3, 0.8, 0.99, 1.0):
            near = units[units @ anchor >= least]
            for f in range(5):
                low, high = feasible(float(anchor[f]), least)
                assert (near[:, f] >= low).all() and (near[:, f] <= high).all()
    assert feasible(1.0, 0.5) == pytest.approx((0.5, 1.0)) and feasible(0.0, 1.0) == pytest.approx((0.0, 0.0), abs=1e-8)


@pytest.mark.parametrize("shape", ["lengths", "near", "few values"])
def test_like_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 37)
    monkeypatch.setattr(hard_negatives, "BLOCK", 1500)
    chance = np.random.default_rng(len(shape))
    vectors = chance.normal(size=(900, 6))
    if shape == "lengths":
        vectors *= np.exp(chance.normal(size=900) * 2)[:, None]
    elif shape == "near":
        vectors = vectors[chance.integers(0, 30, 900)] + chance.normal(size=(900, 6)) * 0.05
    else:
        vectors = np.round(vectors) / 256
    labels = chance.integers(0, 4, 900).tolist()
    ids = (chance.permutation(900) * 10).tolist()
    rows = [(i, v, None if l == 3 and i % 3 == 0 else l) for i, v, l in zip(ids, vectors.tolist(), labels)]
    rows += rows[:40]
    assert got(spark, rows) == plain(rows)


def test_pruning_keeps_few_rows_of_a_bucket():
    chance = np.random.default_rng(2)
    matrix = chance.normal(size=(500, 3)) * 100
    matrix[:5] = matrix[0] + chance.normal(size=(5, 3))
    rows = [(n, n, 1, 3, float(np.linalg.norm(v)), np.floor(v).tobytes()) for n, v in enumerate(matrix)]
    names = [f.name for f in hard_negatives._BUCKET.fields]
    bucket = hard_negatives.Bucket(dict(zip(names, hard_negatives._bucket(rows))))
    anchor = hard_negatives.Anchor.of(
        type("R", (), {"row": 0, "vec_id": 0, "label": 1, "length": rows[0][4], "vector": rows[0][5]})
    )
    everything = bucket.scores(anchor, np.arange(500))
    for least in (1, 1000, int(everything.max()), int(everything.max()) + 1):
        left = bucket.within(anchor, least)
        assert set(np.flatnonzero(everything >= least).tolist()) <= set(left.tolist())
    assert len(bucket.within(anchor, int(np.sort(everything)[-5]))) < 250
    assert len(bucket.within(anchor, 10**9)) == 0


def test_odd_rows(spark):
    nan, inf, huge = float("nan"), float("inf"), 1e17
    rows = [
        (0, [1.0, 2.0], 1), (1, [1.0, 1.9], 1), (2, [0.5, 0.9], 2), (3, [0.5, 0.9], 2), (4, None, 1), (5, [1.0, 2.0], None),
        (6, [nan, 1.0], 2), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (100, [], 1), (10, [], 2), (11, [1.0], 2),
        (None, [0.5, 0.8], 2), (None, [1.0, 2.1], 1), (200, [-1.0, -2.0], 1), (300, [0.0, 0.0], 1), (300, [0.0, 0.0], 1),
        (400, [huge, 1.0, 0.0], 1), (12, [huge, 2.0, 0.0], 1), (13, [1.0, huge, 5.0], 2), (0, [1.0, 2.0], 2), (0, [1.0, 2.0], 1),
    ]
    assert got(spark, rows) == plain(rows)
    assert got(spark, []) == [] and got(spark, rows[1:4]) == [] and got(spark, rows[:1]) == []


def test_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 64)
    rows = [(i, [0.5, 0.25], i % 3) for i in range(1000)] + [(-i, [0.3, 0.2], 1) for i in range(1, 40)]
    assert got(spark, rows) == plain(rows)
