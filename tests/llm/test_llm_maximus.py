"""Hard negatives: brute force, certified termination, odd rows."""

import math

import numpy as np
import pytest

from cartwheel.llm import maximus

SCHEMA = "vec_id long, embedding array<float>, label int, score double, row string, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, la, 0.5, "x", 7) for i, v, la in rows], SCHEMA)


def brute(rows, is_anchor, k=5):
    """(anchor, positive, rank, negative, positive score, negative score) from all pairs."""
    whole = {(i, la, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, la in rows
             if None not in (i, v, la) and all(x is not None and math.isfinite(x) for x in v)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, la, v in whole:
        if not is_anchor(i):
            continue
        others = sorted(((dot(v, w), j, lb) for j, lb, w in whole if j != i), key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [o for o in others if o[2] == la][:k]:
            near = [o for o in others if o[2] != la and 80 * p <= 100 * o[0] <= 100 * p][:k]
            out.extend((i, pid, r + 1, n[1], p, n[0]) for r, n in enumerate(near))
    return sorted(out)


def mined(spark, rows, is_anchor):
    part = maximus.takes_part(frame(spark, rows))
    got = maximus.hard_negatives(part, part.filter(is_anchor))
    return sorted(tuple(r) for r in got.collect())


def vectors(seed, n, dim=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    return [(i, (centres[rng.integers(5)] + 0.4 * rng.normal(size=dim)).astype(np.float32).tolist(), int(rng.integers(labels))) for i in range(n)]


def test_matches_brute_force_over_shards(spark, monkeypatch):
    monkeypatch.setattr(maximus, "SHARD", 40)
    rows = vectors(1, 300)
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(40)]                   # ties
    rows += [(2000 + k, [0.0] * 12, k % 4) for k in range(6)]                         # zero vectors
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 300 and mined(spark, rows, "vec_id % 10 = 0") == want


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.9, 0.5], 2), (2, [0.9, 0.5], 2), (3, [0.9], 2), (4, [], 1), (5, None, 1),
            (6, [1.0, None], 2), (7, [float("nan"), 1.0], 2), (8, [float("inf"), 1.0], 2), (None, [1.0, 1.0], 2), (9, [1.0, 1.0], None),
            (10, [-1.0, -0.5], 1), (12, [0.9, 0.5, 3.0, 1.0], 2), (0, [0.2, 0.1], 2)]
    want = brute(rows, lambda i: i % 2 == 0)
    assert want and mined(spark, rows, "vec_id % 2 = 0") == want
    got = maximus.hard_negatives(*[maximus.takes_part(frame(spark, []))] * 2)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and got.count() == 0


@pytest.mark.parametrize("scale", [1, 10 ** 9])
def test_walk_is_exact_and_stops(scale):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    near = (centre + 0.2 * rng.normal(size=(20, 16)))
    far = rng.normal(size=(12_000, 16))
    x = np.floor(256 * np.concatenate((far, centre + 0.3 * rng.normal(size=(400, 16))))).astype(np.int64) * scale
    q = np.floor(256 * near).astype(np.int64) * scale
    unit = maximus.directions(q.sum(axis=0, keepdims=True).astype(float))[0]
    order, bound = maximus.shared_list(x, unit, maximus.angles(q, unit).max() + 1e-7)
    rows, exact = maximus._exact(x[order], q)
    scores = x.astype(object) @ q.astype(object).T
    assert (np.asarray(scores[order], float) <= bound[:, None] * np.sqrt((q.astype(float) ** 2).sum(axis=1)) * (1 + 1e-9)).all()
    windows = []
    for i in range(len(q)):
        p = int(sorted(scores[:, i].tolist())[-50])
        windows.append([(-math.inf, math.inf), (-(-80 * p // 100), p)])
    found, scored = maximus.walk(exact, np.full(len(q), -1), windows, rows, order, bound)
    assert scored < len(x) * len(q) / 2  # the rest of the list is certified not to matter
    for i in range(len(q)):
        ranked = sorted(((int(s), j) for j, s in enumerate(scores[:, i])), key=lambda f: (-f[0], f[1]))
        for w, (low, high) in enumerate(windows[i]):
            assert found[i][w] == [r for r in ranked if low <= r[0] <= high][:5]


def test_query_matches_brute_force(spark):
    from cartwheel.llm.queries import QUERIES
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, "/root/testdata/sf0.001").collect())
    assert got == brute(rows, lambda i: i % 100 == 0)
