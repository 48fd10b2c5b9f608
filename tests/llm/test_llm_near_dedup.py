"""Near-duplicates: bounds of verification tasks, thresholds, ids of any size."""

import tracemalloc

import numpy as np
from test_llm_documents import shingles

from cartwheel.llm import components, minhash


def short_sets(n, size=16):
    """Sets of ``size`` shingles that differ by one from their neighbours of the same ten."""
    sets = [np.arange(size, dtype=np.uint64) + np.uint64(1000 * (k // 10)) for k in range(n)]
    for k in range(n):
        sets[k][0] = 10**9 + k
    return np.concatenate(sets), np.arange(n + 1) * size


def groups_of(ids, edges):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    return {i: find(i) for i in ids}


def test_verification_holds_no_large_matrices():
    n = 5000
    elements, off = short_sets(n)
    ids = list(range(n))
    for side in (np.arange(n) % 2 == 0, np.ones(n, bool)):
        tracemalloc.start()
        edges = minhash.verified(ids, side, elements, off)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert groups_of(ids, edges) == {k: k // 10 * 10 for k in ids}  # 15 of 17 shingles
        assert peak < 400e6, peak  # n x n numbers of 8 bytes are 200 MB, and there were four


def test_blocks_are_bounded_by_documents(spark):
    groups = spark.range(9000).selectExpr("id as node", "0L as component", "16L as n_shingles")
    got = minhash.block_tasks(groups).groupBy("task").count().collect()
    assert max(r["count"] for r in got) < 2.4 * minhash.DOCUMENTS
    pairs = minhash.block_tasks(groups).groupBy("node").count().collect()
    assert len(pairs) == 9000 and {r["count"] for r in pairs} == {5}  # a block meets all five


def test_components_of_large_ids(spark):
    top = (1 << 63) - 1
    edges = [(top - k, top - k - 1) for k in range(12)] + [(-top + 5, -top)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{top - k: top - 12 for k in range(13)}, -top + 5: -top, -top: -top}


def linked(texts, percent):
    sets = [(i, shingles(t)) for i, t in texts]
    return groups_of([i for i, _ in texts], [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k]
                                             if a and b and 100 * len(a & b) >= percent * len(a | b)])


def test_threshold_is_a_parameter(spark):
    """Pairs between 80 and 85 % are linked at 80, and only there."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    near = [f"p{j}" for j in range(60)]
    extra = [(10_000 + k, " ".join(near[:30 + k] + [f"e{k}"] + near[31 + k:])) for k in range(3)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    want = {p: linked(texts + extra, p) for p in (80, 85)}
    assert want[80] != want[85]
    for p in (80, 85):
        assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, p).collect()} == want[p]
        left = [r.doc_id for r in minhash.drop_near_duplicates(docs, p).collect()]
        assert sorted(left) == sorted(i for i, c in want[p].items() if i == c)


def test_bands_follow_the_threshold():
    assert minhash.band_rows(85) == 6 and minhash.band_rows(80) == 5
    assert minhash.band_keys(np.ones((2, 192)), 5).shape == (2, 38)
    for p in (50, 70, 80, 85, 95):
        r = minhash.band_rows(p)
        assert (1 - (p / 100) ** r) ** (minhash.SIGNATURE // r) < 3e-7


def test_rows_with_maps(spark):
    """A column of maps, which Spark cannot order, does not stop the choice among rows of one id."""
    rows = [(1, "one two three four five", {"a": "x"}), (1, "one two three four five", {"a": "b"}), (2, "one two three four five", None), (None, "x", {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more map<string,string>")
    got = sorted((str(r.doc_id), r.more) for r in minhash.drop_near_duplicates(docs).collect())
    assert got == [("1", {"a": "b"}), ("None", {})]
