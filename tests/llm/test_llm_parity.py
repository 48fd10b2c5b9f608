"""N-gram Jaccard join: all pairs by brute force, hot parts, odd rows."""

import random

import numpy as np
import pytest
from test_llm_documents import COPY, LONG, ODD, frame, none, odd, shingles  # noqa: F401
from test_llm_near_dedup import linked

from cartwheel.llm import hashing, parity


def groups(df):
    return {r.doc_id: r.component_id for r in df.collect()}


def edited(words, rng, edits):
    out = list(words)
    for _ in range(edits):
        k = rng.randrange(len(out) + 1)
        out[k:k + rng.randrange(2)] = [f"e{rng.randrange(10**6)}" for _ in range(rng.randrange(2))]
    return out


def copies(seed, n=160):
    """Texts of 1 to 400 words, most of them edited copies of others, and a passage that half of them hold."""
    rng = random.Random(seed)
    shared = [f"s{k}" for k in range(40)]
    texts = []
    for i in range(n):
        if texts and rng.random() < 0.7:
            words = edited(rng.choice(texts[-12:])[1].split() or ["x"], rng, rng.randrange(8))
        else:
            words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([1, 4, 5, 7, 9, 15, 40, 120, 400]))]
            if rng.random() < 0.5:
                words = words[:30] + shared
        texts.append((i, " ".join(words)))
    return texts


@pytest.mark.parametrize("percent", [80, 40])
def test_links_match_all_pairs(spark, percent):
    texts = copies(percent)
    want = linked(texts, percent)
    assert len(set(want.values())) < 0.8 * len(want)
    assert groups(parity.jaccard_groups(frame(spark, texts), percent)) == want


def test_groups_in_many_blocks(spark, monkeypatch):
    """A chain whose ends are far apart, and texts that share most of their words but do not link."""
    monkeypatch.setattr(parity, "BLOCK", 300)
    monkeypatch.setattr(parity, "DOCUMENTS", 7)
    words = [f"c{k}" for k in range(100)]
    chain = [(k, " ".join([f"n{j}" for j in range(k)] + words[k:])) for k in range(0, 60, 2)]
    common = " ".join(f"p{k}" for k in range(60))
    alike = [(1000 + k, common + "".join(f" own{k}x{j}" for j in range(10))) for k in range(40)]
    texts = chain + alike
    want = linked(texts, 80)
    assert {want[i] for i, _ in chain} == {0} and len({want[i] for i, _ in alike}) == 40
    assert groups(parity.jaccard_groups(frame(spark, texts))) == want


def test_part_shared_by_all_costs_no_pairs(spark):
    """Texts that share a passage but little else are hardly tied: the shared parts are the commonest."""
    common = " ".join(f"p{k}" for k in range(30))
    texts = [(k, common + "".join(f" own{k}x{j}" for j in range(120))) for k in range(300)]
    feats = parity.features(frame(spark, texts))
    assert parity.candidate_ties(feats, feats.select("doc_id", "odd", "spare0", "spare1")).count() < 10


def test_sketch_bounds_the_difference():
    rng = np.random.default_rng(1)
    for n in (10, 200, 3000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate((a[n // 5:], rng.integers(0, 1 << 63, n // 7).astype(np.uint64)))
        sets = [np.unique(a), np.unique(b)]
        off = np.cumsum([0] + [len(s) for s in sets])
        differ = len(np.setxor1d(*sets))
        s = parity._sketches(np.concatenate(sets), off, 1024)
        assert np.bitwise_count(s[0] ^ s[1]).sum() <= differ
        # as many parts as differences and one more: one of them is equal
        window, parts, d = (np.array([x, x]) for x in (3, differ + 1, differ))
        keys, at, spare = parity.part_keys(np.concatenate(sets), off, window, parts, d)
        assert spare.tolist() == [0, 0] and set(keys[:at[1]].tolist()) & set(keys[at[1]:].tolist())


def test_windows_hold_every_linked_pair_of_sizes():
    for percent in (40, 60, 80, 95):
        edges = parity.band_edges(percent)
        n = np.arange(1, 700)
        own, nxt = parity.windows(n, percent, edges)
        for a in range(1, 500):
            for b in range(a, min(700, a * 100 // percent + 1)):
                d = parity.allowed(a, b, percent)
                # the least symmetric difference of these sizes is b - a, or 2 where they are equal
                if b >= 700 or max(b - a, 2 if a == b else 1) > d:
                    continue
                sides = [(w[0][k - 1], w[1][k - 1], w[2][k - 1]) for k, w in ((a, own), (a, nxt), (b, own))]
                x = sides[0] if sides[0][0] == sides[2][0] else sides[1]
                assert x[:2] == sides[2][:2] and min(x[2], sides[2][2]) >= d and x[1] > d, (percent, a, b)


def test_odd_rows(odd, none):  # noqa: F811
    got = parity.jaccard_groups(odd)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    rows = got.collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows}
    assert [by[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 2, 3, 4, 5, 5, 5, 8]
    assert [by[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert by[8].n_shingles == len(shingles(LONG)) and {r.component_id for r in rows if r.doc_id is None} == {None}
    assert parity.jaccard_groups(none).count() == 0


def test_rows_of_one_id(spark):
    """An id with two texts ties what is linked to either."""
    far = " ".join(f"z{k}" for k in range(50))
    near = lambda t: t.replace("z3 ", "q ").replace("e3o", "e9o")
    texts = [(1, COPY), (1, far), (1, far + far), (2, near(COPY)), (3, near(far)), (4, "something else in five words")]
    assert {r.doc_id: r.component_id for r in parity.jaccard_groups(frame(spark, texts)).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_words_are_hashed_by_ascii_case():
    a, _ = parity.shingle_sets(parity.pa.array(["One TWO three four FIVE", "one two three four five"]))
    assert len(set(a.tolist())) == 1 and hashing.mix(a).dtype == np.uint64
