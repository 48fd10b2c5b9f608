"""Spelling variants: all pairs by brute force, large lists in blocks, odd rows."""

import random
import re
import zlib
from collections import Counter

import pytest
from test_llm_documents import LONG, frame, none, odd  # noqa: F401

from cartwheel.llm import spelling
from cartwheel.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(counts, ratio=10):
    """word -> (form, root, n, n_near, form_n) from all pairs."""
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts.get(form[w]))
    return out


def found(df):
    rows = [(r.word, (r.form, r.root, r.n, r.n_near, r.form_n)) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def counted(texts, every=None):
    c = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            if every:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % every == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def edit(w, rng):
    k = rng.randrange(len(w) + 1)
    return w[:k] + "".join(rng.choice("aeé") for _ in range(rng.randrange(2))) + w[k + rng.randrange(2):]


def random_words(seed, n=700):
    rng = random.Random(seed)
    out = {}
    while len(out) < n:
        w = edit(rng.choice(list(out)), rng) if out and rng.random() < 0.7 else "".join(rng.choice("aeé") for _ in range(rng.randrange(7, 12)))
        if len(w) >= 7:
            out[w] = rng.choice([2, 3, 20, 40, 400, 5000])
    return out


@pytest.mark.parametrize("block", [spelling.BLOCK, 20])
def test_matches_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)  # small blocks: every list is several tasks
    words = random_words(block)
    want = brute(words)
    assert sum(w[0] is not None for w in want.values()) > 100 and any(w[0] != w[1] for w in want.values() if w[0])
    assert found(spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == want


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op11_spelling_variants"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found(got) == brute(counted(docs, 31))


def test_chains_lead_to_the_last_form(spark):
    chain = {"abcdefgh" + "x" * k: 10 ** k * 2 for k in range(12)}
    got = found(spelling.spelling_variants(spark.createDataFrame(list(chain.items()), "word string, n long")))
    assert got == brute(chain) and {g[1] for g in got.values()} == {"abcdefgh" + "x" * 11}


def test_scan_skips_ranges():
    """Ranges whose shared prefix is two edits away are left at once."""
    words = sorted({"prefix" + a + b + "".join(c) for a in "abcdefgh" for b in "abcdefgh" for c in (("x", "y"), ("y",), ("z", "z", "z"))})
    listed, q = spelling.Words(words), "prefixaaxy"
    seen = []
    at = listed.at
    listed.at = lambda word, place: seen.append(len(word)) or at(word, place)
    lcp = spelling.common_prefixes(spelling.Words(words), spelling.np.arange(len(words)) == 0)
    _, hits = spelling.one_edit(listed, lcp, spelling.Words([q]), spelling.np.array([0]), spelling.np.array([len(words)]), 6)
    assert {words[i] for i in hits} == {w for w in words if one_edit(w, q)} and sum(seen) < len(words)


def test_odd_rows(spark, odd, none):  # noqa: F811
    assert spelling.spelling_variants(spelling.vocabulary(none)).count() == 0
    texts = [(1, None), (2, ""), (3, "ÉCOLIERS Écoliers écoliers ÷×àéîõü ÷×àéîõü"), (None, "variant variant varient"), (4, "variant varient " * 30),
             (4, "variants " * 700), (5, "s" * 200_000 + " " + "s" * 200_000), (6, "t" * 200_001 + " " + "t" * 200_001), (7, LONG), (7, LONG), (8, "日本語 words")]
    for every in (None, 2):
        got = spelling.vocabulary(frame(spark, texts), delete_every=every)
        assert {r.word: r.n for r in got.collect()} == counted(texts, every)
    words = spelling.vocabulary(frame(spark, texts))
    assert found(spelling.spelling_variants(words)) == brute(counted(texts))
    with pytest.raises(ValueError):
        spelling.spelling_variants(words, ratio=1)


def test_equal_counts_take_the_first_word(spark):
    words = {"variants": 2, "variante": 20, "variantz": 20, "variant": 20}
    got = found(spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words) and got["variants"][0] == "variant"
