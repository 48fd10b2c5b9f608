"""Operators on vectors and pages, the hashing and component helpers, and the pipeline."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cartwheel.llm import components, hashing, mainpage, maxscore, mixing, piece, pii, quality
from cartwheel.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


# ---- exact top-k

def brute_top(vectors, k=5):
    """(query, rank, id, score) rows by scoring everything; ``vectors`` has (id, list) rows."""
    ok = {(i, tuple(math.floor(256 * float(x)) for x in v)) for i, v in vectors
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for qi, q in ok:
        if qi % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in ok if i != qi)[:k]
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def top_of(spark, vectors):
    df = spark.createDataFrame([(i, v, 1, 9, True) for i, v in vectors],
                               "vec_id long, embedding array<float>, label int, row long, is_query boolean")
    v = maxscore.integers(df)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in maxscore.top_k(v, v.filter("vec_id % 50 = 0")).collect())


def test_maxscore_matches_brute_force(spark):
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in QUERIES["op4_maxscore"](spark, SF).collect())
    assert got == brute_top(table)


def test_maxscore_ties_shards_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD", 40)
    monkeypatch.setattr(maxscore, "BLOCK", 2)
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 4]) for i in range(301)]
    vectors += [(400, None), (450, [None, 1.0]), (500, [float("nan")]), (550, [float("inf"), 0.0]), (600, []), (650, [0.5]), (None, [1.0]),
                (0, vectors[0][1]), (7, vectors[7][1])]
    vectors = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    assert top_of(spark, vectors) == brute_top(vectors)
    assert top_of(spark, []) == []
    assert top_of(spark, [(0, [1.0, 2.0])]) == []
    assert top_of(spark, [(0, [1.0]), (1, [3e18])]) == [(0, 1, 1, (1 << 63) - 1)]  # floor and score stop at 64 bits


def test_maxscore_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(0, 0.125, (3000, 64)))
    x[:, 0] *= 8  # one strong dimension: many non-essential terms
    q = x[::300]
    got = maxscore.search(np.arange(3000), x, np.arange(0, 3000, 300), q)
    for i in range(len(q)):
        s = x @ q[i]
        s[i * 300] = -np.inf
        want = np.lexsort((np.arange(3000), -s))[:5]
        assert [(c, v) for n, c, v in got if n == i] == [(int(c), int(s[c])) for c in want]


# ---- pages

PAGE = ('<!DOCTYPE html><html><head><title>T</title><script>var x="</p><p>no";</script></head><body>'
        '<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies on this site, accept them now.</div>'
        '<article><h1>Head &amp; line</h1><p>First   part<br>of <b>the</b> text&nbsp;here.<p>Second <a href="x">part</a>.'
        '<div class="ad">Buy this</div><!-- c --><ul><li>one<li>two</ul></article>'
        '<aside>Side</aside><section id="comments"><p>Great article, thanks a lot for it.</p></section><form><p>Mail</p></form>'
        '<footer>End</footer></body></html>')
MAIN = "Head & line\nFirst part of the text here.\nSecond part.\none\ntwo"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (None, None, PAGE), (4, "u", "<div>" * 3000 + "deep"),
            (5, "u", "<p>a <b>cut"), (6, "u", PAGE.replace("article", "div class='content'")), (7, "u", "a < b & c > d <p")]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")


def test_main_text_of_odd_pages(spark, pages):
    got = mainpage.extract(pages).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 9 and sum(r.text == MAIN for r in got) >= 3
    assert by[1].text == MAIN and by[1].n_chars == len(MAIN) and by[None].text == MAIN
    assert (by[2].text, by[2].n_chars, by[3].text) == ("", 0, "")
    assert by[6].text == MAIN
    assert mainpage.extract(pages.filter("false")).count() == 0


def test_main_text_keeps_formulas_and_text_without_scripts():
    """Text of an article in elements that are no markup of their own stays, inside its block."""
    page = mainpage.Page("<body><article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='tex'>x=2</annotation></math> be "
                         "<object data='f'>a figure</object> <noscript>shown so</noscript>.</p><svg><text>no</text></svg><p>End.</p></article></body>")
    assert page.texts == ["Let x=2 be a figure shown so.", "End."]


def test_main_text_of_driver_pages(spark):
    """The pages keep their text in ``article``; a plain cut of it is the brute-force answer."""
    import html
    import re
    src = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op5_main_text"](spark, SF).collect():
        body = re.search(r"<article>(.*?)(</article>|$)", src[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1|div|article)\b[^>]*>", body))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_message_passing_is_exact_on_a_tree():
    page = mainpage.Page("<div class=post>text here<p>one</p><div><p>two</p><ul><li>three</ul></div></div><nav>x</nav>")
    forest, m = mainpage.Forest([page]), mainpage.Model()
    got = m.marginals(forest)
    n = len(page.tag)
    score, total, want = forest.scores(m.w), 0.0, np.zeros(n)
    for states in range(1 << n):  # all assignments
        y = [(states >> k) & 1 for k in range(n)]
        p = math.exp(sum(score[k] * y[k] for k in range(n)) + sum(m.edge[y[page.parent[k]], y[k]] for k in range(1, n)))
        total += p
        want += p * np.array(y)
    assert got == pytest.approx(want / total, abs=1e-9)


# ---- helpers

def test_word_hashes_do_not_depend_on_place():
    long = "x" * 70_000
    data, off = hashing.utf8(pa.array(["b a  c", None, "a", f"c {long} a {long}", "", " "]))
    s, e, first = hashing.words(data, off)
    h = hashing.hash_words(data, s, e).tolist()
    assert first.tolist() == [0, 3, 3, 4, 8, 8, 8]
    assert h[1] == h[3] == h[6] and h[2] == h[4] and h[5] == h[7] and len(set(h)) == 4


def test_components_of_chains_stars_and_loops(spark):
    rng = np.random.default_rng(2)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(501, 800)]
    loose = [(int(a), int(b)) for a, b in rng.integers(1000, 1300, (150, 2))]
    edges = chain + star + loose + [(5, 5), (101, 100)]
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.connected_components(df, "a", "b").collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components.connected_components(df.filter("false"), "a", "b").count() == 0


# ---- queries and pipeline

def test_oracle_sql_matches(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("embeddings", "documents"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in ORACLE_SQL.items():
        got = QUERIES[name](spark, SF)
        want = con.execute(sql)
        names = [d[0] for d in want.description]
        assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(want.fetchall())


def test_no_python_in_quality_rules(spark):
    plan = QUERIES["op8_quality_rules"](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_pipeline(spark):
    import corpus_pipeline
    import test_llm_documents as T
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).collect()
    # brute force, stage by stage, from each operator's own verdicts and rules
    kept = {r.doc_id for r in quality.score(docs).filter("kept").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    linked = T.components(texts.items(), 80)
    texts = {i: t for i, t in texts.items() if linked[i] == i}
    left = docs.filter(docs.doc_id.isin(list(texts)))
    model = pii.train(left)
    texts = {i: pii.redact(t, base + more) for (i, t), (base, more) in zip(texts.items(), pii.find(list(texts.values()), model))}
    assert {r.doc_id: r.text for r in out} == texts
    lib = piece.load(piece.MODEL).lib
    assert all(list(r.ids) == lib.encode(r.text, add_eos=True) and r.n_tokens == len(r.ids) for r in out)
    words = Counter()
    source = {r.doc_id: r.source for r in docs.collect()}
    for i, t in texts.items():
        words[source[i]] += max(1, len(t.split()))
    planned, drawn = mixing.plan(dict(words)), Counter()
    for r in out:
        drawn[source[r.doc_id]] += max(1, len(r.text.split()))
    longest = max(max(1, len(t.split())) for t in texts.values())
    assert all(planned[s][2] - longest < drawn[s] <= planned[s][2] for s in words)


def test_pipeline_of_odd_rows(spark):
    import corpus_pipeline
    import test_llm_documents as T
    for rows in (T.ODD, []):
        docs = T.frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "encode":
                assert out.columns == docs.columns
                docs = out
        assert out.count() >= (1 if rows else 0)
