"""Operators on documents: brute-force answers on the smallest driver folder and odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from cartwheel.llm import attribution, minhash, mixing, pii, piece, quality, sentences, toxicity
from cartwheel.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "Here are some plain words that make a sentence of fair length. " * 2
COPY = " ".join(f"{a}o{b}rd" for a in "bcdfghjk" for b in "lmnprstvwz") + "."
LONG = " ".join(f"w{i % 977}x{i % 13}." for i in range(60_000))
ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "one two"), (5, COPY), (6, COPY), (7, COPY.upper()), (8, LONG), (8, LONG),
       (9, "mail a.b@c.example.org or 10.0.0.1 now"), (None, COPY), (None, None), (10, PROSE), (11, "▁ 日本 𝕏 \x00 é")]
# columns that clash with names the operators use
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, component_id long, node long, "
          "id long, weight double, n_tokens long, score double, block int, row string, class int")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None if k % 3 else "s", None if t is None else len(t), None, 7, 7, 7, 0.5, 7, 0.5, 7, "x", 7)
                                  for k, (i, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(df, key="doc_id"):
    out = defaultdict(list)
    for r in df.collect():
        out[r[key]].append(r)
    return out


def lower(t):
    return t.translate({i: i + 32 for i in range(65, 91)})


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


# ---- quality rules

def expected_stats(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    covered = {k + j for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for j in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_quality_matches_brute_force(spark, docs):
    got = rows(QUERIES["op8_quality_rules"](spark, SF))
    assert set(got) == set(docs)
    for i, t in docs.items():
        r = got[i][0]
        n, *_, repeated = stats = expected_stats(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == stats
        assert r.base_failed == (n < 20 or 100 * repeated > 30 * n)
        assert not (r.base_failed and r.kept)


def test_quality_verdict_follows_labels(spark):
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = QUERIES["op8_quality_rules"](spark, "/root/testdata/sf0.01").filter("not base_failed").join(lab, "doc_id").groupBy("quality").agg(
        {"*": "count"}).collect()
    kept = QUERIES["op8_quality_rules"](spark, "/root/testdata/sf0.01").filter("kept").join(lab, "doc_id").groupBy("quality").count().collect()
    total, kept = {r["quality"]: r["count(1)"] for r in got}, {r["quality"]: r["count"] for r in kept}
    assert kept[1] >= 0.98 * total[1] and kept.get(0, 0) <= 0.1 * total[0]


def test_quality_odd_rows(odd, none):
    got = rows(quality.score(odd))
    for i, t in ODD:
        r = got[i][-1] if t is None and i is None else got[i][0]
        assert (r.n_words, r.n_repeat_words) in {(expected_stats(x)[0], expected_stats(x)[4]) for j, x in ODD if j == i}
    assert [r.kept for r in got[1] + got[2] + got[3] + got[4]] == [False] * 4
    assert len(got[8]) == 2 and got[8][0] == got[8][1]
    assert quality.score(none).count() == 0
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and {5, 6} <= {r.doc_id for r in kept.collect()}


def test_quality_model():
    # two rules that agree on most documents, and one that is a coin
    patterns = [((1, 1, 0), 400), ((1, 1, None), 400), ((0, 0, 0), 50), ((0, 0, None), 50), ((None, None, 0), 5)]
    m = quality.fit(patterns)
    assert quality.posterior(m, (1, 1, 0)) > 0.9 > 0.1 > quality.posterior(m, (0, 0, None))
    a = quality.accuracies(m)
    assert a[0] > 0.9 and a[1] > 0.9
    assert quality.fit([])["rules"] == []


# ---- near duplicates

def shingles(t):
    w = WORD.findall(lower(t or ""))
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4))


def components(texts, percent=85):
    """doc_id -> smallest reachable id, from all pairs; ``texts`` has (id, text) rows."""
    sets = [(i, shingles(t)) for i, t in texts if i is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = sorted((find(i), find(j)))
                up[y] = x
    return {i: find(i) for i in up}


def test_near_duplicates_match_all_pairs(spark, docs):
    got = rows(QUERIES["op7_minhash_near_dedup"](spark, SF))
    want = components(docs.items())
    for i, t in docs.items():
        assert (got[i][0].n_shingles, got[i][0].component_id, got[i][0].kept) == (len(shingles(t)), want[i], want[i] == i)


def near_copies(n, words=60, chain=3):
    """Chains of texts that differ by few words, so that links are near the border."""
    out = []
    for base in range(n):
        w = [f"b{base}w{k}" for k in range(words)]
        for c in range(chain):
            w = w[:]
            w[(7 * base + 5 * c) % words] = f"edit{base}x{c}"
            out.append((base * 10 + c, " ".join(w)))
    return out


@pytest.mark.parametrize("block, heavy", [(minhash.BLOCK, minhash.HEAVY), (200, minhash.HEAVY), (200, 300)])
def test_near_duplicates_in_blocks(spark, monkeypatch, block, heavy):
    """Small blocks cut one large candidate group into many tasks, and heavy
    groups are verified bucket by bucket; the answer stays."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "HEAVY", heavy)
    texts = near_copies(12) + [(1000 + k, COPY + f" tail{k}") for k in range(30)] + [(2000, COPY), (2001, COPY.upper())]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == components(texts)
    assert got[1005] == got[2001] == 1000


def test_near_duplicates_odd_rows(odd, none):
    out = minhash.near_duplicates(odd).collect()
    assert len(out) == len(ODD)
    got = rows(minhash.near_duplicates(odd))
    assert [got[i][0].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert all(got[i][0].kept and got[i][0].component_id == i for i in (1, 2, 3, 4, 5, 8))
    assert got[6][0].component_id == got[7][0].component_id == 5 and not got[6][0].kept
    assert all(r.component_id is None and r.kept for r in got[None])
    assert minhash.near_duplicates(none).count() == 0
    left = minhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([1, 2, 3, 4, 5, 8, 9, 10, 11, None, None])
    assert minhash.drop_near_duplicates(none).count() == 0


def test_superminhash_estimates_jaccard():
    import numpy as np
    a = np.arange(1000, dtype=np.uint64)
    sets = [a, a[:900], a[300:], a[:3]]
    off = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    sig = minhash.superminhash(np.concatenate(sets), off)
    assert np.isfinite(sig).all()
    same = lambda i, j: float((sig[i] == sig[j]).mean())
    assert abs(same(0, 1) - 0.9) < 0.1 and abs(same(0, 2) - 0.7) < 0.12 and same(0, 3) < 0.05
    # each place is filled once per element: a single element fills all places with distinct steps
    one = minhash.superminhash(np.array([5], np.uint64), np.array([0, 1]))[0]
    assert sorted(one.astype(int)) == list(range(minhash.SIGNATURE))


# ---- personal data

PATTERNS = [("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
            ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m.split("."))),
            ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
            ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15)]


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def base(t):
    return [(k, m.start(), m.end()) for k, p, ok in PATTERNS for m in p.finditer(t or "") if ok(m[0])]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_pii_matches_patterns(spark, docs):
    got = rows(QUERIES["op3_pii"](spark, SF))
    for i, t in docs.items():
        r, want = got[i][0], base(t)
        assert r.base_sha256 == sha(listed(want))
        assert [r[f"n_{k}"] for k, _, _ in PATTERNS] == [sum(s[0] == k for s in want) for k, _, _ in PATTERNS]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(r.spans.split(","))


def test_pii_patterns_on_random_text():
    import random
    rng = random.Random(3)
    for _ in range(3000):
        t = "".join(rng.choice("019 .-+()@ab.é%\n5") for _ in range(rng.randint(0, 60)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(t)] == base(t)
    for t in ("1" * 100_000, "+1 " * 30_000, "a" * 100_000 + "@", "1." * 50_000, "@" * 50_000, "a.b@" * 20_000):
        pii.base_spans(t), pii.tokens(t)


def test_pii_long_numbers():
    """Thousands of digits in a part of an address, zeros or not."""
    t = "0" * 5000 + ".1.2.3 and " + "9" * 5000 + ".1.2.3 and 1.2.3." + "0" * 5000 + "255"
    assert [(k, a, b) for k, a, b in pii.base_spans(t) if k == 1] == [(1, 0, 5006), (1, 10022, 15031)]


def test_pii_field_finds_neighbours(spark):
    card, other = "4111111111111111", "5500005555555559"
    texts = [(k, f"pay {card} now and ring +1 (800) 555-0{k:03d} today") for k in range(40)]
    texts += [(100, f"both {card} {other} here, again {card} alone"), (101, "number 1234567890123456 is no card")]
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, texts)).collect()}
    t = dict(texts)[100]
    found = {t[int(a):int(b)] for _, a, b in (s.split(":") for s in got[100].spans.split(","))}
    assert found == {card, other} and got[100].n_card == 1 and got[100].n_added == 2
    assert got[101].spans == ""


@pytest.fixture(scope="module")
def pii_model(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


REPEATS = [("Call +1 826 555 4081 today. " + "Some words. " * 300 + "Again: 8265554081 is the number.", "8265554081"),
           ("Ring +44 20 7946 0958. " + "Some words. " * 50 + "In short 020 7946 0958 will do.", "020 7946 0958"),
           ("Write to +49 (30) 1234567, or " + "so on " * 40 + "301234567 is the same.", "301234567")]


@pytest.mark.parametrize("text, mention", REPEATS)
def test_pii_repeats_need_the_skip_edges(pii_model, text, mention):
    """A later mention without its + is found by the edge to the first one, and not without."""
    at = text.rindex(mention)
    phone = (pii.KINDS.index("phone"), at, at + len(mention))
    (base, more), = pii.find([text], pii_model)
    assert [k for k, _, _ in base] == [3] and more == [phone]
    (_, lost), = pii.find([text], pii_model, skips=False)
    assert phone not in lost
    alone = text[30:]  # the same mention without the first one
    (_, other), = pii.find([alone], pii_model)
    assert mention not in [alone[a:b] for _, a, b in other]


def test_pii_marginals_by_enumeration(pii_model):
    """On chains the messages give the exact marginals, on a loop nearly so."""
    import itertools

    import numpy as np
    rng = np.random.default_rng(4)
    model = pii.Model(np.zeros((0, 6), np.int64))
    labels = pii.N_LABELS
    model.chain, model.skip = rng.normal(size=(2, labels, labels)) * 0.7
    model.own = rng.normal(size=model.own.shape)
    for text, skip, close in (("12 34 56", 0, 1e-3), ("12 34 x 777", 0, 1e-3), ("12 34 12", 1, 0.05)):
        g = pii.Graph([text])
        assert len(g.skip) == skip
        unary = model.node(g.shape, g.before, g.after)
        want = np.zeros_like(unary)
        for y in itertools.product(range(labels), repeat=len(unary)):
            e = sum(unary[i, a] for i, a in enumerate(y))
            e += sum(model.chain[y[i], y[j]] for i, j in g.chain) + sum(model.skip[y[i], y[j]] for i, j in g.skip)
            for i, a in enumerate(y):
                want[i, a] += math.exp(e)
        want /= want.sum(axis=1, keepdims=True)
        assert np.abs(model.marginals(g) - want).max() < close, text


def test_pii_odd_rows(odd, none):
    got = rows(pii.personal_data(odd))
    assert all(got[i][0].spans == "" and got[i][0].base_sha256 == sha("") for i in (1, 2, 3, 4))
    assert got[9][0].spans == "email:5:22,ip:26:34" and len(got[8]) == 2
    assert pii.personal_data(none).count() == 0
    out = pii.redact_personal_data(odd)
    assert out.schema == odd.schema
    red = rows(out)
    assert red[9][0].text == "mail [EMAIL] or [IP] now" and red[9][0].n_chars == len(red[9][0].text)
    assert red[1][0].text is None and red[8][0].text == LONG
    assert pii.redact_personal_data(none).count() == 0


# ---- SentencePiece

def test_sentencepiece_matches_library(spark, docs):
    lib = piece.load(piece.MODEL).lib
    got = rows(QUERIES["op2_sentencepiece"](spark, SF))
    for i, t in docs.items():
        ids = lib.encode(t, add_eos=True)
        r = got[i][0]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.n_corrected) == (
            len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids)), 0)


def test_sentencepiece_agendas_agree_with_library():
    import random
    p, rng = piece.load(piece.MODEL), random.Random(1)
    texts = ["".join(rng.choice("ab eé ▁\n日本𝕏\x00\t the  ing1234") for _ in range(rng.randint(0, 70))) for _ in range(800)]
    texts += [" ", "  ", "a" * 3000, " " * 200, "▁", "x" * 25, "hello " * 50]
    for t, (ids, n, text, corrected) in zip(texts, piece._encode_texts(texts, piece.MODEL, True)):
        want = p.lib.encode(t, add_eos=True)
        assert (ids, n, text, corrected) == (" ".join(map(str, want)), len(want), p.lib.decode(want), 0)
        for s in piece.segments_of(t):
            assert p.merge_long(s) == p.encode_segments([s])[0][0]
    for _ in range(500):
        ids = [rng.choice((3 + rng.randrange(256), rng.randrange(32000))) for _ in range(rng.randint(0, 12))]
        assert p.decode(ids) == p.lib.decode(ids)


def test_sentencepiece_memory_is_bounded():
    m = piece.Memory(piece.load(piece.MODEL), limit=10)
    for k in range(20):
        assert set(m.learn({f"▁a{k}", f"▁b{k}", "▁the"})) >= {f"▁a{k}", "▁the"}
        assert len(m.young) <= 13 and len(m.old) <= 13


def test_sentencepiece_forgets_long_segments():
    """Texts without spaces are segments as long as they are; only the last step's are held."""
    m = piece.Memory(piece.load(piece.MODEL), 10_000)
    for k in range(400):
        text = "".join(chr(0x4E00 + (k * 7919 + j * 31) % 20_000) for j in range(500))
        known = m.learn(set(piece.segments_of(text + " kurz")))
        assert all(s in known for s in piece.segments_of(text + " kurz"))
    held = sum(len(s) + len(x) for d in (m.young, m.old) for s, x in d.items())
    assert held < 20_000 and any("kurz" in s for s in m.young)


def test_sentencepiece_odd_rows(odd, none):
    got = rows(piece.encode_digests(odd))
    assert all(got[i][0].n_tokens == 1 and got[i][0].ids_sha256 == sha("2") and got[i][0].decoded_sha256 == sha("") for i in (1, 2))
    assert len(got[8]) == 2 and len(got[None]) == 2 and got[3][0].n_tokens > 1
    assert piece.encode_digests(none).count() == 0
    out = rows(piece.encode_documents(odd))
    assert out[11][0].text == piece.load(piece.MODEL).lib.decode(list(out[11][0].ids))
    assert out[1][0].ids == [2] and out[4][0].source in (None, "s")


# ---- section counts

def test_section_tokens_add_up(spark, docs):
    enc = attribution.load(attribution.MODEL)
    got = rows(QUERIES["op6_section_tokens"](spark, SF))
    for i, t in docs.items():
        parts = sorted(got[i], key=lambda r: r.section)
        assert sum(r.n_tokens for r in parts) == len(enc.encode(t))
        assert "".join(t[r.start:r.end] for r in parts) == t
        # brute force: each token by its bytes
        owner = [k for k, r in enumerate(parts) for _ in t[r.start:r.end].encode()]
        at, want = 0, Counter()
        for n in (int(enc.length[x]) for x in enc.encode(t)):
            c = Counter(owner[at:at + n])
            want[min(c, key=lambda k: (-c[k], k))] += 1
            at += n
        assert [r.n_tokens for r in parts] == [want[k] for k in range(len(parts))]


def test_section_tokens_rule_for_borders():
    import numpy as np
    borders = np.array([0, 4, 6, 12])
    counts, crossing = attribution.attribute(borders, np.array([0, 5, 6]), np.array([5, 6, 7]))
    assert counts.tolist() == [2, 0, 1, 0] and crossing == 1  # the tie at 4..6 goes to the earlier section
    counts, _ = attribution.attribute(borders, np.array([6]), np.array([8]))
    assert counts.tolist() == [1, 2]


def test_section_tokens_of_very_long_runs():
    """What the library cannot take in one piece counts as in shorter texts, which it can."""
    enc = attribution.load(attribution.MODEL)
    for text in ("word" + " " * 30_000 + "next\n" + "\t " * 20_000, " " * 30_000, "\u3000" * 12_000 + "x", "a\x1c\x1c" * 9_000):
        assert enc.encode(text) == enc.encoding.encode_ordinary(text)
    for c in " a日":
        assert enc.borders(c * 1_000_000)[-1] == len((c * 1_000_000).encode())
    assert enc.borders("x" + "\n" * 1_000_000 + "y")[-1] == 1_000_002


def test_section_tokens_odd_rows(spark, odd, none):
    got = rows(attribution.section_tokens(odd))
    assert [(r.section, r.start, r.end, r.n_tokens) for r in got[1] + got[2]] == [(0, 0, 0, 0)] * 2
    assert len(got[3]) == 2 and sum(r.n_tokens for r in got[8]) % 2 == 0
    assert attribution.section_tokens(none).count() == 0
    given = spark.createDataFrame([(4, 0, 0, 3), (4, 1, 3, 7), (99, 0, 0, 1)], "doc_id long, section long, start long, end long")
    got = rows(attribution.section_tokens(odd, given))
    assert [(r.section, r.n_tokens) for r in sorted(got[4], key=lambda r: r.section)] == [(0, 1), (1, 1)]
    assert [(r.section, r.n_tokens) for r in got[2]] == [(-1, 0)]


# ---- mixing

def test_temperature_weights():
    shares = [0.7, 0.2, 0.1]
    assert mixing.temperature_weights(shares, 1.0) == pytest.approx(shares)
    assert mixing.temperature_weights(shares, 0.0) == pytest.approx([1 / 3] * 3)
    a = mixing.exponent_for(shares, target_entropy=0.95, max_repeats=None)
    assert mixing.entropy(mixing.temperature_weights(shares, a)) == pytest.approx(0.95 * math.log(3), abs=1e-9)
    a = mixing.exponent_for(shares, target_entropy=1.0, max_repeats=1.5)
    w = mixing.temperature_weights(shares, a)
    assert mixing.repeats(shares, w, None) == pytest.approx(1.5, abs=1e-9)
    assert mixing.exponent_for([1.0]) == 1.0 and mixing.plan({}) == {}


def test_mixing_spends_the_budget(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 500)  # many blocks
    texts = [(k, "word " * (1 + k % 9)) for k in range(2000)]
    docs = spark.createDataFrame([(i, t, "big" if i % 10 else "small") for i, t in texts], "doc_id long, text string, source string")
    totals = Counter()
    for i, t in texts:
        totals["big" if i % 10 else "small"] += len(t.split())
    for budget in (None, 3000, 40_000):
        want = mixing.plan(dict(totals), 1.0, 3.0, budget)
        got = mixing.draw(docs, 1.0, 3.0, budget).collect()
        for s in totals:
            own = [r for r in got if r.source == s]
            spent = sum(r.n_tokens for r in own)
            assert want[s][2] - 9 < spent <= want[s][2]
            times = Counter(r.doc_id for r in own)
            assert max(times.values()) - min(times.values()) <= 1 or budget == 3000
            place = sorted((r.position, r.n_tokens) for r in own)
            ends = 0
            for p, n in place:  # the stream has no gap but for what did not fit at the end
                assert p * want[s][2] == pytest.approx(ends, abs=1e-6)
                ends += n
            first = [r.doc_id for r in sorted((r for r in own if r.epoch == 0), key=lambda r: r.position)]
            assert first != sorted(first)
        if budget is None:
            assert {r.doc_id for r in got} == {i for i, _ in texts}


def test_mixing_odd_rows(odd, none):
    got = mixing.draw(odd).collect()
    assert {r.doc_id for r in got} == {i for i, _ in ODD} and {r.source for r in got} == {None, "s"}
    assert all(0 <= r.position < 1 for r in got)
    assert mixing.draw(none).count() == 0
    out = mixing.mix_documents(odd)
    assert out.columns == odd.columns and {r.text for r in out.collect()} == {t for _, t in ODD}
    assert mixing.mix_documents(none).count() == 0


# ---- sentence spans

def without_repeats(texts):
    """The rule sentence by sentence: of every sentence the shortest runs forward and backward, the first of a kind stays."""
    seen, out = set(), {}
    for i, t in sorted(texts):
        starts = sorted({0, *(m.end() for m in re.finditer(r"[.!?]\s+|\n\s*", t) if m.end() < len(t))}) if t else []
        parts = [t[a:b] for a, b in zip(starts, starts[1:] + [len(t)])]
        keys = [" ".join(p.split()) for p in parts]
        words = [len(p.split()) for p in parts]
        found = set()
        for k in range(len(parts)):
            for way in (range(k + 2, len(parts) + 1), range(k - 1, -1, -1)):
                for x in way:
                    a, b = (k, x) if x > k else (x, k + 1)
                    if sum(words[a:b]) >= sentences.MIN_WORDS:
                        found.add((a, b))
                        break
        gone = set()
        for a, b in sorted(found):
            key = tuple(keys[a:b])
            gone |= set(range(a, b)) if key in seen else set()
            seen.add(key)
        out[i] = ("".join(p for k, p in enumerate(parts) if k not in gone), len(parts), len(gone))
    return out


def test_sentence_spans_match_brute_force(spark, docs):
    got = rows(QUERIES["op10_sentence_spans"](spark, SF))
    want = without_repeats(docs.items())
    assert {i: (r[0].text, r[0].n_sentences, r[0].n_removed) for i, r in got.items()} == want
    assert any(n for _, _, n in want.values())


def test_sentence_spans_passage(spark):
    passage = " ".join(f"Sentence {k} of the shared passage has some ten words in it." for k in range(6))
    texts = [(k, f"Own start {k} of this text. {passage} Own end {k} of this text.") for k in range(20)]
    got = {r.doc_id: r.text for r in sentences.remove_repeated_spans(frame(spark, texts)).collect()}
    assert got[0] == texts[0][1]
    assert all(got[k] == f"Own start {k} of this text. Own end {k} of this text." for k in range(1, 20))


def test_sentence_spans_odd_rows(odd, none):
    got = rows(sentences.remove_repeated_spans(odd))
    assert got[1][0].text is None and got[2][0].text == "" and got[2][0].n_sentences == 0
    # rows of one id are one document, which repeats its own sentences of one word
    assert got[8][0] == got[8][1] and (got[8][0].text, got[8][0].n_sentences, got[8][0].n_removed) == without_repeats([(8, LONG)])[8]
    assert {r.text for r in got[None]} == {COPY, None}
    assert sentences.remove_repeated_spans(none).count() == 0


def test_sentence_spans_within_a_document(spark):
    part = "This sentence has quite a few words in it. And this one has nearly as many words too.\n"
    got = sentences.remove_repeated_spans(frame(spark, [(1, part + "Between.\n" + part), (1, part)])).collect()
    assert sorted(r.text for r in got) == sorted([part + "Between.\n", part])


def test_sentence_spans_of_short_sentences(spark):
    """Passages of lines of any length go; rows of one id keep what only the other repeats."""
    lines = "\n".join(f"line {k} is short" for k in range(12)) + "\n"
    other = " ".join(f"Another sentence {k} of a different text." for k in range(8))
    texts = [(k, f"Own start {k} here. And more {k}.\n{lines}Own end {k}.") for k in range(5)] + [(3, other), (9, "New. " + other)]
    got = sorted((r.doc_id, r.text) for r in sentences.remove_repeated_spans(frame(spark, texts)).collect())
    want = sorted([(0, texts[0][1])] + [(k, f"Own start {k} here. And more {k}.\nOwn end {k}.") for k in range(1, 5)] + [(3, other), (9, "New. ")])
    assert got == want


def test_sentences_outside_of_runs(docs):
    """Only texts of one sentence or fewer than MIN_WORDS words have sentences in no run."""
    for t in docs.values():
        n = len(sentences.sentence_starts(t))
        _, at, size = sentences.run_hashes(t)
        covered = {k for a, m in zip(at.tolist(), size.tolist()) for k in range(a, a + m)}
        assert len(covered) == (n if n > 1 and len(t.split()) >= sentences.MIN_WORDS else 0)


# ---- toxicity

def test_toxicity_learns(spark):
    import numpy as np
    sf = "/root/testdata/sf0.1"
    lab = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op1_toxicity"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [(r.score, lab[r.doc_id]) for r in got if r.held_out and r.doc_id in lab]
    s, y = np.array([h[0] for h in held]), np.array([h[1] for h in held])
    order = np.argsort(np.argsort(s))
    auc = (order[y == 1].mean() - ((y == 1).sum() - 1) / 2) / (y == 0).sum()
    assert auc > 0.9


def test_toxicity_needs_the_pair():
    """Neither term alone is toxic; together they are: only the factors can learn that."""
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(0)
    texts, y = [], []
    for k in range(600):
        a, b = k % 2, k // 2 % 2
        texts.append(" ".join(["groupname" if a else "other", "insultword" if b else "thing"] + [f"f{rng.integers(40)}" for _ in range(3)]))
        y.append(float(a and b))
    m = toxicity.Machine()
    t, c, off = toxicity.hashed_terms(pa.array(texts))
    m.weigh(len(y), np.bincount(t, minlength=1 << toxicity.BITS))
    m.fit(t, c, off, np.array(y), np.ones(len(y)))
    s = m.scores(pa.array(["groupname insultword f1 f2 f3", "groupname thing f1 f2 f3", "other insultword f1 f2 f3"]))
    assert s[0] > 0.5 > max(s[1], s[2])


def test_toxicity_score_is_the_sum_over_pairs(spark, docs):
    """The score against the plain double sum over the pairs of a text's terms, with idf of all documents."""
    import numpy as np
    m = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    seen = Counter()
    texts = [t or "" for t in docs.values()]
    terms = [toxicity.hashed_terms(toxicity.pa.array([t]))[:2] for t in texts]
    for t, _ in terms:
        seen.update(t.tolist())
    for (t, c), text in list(zip(terms, texts))[:12]:
        idf = np.array([math.log((1 + len(texts)) / (1 + seen[k])) for k in t.tolist()])
        assert np.allclose(m.idf[t], idf, atol=1e-5)
        x = (1 + np.log(c)) * idf * 10 / math.sqrt(max(1, len(t)))
        z = m.w0 + float((m.w[t] * x).sum())
        vx = m.v[t].astype(float) * x[:, None]
        z += sum(float(vx[i] @ vx[j]) for i in range(min(len(t), 400)) for j in range(i)) if len(t) <= 400 else 0.5 * float(
            (vx.sum(axis=0) ** 2).sum() - (vx * vx).sum())
        assert m.scores(toxicity.pa.array([text]))[0] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-3)


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(3, 11)] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = rows(toxicity.toxicity(odd, labels))
    assert sum(map(len, got.values())) == len(ODD)
    assert got[1][0].score == got[2][0].score == got[3][0].score and got[8][0] == got[8][1]
    assert not got[None][0].held_out
    assert toxicity.toxicity(none, labels).count() == 0
    flat = toxicity.toxicity(odd, labels.filter("false")).collect()
    assert {r.score for r in flat} == {0.5}
