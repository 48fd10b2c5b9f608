"""Repeated passages of any layout."""

import re

import pytest
from test_llm_documents import LONG, frame, none, odd, rows, without_repeats  # noqa: F401

from cartwheel.llm import hashing, passages
from cartwheel.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def own(k, n, mark):
    return " ".join(f"{mark}{k}x{j}" for j in range(n))


LINES = "\n".join(" ".join(f"line{i}w{j}" for j in range(7)) for i in range(10))
SENTENCE = " ".join(f"long{j}" for j in range(60)) + "."
INSIDE = " ".join(f"part{j}" for j in range(55))
PLANTED = [("short lines", lambda k: f"{own(k, 9, 'a')}.\n{LINES}\n{own(k, 9, 'b')}.", LINES),
           ("one sentence", lambda k: f"{own(k, 9, 'a')}. {SENTENCE} {own(k, 9, 'b')}.", SENTENCE),
           ("inside a sentence", lambda k: f"{own(k, 20, 'a')} {INSIDE} {own(k, 20, 'b')}.", INSIDE)]


@pytest.mark.parametrize("name, text, passage", PLANTED, ids=[p[0] for p in PLANTED])
def test_planted_passages_go(spark, name, text, passage):
    texts = [(k, text(k)) for k in range(6)]
    got = {r.doc_id: r.text for r in passages.remove_repeated_passages(frame(spark, texts)).collect()}
    assert got[0] == texts[0][1]
    words = set(passage.split())
    for k in range(1, 6):
        left = [w for w in got[k].split() if w in words]
        assert len(left) <= (30 if name == "inside a sentence" else 0), (name, k, left)
        assert [w for w in got[k].split() if w not in words] == [w for w in texts[k][1].split() if w not in words]


def brute(texts):
    """The rule word by word: units, then the shortest runs forward and backward."""
    def hashed(w):
        data, off = hashing.utf8(passages.pa.array([w]))
        s, e, _ = hashing.words(data, off)
        return int(hashing.mix(hashing.hash_words(data, s, e) + hashing.GOLDEN)[0])

    first, out = {}, {}
    for i, t in sorted(texts):
        spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
        words = [t[a:b] for a, b in spans]
        sents, cur = [], []
        for k, w in enumerate(words):
            cur.append(k)
            if k + 1 == len(words) or w[-1] in ".!?" or "\n" in t[spans[k][1]:spans[k + 1][0]]:
                sents.append(cur)
                cur = []
        parts = []
        for s in sents:
            cut = {s[0]}
            if len(s) > 16:
                keys = {k: hashed(words[k]) for k in s}
                for x in range(len(s) - 7):
                    least = min(keys[k] for k in s[x:x + 8])
                    cut |= {k for k in s[x:x + 8] if keys[k] == least}
            parts += sorted(cut)
        ends = parts[1:] + [len(words)]
        found = set()
        for k in range(len(parts)):
            for j in range(k + 2, len(parts) + 1):
                if ends[j - 1] - parts[k] >= 16:
                    found.add((k, j))
                    break
            for b in range(k - 1, -1, -1):
                if ends[k] - parts[b] >= 16:
                    found.add((b, k + 1))
                    break
        gone = set()
        for k, j in sorted(found):
            key = tuple(words[parts[k]:ends[j - 1]])
            if first.setdefault(key, (i, k)) != (i, k):
                gone |= set(range(k, j))
        begin = [0] + [spans[p][0] for p in parts[1:]] + [len(t)]
        kept = "".join(t[begin[k]:begin[k + 1]] for k in range(len(parts)) if k not in gone) if parts else t
        out[i] = (kept, len(parts), len(gone))
    return out


def test_passages_match_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {i: (r[0].text, r[0].n_units, r[0].n_removed) for i, r in rows(QUERIES["op10_repeated_passages"](spark, SF)).items()}
    assert got == brute(texts.items())
    # nothing that goes with pairs of sentences stays
    pairs = without_repeats(texts.items())
    assert all(len(got[i][0].split()) <= len(pairs[i][0].split()) for i in texts)


def test_passages_odd_rows(spark, odd, none):  # noqa: F811
    got = rows(passages.remove_repeated_passages(odd))
    assert got[1][0].text is None and got[2][0].text == "" and got[3][0].text == "   \n\t " and got[3][0].n_units == 0
    assert got[8][0].text == got[8][1].text == LONG[:len(got[8][0].text)] and got[8][0].n_removed > 0
    assert sum(map(len, got.values())) == odd.count() and all(r.n_removed == 0 for r in got[None])
    assert passages.remove_repeated_passages(none).count() == 0
    part = "This sentence has quite a few words in it. And this one has nearly as many words too.\n"
    again = passages.remove_repeated_passages(frame(spark, [(1, part + "Between.\n" + part), (1, "Other. " + part)])).collect()
    assert sorted(r.text for r in again) == sorted([part + "Between.\n", "Other. " + part])
