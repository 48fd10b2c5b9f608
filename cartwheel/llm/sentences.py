"""Substring deduplication by sliding sentence spans.

From every sentence, forward and backward, the shortest run of SPAN sentences
or more that has MIN_WORDS words is hashed, and the hashes of all documents are
joined.  Of equal runs the first, by document id and then position, stays; a
sentence covered by any other one is removed, with the white space after it.
A stretch of whole sentences with MIN_WORDS words or more that repeats is
thereby covered, whatever the length of its sentences: each of its sentences
begins or ends a run inside it.  One long sentence alone, and the parts of
sentences that a passage begins or ends inside, are ``passages``' work.

A sentence ends at white space after ``.``, ``!`` or ``?``, or at a line end.
Sentences are compared with every run of white space as one space.

Scale: the runs of all texts are computed once and written to the shared
folder, about a dozen bytes each, not their text.  Equal runs are reduced by a
min-aggregate, which combines before the shuffle, and joined back by hash, where
AQE can split a run that a third of all documents share.  Texts are shuffled
once, by id, to meet the sentences to remove, which are few numbers a document.

Cases: a null text stays null and an empty one empty; rows with equal ids are
one document and not held against each other, and what is removed from a row
is found by its id and text; a row without an id has no place in the order, so
it stays as it is; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .common import checkpoint, map_arrow, stored, table

SPAN, MIN_WORDS = 2, 16
_BREAK = re.compile(r"[.!?]\s+|\n\s*")


def sentence_starts(text: str) -> list[int]:
    """Where sentences start; the first at 0, if there is any text."""
    starts = [0] if text else []
    for m in _BREAK.finditer(text):
        if m.end() < len(text) and m.end() > starts[-1]:
            starts.append(m.end())
    return starts


def shortest_runs(words: np.ndarray, span: int = SPAN, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First sentence and end of the runs to compare, given the number of words of each sentence."""
    n = len(words)
    upto = np.concatenate(([0], np.cumsum(words)))
    k = np.arange(n)
    to = np.maximum(k + span, np.searchsorted(upto, upto[:-1] + min_words))
    since = np.minimum(k + 1 - span, np.searchsorted(upto, upto[1:] - min_words, "right") - 1)
    a, b = np.concatenate((k[to <= n], since[since >= 0])), np.concatenate((to[to <= n], k[since >= 0] + 1))
    both = np.unique(a * (n + 1) + b)
    return both // (n + 1), both % (n + 1)


def run_hashes(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first sentence and number of sentences of every run of a text."""
    starts = sentence_starts(text)
    parts = [text[a:b].split() for a, b in zip(starts, starts[1:] + [len(text)])]
    a, b = shortest_runs(np.array([len(p) for p in parts], np.int64))
    if not len(a):
        return np.empty(0, np.uint64), a, b
    hashes = H.mix(np.array([xxhash.xxh3_64_intdigest(" ".join(p)) for p in parts], np.uint64))
    # sentence hashes as digits of a number in base BASE, modulo 2^64
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * H._powers(H.BASE, len(hashes)), dtype=np.uint64)))
    value = (sums[b] - sums[a]) * H._powers(H._INVERSE, len(hashes))[a]
    return H.combine([H.mix(value), (b - a).astype(np.uint64)]), a, b - a


def _runs(batch: pa.RecordBatch) -> pa.RecordBatch:
    columns: list[list[np.ndarray]] = [[] for _ in range(6)]
    for doc, row, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text"))):
        if not text:
            continue
        h, at, n = run_hashes(text)
        first = np.zeros(len(h), bool)
        first[np.unique(h, return_index=True)[1]] = True
        for c, x in zip(columns, (h.view(np.int64), np.full(len(h), doc), np.full(len(h), row), at, n, ~first)):
            c.append(x)
    kinds = (np.int64, np.int64, np.int64, np.int32, np.int16, bool)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(k) if c else np.empty(0, k)) for c, k in zip(columns, kinds)],
                                      names=["h", "doc_id", "row", "place", "n", "again"])


def _named(docs: DataFrame) -> DataFrame:
    # rows of one id can differ, so a place is of a text
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("row", F.xxhash64("text"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``row``, ``places``: the sentences (first, number) of every run that is not the first of its kind."""
    found = map_arrow(_named(docs).filter("doc_id is not null"), _runs, "h long, doc_id long, row long, place int, n short, again boolean")
    with stored(found, "sentence-spans") as spans:
        first = (spans.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                 .filter("first < last").select("h", "first"))
        across = spans.filter("not again").join(first, "h").filter("doc_id > first").select("doc_id", "row", "place", "n")
        again = spans.filter("again").select("doc_id", "row", "place", "n")
        return checkpoint(across.unionByName(again).groupBy("doc_id", "row").agg(F.collect_set(F.struct("place", "n")).alias("places")))


def without(text: str, places: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the sentences at ``places``; how many there were and went."""
    starts = sentence_starts(text)
    gone = np.zeros(len(starts) + 1, np.int64)
    for p, n in set(places):
        gone[p] += 1
        gone[p + n] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    ends = starts[1:] + [len(text)]
    kept = "".join(text[a:b] for a, b, g in zip(starts, ends, gone.tolist()) if not g)
    return kept, len(starts), int(gone.sum())


def _remove(batch: pa.RecordBatch) -> pa.RecordBatch:
    out = []
    for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
        if not places:
            out.append((text, len(sentence_starts(text or "")), 0))
        else:
            out.append(without(text, [(p["place"], p["n"]) for p in places]))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()),
         pa.array([o[2] for o in out], pa.int64())], names=["doc_id", "text", "n_sentences", "n_removed"])


def remove_repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` without repeated passages, ``n_sentences``, ``n_removed`` of every row."""
    rows = _named(docs).join(repeated_spans(docs), ["doc_id", "row"], "left")
    return map_arrow(rows.select("doc_id", "text", "places"), _remove, "doc_id long, text string, n_sentences long, n_removed long")


def op10_sentence_spans(spark, sf_dir: str) -> DataFrame:
    return remove_repeated_spans(table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
WITH cut AS (
  SELECT doc_id, text, list_filter(string_split(regexp_replace(text, '([.!?]\s+|\n\s*)', '\1' || chr(1), 'g'), chr(1)),
                                   lambda p: p <> '') AS parts FROM documents),
p AS (
  SELECT doc_id, unnest(range(1, len(parts) + 1)) AS k, unnest(parts) AS part FROM cut),
k AS (
  SELECT doc_id, k, part, trim(regexp_replace(part, '\s+', ' ', 'g')) AS key FROM p),
c AS (
  SELECT *, CASE WHEN key = '' THEN 0 ELSE len(string_split(key, ' ')) END AS n FROM k),
upto AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY k) AS u FROM c),
ahead AS (
  SELECT a.doc_id, a.k AS first, min(b.k) AS last FROM upto a JOIN upto b
    ON a.doc_id = b.doc_id AND b.k > a.k AND b.u - a.u + a.n >= {MIN_WORDS} GROUP BY ALL),
behind AS (
  SELECT b.doc_id, max(a.k) AS first, b.k AS last FROM upto a JOIN upto b
    ON a.doc_id = b.doc_id AND b.k > a.k AND b.u - a.u + a.n >= {MIN_WORDS} GROUP BY b.doc_id, b.k),
run AS (SELECT * FROM ahead UNION SELECT * FROM behind),
span AS (
  SELECT r.doc_id, r.first, r.last, string_agg(c.key, chr(1) ORDER BY c.k) AS keys
  FROM run r JOIN c ON c.doc_id = r.doc_id AND c.k BETWEEN r.first AND r.last GROUP BY ALL),
again AS (
  SELECT *, row_number() OVER (PARTITION BY keys ORDER BY doc_id, first) AS nth FROM span),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS k FROM again WHERE nth > 1),
kept AS (
  SELECT c.doc_id, string_agg(CASE WHEN g.k IS NULL THEN c.part ELSE '' END, '' ORDER BY c.k) AS text,
         count(*) AS n_sentences, count(g.k) AS n_removed
  FROM c LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.k = c.k GROUP BY c.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       coalesce(kept.n_sentences, 0) AS n_sentences, coalesce(kept.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept USING (doc_id)
"""
