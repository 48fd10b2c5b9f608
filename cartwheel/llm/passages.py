"""Removal of repeated passages of any layout: short lines, one long sentence, a start inside a sentence.

``sentences`` removes repeated runs of exactly two sentences, as its SQL says.
Here a run is as long as it has to be, and a long sentence is several units.

A sentence ends at white space after ``.``, ``!`` or ``?``, or at a line end.
One of more than MIN_WORDS words is cut before every word whose hash is the
least of some WINDOW neighbouring words, so equal words are cut alike wherever
they stand.  From every unit, forward and backward, the shortest run of two
units or more with MIN_WORDS words is hashed, and the hashes of all documents
are joined.  Of equal runs the first, by document id and then position, stays;
a unit covered by any other one is removed, with the white space after it.
Both directions are needed for the whole of a repeated stretch to be covered.
A passage that starts or ends inside a sentence may keep up to MIN_WORDS words
at that end.

Scale: as in ``sentences``; a run is 29 bytes in the shuffle, not its text.

Cases: a null text stays null and an empty one empty; a row without an id has
no place in the order, so it stays as it is; rows with equal ids are one
document and are not held against each other; an empty table gives an empty
result; further columns are ignored.  Words are divided by ASCII white space,
so a script written without spaces has long words and few of them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .common import map_arrow, table
from .sentences import MIN_WORDS

WINDOW = 8  # words, a power of two
_ENDS = np.isin(np.arange(256), list(b".!?"))


def _slide(x: np.ndarray, n: int, of: Callable) -> np.ndarray:
    """``of`` every ``n`` neighbours."""
    k = 1
    while k < n:
        x = of(x[:-k], x[k:])
        k *= 2
    return x


def _cuts(words: np.ndarray, sentence: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether a unit starts at each word of a long sentence, by the words around it alone."""
    if len(words) < WINDOW:
        return np.zeros(len(words), bool)
    key = H.mix(words + H.GOLDEN)
    least = _slide(key, WINDOW, np.minimum)
    least[~(long[:1 - WINDOW] & (sentence[:1 - WINDOW] == sentence[WINDOW - 1:]))] = 0  # neighbours are of one sentence
    edge = np.zeros(WINDOW - 1, np.uint64)
    best = _slide(np.concatenate((edge, least, edge)), WINDOW, np.maximum)
    return (best == key) & (best > 0)


def units(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and row offsets, start of each word, hash of each word, first word of each unit (and the
    number of words behind them), first unit of each row."""
    data, off = H.utf8(column)
    starts, ends, first = H.words(data, off)
    w = H.hash_words(data, starts, ends)
    n = len(starts)
    begins = np.zeros(n + 1, bool)
    if n:
        lines = np.concatenate(([0], np.cumsum(data == 10)))
        begins[1:n] = _ENDS[data[ends[:-1] - 1]] | (lines[starts[1:]] > lines[ends[:-1]])
    begins[first] = True
    sentence = np.cumsum(begins[:n])
    long = np.bincount(sentence, minlength=1)[sentence] > MIN_WORDS
    begins[:n] |= _cuts(w, sentence, long)
    begins[n] = True
    at = np.flatnonzero(begins)
    return data, off, starts, w, at, np.searchsorted(at, first)


def runs(w: np.ndarray, at: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first unit and number of units of every run to compare."""
    k = np.arange(len(at) - 1)
    row = np.searchsorted(first, k, "right") - 1
    to = np.maximum(k + 2, np.searchsorted(at, at[:-1] + MIN_WORDS))
    forward = to <= first[row + 1]
    end = k + 1
    since = np.minimum(end - 2, np.searchsorted(at, at[1:] - MIN_WORDS, "right") - 1)
    backward = since >= first[row]
    a, b = np.concatenate((k[forward], since[backward])), np.concatenate((to[forward], end[backward]))
    both = np.unique(a * 64 + (b - a))  # a unit has a word at least, so a run has MIN_WORDS units at most
    a, b = both // 64, both // 64 + both % 64
    # word hashes as digits of a number in base BASE, modulo 2^64
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(w * H._powers(H.BASE, len(w)), dtype=np.uint64))) if len(w) else np.zeros(1, np.uint64)
    inverse = H._powers(H._INVERSE, len(w)) if len(w) else np.zeros(0, np.uint64)
    value = (sums[at[b]] - sums[at[a]]) * inverse[at[a]]
    return H.combine([H.mix(value), (at[b] - at[a]).astype(np.uint64)]), a, b - a


def _runs(batch: pa.RecordBatch) -> pa.RecordBatch:
    _, _, _, w, at, first = units(batch.column("text"))
    h, a, n = runs(w, at, first)
    row = np.searchsorted(first, a, "right") - 1
    order = np.lexsort((a, h, row))
    again = np.zeros(len(h), bool)
    again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    take = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), batch.column("doc_id").take(take), batch.column("row").take(take),
         pa.array((a - first[row]).astype(np.int32)), pa.array(n.astype(np.int8)), pa.array(again)],
        names=["h", "doc_id", "row", "place", "n", "again"])


def _named(docs: DataFrame) -> DataFrame:
    # rows of one id can differ, so a place is of a text
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("row", F.xxhash64("text"))


def repeated_runs(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``row``, ``place`` (first unit), ``n`` (units) of every run that is not the first of its kind."""
    found = map_arrow(_named(docs).filter("doc_id is not null"), _runs,
                      "h long, doc_id long, row long, place int, n byte, again boolean")
    first = (found.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .filter("first < last").select("h", "first"))
    across = found.filter("not again").join(first, "h").filter("doc_id > first").select("doc_id", "row", "place", "n")
    return across.unionByName(found.filter("again").select("doc_id", "row", "place", "n"))


def _remove(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column("text").to_pylist()
    data, off, starts, _, at, first = units(batch.column("text"))
    count, removed = np.diff(first), np.zeros(len(texts), np.int64)
    for i, places in enumerate(batch.column("places").to_pylist()):
        if not places:
            continue
        gone = np.zeros(count[i] + 1, np.int64)
        for p in places:
            gone[p["place"]] += 1
            gone[p["place"] + p["n"]] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        removed[i] = gone.sum()
        begin = np.concatenate((starts[at[first[i]:first[i + 1]]], off[i + 1:i + 2]))
        begin[0] = off[i]
        raw = data[off[i]:off[i + 1]].tobytes()
        cut = (begin - off[i]).tolist()
        texts[i] = b"".join(raw[a:b] for a, b, g in zip(cut, cut[1:], gone.tolist()) if not g).decode()
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(count.astype(np.int64)), pa.array(removed)],
        names=["doc_id", "text", "n_units", "n_removed"])


def remove_repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` without repeated passages, ``n_units``, ``n_removed`` of every row."""
    places = repeated_runs(docs).groupBy("doc_id", "row").agg(F.collect_set(F.struct("place", "n")).alias("places"))
    return map_arrow(_named(docs).join(places, ["doc_id", "row"], "left").select("doc_id", "text", "places"), _remove,
                     "doc_id long, text string, n_units long, n_removed long")


def op10_repeated_passages(spark, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(table(spark, sf_dir, "documents"))
