"""Toxicity scores by a factorization machine over hashed terms.

Terms are the words of a text and their beginnings of 4, 6 and 8 bytes, hashed
into 2^BITS buckets.  A term's value is (1 + log count) * idf, over the root of
the number of terms; idf counts all documents, labelled or not.  The score is the logistic of

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

whose last part learns pairs of terms that mean more together than alone; with
factors of length DIM it is computed in time proportional to the terms.

Fitting uses a bounded sample of labelled rows: at most TOXIC toxic and CLEAN
other ones, the first by a hash of the id, none of them held out (held out:
crc32 of the id as text, modulo 5, is 0).  Rows are weighted so that the sample
stands for all labelled rows, toxic ones COST times.  Only the text enters a
score; neither id, language, source nor label does.

Scale: the ids of the sample (a bounded number) are broadcast to the texts, so
no text is shuffled; terms of the sample go to the driver, which fits by AdaGrad;
scoring is one pass without a shuffle, and so are the document frequencies,
which a task counts in an array of 2^BITS numbers before they are summed.

Cases: a null or empty text has no terms and gets the score of the constant
w0; without labels, or with one class only, every text gets the smoothed share
of toxic labels.  A row without an id is scored and not held out.  Repeated
rows get equal scores; an empty table gives an empty result; further columns
are ignored; labels repeated for an id count once, as toxic if one of them is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .common import map_arrow, map_batches, steps, table

BITS, DIM = 18, 8
STARTS = (4, 6, 8)
TOXIC, CLEAN, COST = 4_000, 8_000, 3.0
EPOCHS, BATCH, RATE, RIDGE = 12, 64, 0.05, 1e-5
SEED = 1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def hashed_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and counts of the distinct terms of every row, and the row offsets."""
    data, off = H.utf8(pc.utf8_lower(pc.fill_null(column, "")))
    starts, ends, first = H.words(data, off, H.letter_or_digit)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    keys = []
    for k, length in enumerate((None, *STARTS)):
        longer = slice(None) if length is None else ends - starts > length
        s = starts[longer]
        h = H.hash_words(data, s, ends[longer] if length is None else s + length)
        keys.append((row[longer] << BITS) | (H.mix(h + H.times(k + 1)) >> np.uint64(64 - BITS)).astype(np.int64))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key & ((1 << BITS) - 1), count, np.searchsorted(key >> BITS, np.arange(len(off)))


class Machine:
    """Weights of a factorization machine, and the idf of its terms."""

    def __init__(self, w0: float = 0.0):
        n = 1 << BITS
        rng = np.random.default_rng(SEED)
        self.w0, self.w = w0, np.zeros(n, np.float32)
        self.v = rng.normal(0, 0.01, (n, DIM)).astype(np.float32)
        self.idf = np.ones(n, np.float32)

    def values(self, term: np.ndarray, count: np.ndarray, off: np.ndarray) -> np.ndarray:
        size = np.maximum(np.diff(off), 1)
        return ((1 + np.log(count)) * self.idf[term] * np.repeat(10 / np.sqrt(size), np.diff(off))).astype(np.float32)

    def parts(self, term: np.ndarray, x: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum of w0 and all terms, the factor sums of each row, and v * x of each term."""
        row = np.repeat(np.arange(len(off) - 1), np.diff(off))
        vx = self.v[term] * x[:, None]
        sums = np.stack([np.bincount(row, vx[:, f], len(off) - 1) for f in range(DIM)], axis=1)
        squares = np.bincount(row, (vx * vx).sum(axis=1), len(off) - 1)
        z = self.w0 + np.bincount(row, self.w[term] * x, len(off) - 1) + 0.5 * ((sums * sums).sum(axis=1) - squares)
        return z, sums, vx

    def scores(self, column: pa.Array) -> np.ndarray:
        term, count, off = hashed_terms(column)
        return logistic(self.parts(term, self.values(term, count, off), off)[0])

    def weigh(self, documents: int, seen: np.ndarray) -> None:
        """The idf of the terms, from the number of documents and that with each term."""
        self.idf = np.log((1 + documents) / (1 + seen)).astype(np.float32)

    def fit(self, term: np.ndarray, count: np.ndarray, off: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """AdaGrad over small batches of rows, in an order fixed by the seed."""
        rows = len(y)
        x = self.values(term, count, off)
        rng = np.random.default_rng(SEED)
        g0, gw, gv = 1e-6, np.full(1 << BITS, 1e-6, np.float32), np.full((1 << BITS, DIM), 1e-6, np.float32)
        for _ in range(EPOCHS):
            order = rng.permutation(rows)
            for lo in range(0, rows, BATCH):
                batch = order[lo:lo + BATCH]
                size = off[batch + 1] - off[batch]
                own = np.concatenate(([0], np.cumsum(size)))
                at = np.repeat(off[batch] - own[:-1], size) + np.arange(own[-1])
                t, xb, row = term[at], x[at], np.repeat(np.arange(len(batch)), size)
                z, sums, vx = self.parts(t, xb, own)
                d = (logistic(z) - y[batch]) * weight[batch] / len(batch)
                g0 += d.sum() ** 2
                self.w0 -= RATE * d.sum() / np.sqrt(g0)
                if not len(t):
                    continue
                used, back = np.unique(t, return_inverse=True)
                dx = d[row] * xb
                step = np.bincount(back, dx) + RIDGE * self.w[used]
                gw[used] += step * step
                self.w[used] -= RATE * step / np.sqrt(gw[used])
                pull = dx[:, None] * (sums[row] - vx)
                step = np.stack([np.bincount(back, pull[:, f]) for f in range(DIM)], axis=1) + RIDGE * self.v[used]
                gv[used] += step * step
                self.v[used] -= RATE * step / np.sqrt(gv[used])


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _terms(batch: pa.RecordBatch) -> pa.RecordBatch:
    term, count, off = hashed_terms(batch.column("text"))
    off = off.astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("toxic"), pa.ListArray.from_arrays(off, term.astype(np.int32)),
         pa.ListArray.from_arrays(off, count.astype(np.int32))], names=["doc_id", "toxic", "terms", "counts"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of a partition have each term; under key -1 how many there are."""
    seen, documents = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for s in steps(batch):
            term, _, _ = hashed_terms(s.column("text"))  # a term is listed once per row
            np.add.at(seen, term, 1)
            documents += s.num_rows
    some = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(seen[some], documents))], names=["term", "n"])


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of documents, and of those with each of the 2^BITS terms, over all texts."""
    found = (map_batches(docs.select("text"), _frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
             .toArrow())  # 2^BITS + 1 rows at most
    term, n = found["term"].to_numpy(), found["n"].to_numpy()
    seen = np.zeros(1 << BITS, np.int64)
    seen[term[term >= 0]] = n[term >= 0]
    return int(n[term < 0].sum()), seen


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    marked = (labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("toxic").cast("int").alias("toxic"))
              .filter("id is not null and toxic in (0, 1)").filter(~held_out(F.col("id")))
              .groupBy("id").agg(F.max("toxic").alias("toxic")))
    totals = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    share = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
    machine = Machine(float(np.log(share / (1 - share))))
    if len(totals) < 2:
        machine.v[:] = 0
        return machine
    first = [marked.filter(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(n) for c, n in ((1, TOXIC), (0, CLEAN))]
    chosen = first[0].unionByName(first[1])  # at most TOXIC + CLEAN ids
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["id"]).select("doc_id", "toxic", "text")
    got = map_arrow(rows, _terms, "doc_id long, toxic int, terms array<int>, counts array<int>").toArrow().sort_by(
        [("doc_id", "ascending")]).combine_chunks()
    if not got.num_rows:
        return machine
    y = got["toxic"].to_numpy().astype(float)
    terms, counts = got["terms"].combine_chunks(), got["counts"].combine_chunks()
    taken = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.where(y == 1, COST * totals[1] / taken[1], totals[0] / taken[0])
    off = np.concatenate(([0], np.cumsum(pc.list_value_length(terms).to_numpy()))).astype(np.int64)
    machine.weigh(*document_frequencies(docs))
    machine.fit(terms.flatten().to_numpy(), counts.flatten().to_numpy(), off, y, weight / weight.mean())
    return machine


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``."""
    machine = train(docs, labels)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(machine.scores(batch.column("text")).astype(np.float64))],
                                          names=["doc_id", "score"])

    scored = map_arrow(docs.select("doc_id", "text"), step, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
