"""Spelling variants: words one edit apart, each led to the common word it is a variant of.

Words one edit apart (one code point inserted, deleted or replaced) are found by
dynamic programming over sorted lists.  Along a sorted list, neighbours share
their longest common prefix (LCP), and so do their rows of the edit matrix: the
row of a prefix is computed once for all words that begin with it, a range of
the list.  Only the band of three cells around the diagonal can hold a distance
of one, so a row is three numbers.  A range is left as soon as its row exceeds
one edit; the words behind it are never looked at.  The rows of all queries of
a task are computed together, one code point of the list deeper at a time.

Which words meet: of two words one edit apart, the shorter having m code points,
both begin alike or both end alike for m // 2 of them, since the edit is in one
half only.  So a word is listed under its first and its last m // 2 code points,
for m its length and one less; the second list is sorted backwards, and the
scan starts below the prefix that all its words share.  A pair counts where it
begins alike, else where it ends alike, so it counts once.

Scale: counts are combined in the task, then by Spark.  A list is cut into
blocks of BLOCK words, and pairs of blocks are tasks; most lists are small, and
a task takes many of them.  Tasks return a count and the best word for each
query, never the pairs.  A form has ``ratio`` times the occurrences of its word,
so chains of forms are as long as the digits of the largest count, and doubling
follows them in a few joins.

Cases: null and empty texts have no words; repeated rows count again; a null id
is written as nothing.  Words with one count are ordered by code points.  A very
long run is one word.  An empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, map_batches, table

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
BLOCK = 8_192           # words of a block of a list, and queries compared together
HELD = 300_000          # different words counted before they are handed on


# ---------------------------------------------------------------- vocabulary

def _counted(batches: Iterator[pa.RecordBatch], min_length: int, delete_every: int | None) -> Iterator[pa.RecordBatch]:
    run = re.compile(f"[A-Za-zÀ-ÿ]{{{min_length},}}")  # a shorter run makes no word
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return b

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            prefix = f"{'' if doc is None else doc}:".encode()
            for word, n in Counter(run.findall(text.encode().lower().decode())).items():  # bytes lower A-Z alone
                if delete_every:
                    h = zlib.crc32(prefix + word.encode())
                    if h % delete_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                held[word] += n
            if len(held) > HELD:
                yield out()
    yield out()


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, delete_every: int | None = None) -> DataFrame:
    """``word``, ``n`` of the lower-cased runs of Latin letters in all texts.

    ``delete_every``: where it divides the crc32 of ``<doc_id>:<run>``, the run loses the code point at that crc32
    modulo its length, which plants misspellings."""
    counted = map_batches(docs.select("doc_id", "text"), partial(_counted, min_length=min_length, delete_every=delete_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ---------------------------------------------------------------- sorted lists

class Words:
    """Words as code points in one array."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)

    def at(self, word: np.ndarray, place: np.ndarray | int) -> np.ndarray:
        """The code point at ``place`` of each word, -1 behind its end."""
        inside = (place >= 0) & (place < self.size[word])
        if not len(self.flat):
            return np.full(len(word), -1)
        return np.where(inside, self.flat[np.where(inside, self.first[word] + place, 0)], -1)


def common_prefixes(w: Words, begins: np.ndarray) -> np.ndarray:
    """Length of the prefix that each word shares with the one before it; -1 where a list begins."""
    lcp = np.full(len(w.size), -1)
    pair = np.flatnonzero(~begins)
    depth = 0
    while len(pair):
        a, b = w.at(pair, depth), w.at(pair - 1, depth)
        same = (a == b) & (a >= 0)
        lcp[pair[~same]] = depth
        pair, depth = pair[same], depth + 1
    return lcp


def one_edit(listed: Words, lcp: np.ndarray, queries: Words, start: np.ndarray, end: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, listed word) that are one edit apart.

    Query i scans the words from ``start[i]`` to ``end[i]``, sorted, which begin with its first ``depth`` code points."""
    q = np.arange(len(start))
    below, on, above = (np.full(len(q), x, np.int8) for x in (1, 0, 1))  # edits to the query's first depth - 1, depth, depth + 1
    found = []
    while len(q):
        # a word that ends here is the first of its range
        rest = queries.size[q] - depth
        last = np.where(rest == 0, on, np.where(rest == -1, below, np.where(rest == 1, above, 2)))
        hit = (listed.size[start] == depth) & (last == 1)
        found.append((q[hit], start[hit]))
        # the ranges one code point deeper begin where neighbours share no more than the prefix so far
        borders = np.flatnonzero(lcp <= depth)
        lo, hi = np.searchsorted(borders, start), np.searchsorted(borders, end)
        item = np.repeat(np.arange(len(q)), hi - lo)
        nth = np.arange(len(item)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[item]
        begin = borders[nth]
        stop = np.append(borders, len(lcp))[nth + 1]
        go = listed.size[begin] > depth
        item, begin, stop = item[go], begin[go], stop[go]
        owner = q[item]
        c = listed.at(begin, depth)
        b, o, a = below[item], on[item], above[item]
        size = queries.size[owner]
        new_below = np.where(depth <= size, np.minimum(b + (c != queries.at(owner, depth - 1)), o + 1), 2)
        new_on = np.where(depth + 1 <= size, np.minimum(np.minimum(o + (c != queries.at(owner, depth)), a + 1), new_below + 1), 2)
        new_above = np.where(depth + 2 <= size, np.minimum(a + (c != queries.at(owner, depth + 1)), new_on + 1), 2)
        alive = np.minimum(np.minimum(new_below, new_on), new_above) <= 1
        q, start, end = owner[alive], begin[alive], stop[alive]
        below, on, above = (np.minimum(x[alive], 2).astype(np.int8) for x in (new_below, new_on, new_above))
        depth += 1
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (np.empty(0, np.int64),) * 2


def _compare(words: list[str], n: list[int], asks: np.ndarray, listed: np.ndarray, task: np.ndarray, half: int, back: np.ndarray) -> pa.RecordBatch:
    """For each asking row its number of near words and the best, over the tasks of one batch (rows by task, then word)."""
    at = np.flatnonzero(listed)
    lists = Words([words[i] for i in at.tolist()])
    owner = task[at]
    begins = np.ones(len(at), bool)
    begins[1:] = owner[1:] != owner[:-1]
    ask = np.flatnonzero(asks)
    lo, hi = np.searchsorted(owner, task[ask]), np.searchsorted(owner, task[ask], "right")
    more = hi - lo > listed[ask]  # somebody else than the word itself
    ask, lo, hi = ask[more], lo[more], hi[more]
    a, b = one_edit(lists, common_prefixes(lists, begins), Words([words[i] for i in ask.tolist()]), lo, hi, half)
    a, b = ask[a], at[b]
    size = np.array([len(w) for w in words])
    mine = np.minimum(size[a], size[b]) // 2 == half  # pairs of other lengths have lists of their own
    count: dict[int, int] = {}
    best: dict[int, tuple[int, str]] = {}
    for i, j in zip(a[mine].tolist(), b[mine].tolist()):
        x, y = words[i], words[j]
        if back[i]:
            if x[-half:] == y[-half:]:  # they begin alike, too
                continue
            y = y[::-1]
        count[i] = count.get(i, 0) + 1
        key = (-n[j], y)
        if i not in best or key < best[i]:
            best[i] = key
    rows = list(count)
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i][::-1] if back[i] else words[i] for i in rows], pa.string()), pa.array([count[i] for i in rows], pa.int64()),
         pa.array([-best[i][0] for i in rows], pa.int64()), pa.array([best[i][1] for i in rows], pa.string())],
        names=["word", "n_near", "best_n", "best"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by half, task and word; whole tasks are gathered up to BLOCK rows or more."""
    half, rows = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        if len(rows) > 1:
            words, n, asks, listed, task, back = (list(c) for c in zip(*rows))
            numbers = np.cumsum([0] + [x != y for x, y in zip(task[1:], task[:-1])])
            yield _compare(words, n, np.array(asks), np.array(listed), numbers, half, np.array(back))
        rows.clear()

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("half", "key_word", "n", "asks", "listed", "task", "back")]
        for h, *row in zip(*columns):
            if h != half or (len(rows) >= BLOCK and row[4] != rows[-1][4]):
                yield from flush()
                half = h
            rows.append(row)
    yield from flush()


def list_tasks(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``half``, ``task``, ``key_word`` (backwards in the second kind of list), ``n``, ``asks``, ``listed``, ``back``."""
    size = F.length("word")
    halves = F.array_distinct(F.filter(F.array(size, size - 1), lambda m: m >= min_length))
    kinds = F.array(F.struct(F.lit(False).alias("back"), F.col("word").alias("key_word")),
                    F.struct(F.lit(True).alias("back"), F.reverse("word").alias("key_word")))
    w = (words.select("word", "n", F.explode(F.array_distinct(F.transform(halves, lambda m: F.floor(m / 2).cast("int")))).alias("half"))
         .select("n", "half", F.explode(kinds).alias("k")).select("n", "half", "k.*")
         .withColumn("stem", F.substr("key_word", F.lit(1), F.col("half"))))
    stem = ["back", "half", "stem"]
    blocks = w.groupBy(*stem).agg(F.count("*").alias("words")).filter("words > 1").withColumn("blocks", F.ceil(F.col("words") / BLOCK).cast("int"))
    w = w.join(blocks.drop("words"), stem).withColumn("block", F.pmod(F.xxhash64("key_word"), "blocks").cast("int"))
    w = w.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = F.col("block") == F.col("other")

    def role(asks: bool, listed: bool):
        return F.struct(F.lit(asks).alias("asks"), F.lit(listed).alias("listed"),
                        *([F.col("block").alias("a"), F.col("other").alias("b")] if asks else [F.col("other").alias("a"), F.col("block").alias("b")]))

    roles = F.when(own, F.array(role(True, True))).otherwise(F.array(role(True, False), role(False, True)))
    return w.withColumn("r", F.explode(roles)).select(
        "half", F.xxhash64(*stem, "r.a", "r.b").alias("task"), "key_word", "n", "r.asks", "r.listed", "back")


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``word``, ``n_near``, ``best``, ``best_n`` of every word of ``words`` (``word``, ``n``) that has near words."""
    tasks = list_tasks(words, min_length)
    dealt = tasks.repartition("task").sortWithinPartitions("half", "task", "key_word")
    found = map_batches(dealt, _scan, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("best")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.n")).alias("best_n")))


def spelling_variants(words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for ``words`` (``word``, once each, and ``n``).

    A word's form is its commonest near word, if that occurs ``ratio`` times as often; its root is the last of its
    form's forms, itself if it has none."""
    if ratio < 2:
        raise ValueError("a form must be commoner than its word")
    near = near_words(words, min_length)
    common = F.col("best_n") >= ratio * F.col("n")
    formed = checkpoint(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(common, F.col("best")).alias("form"), F.when(common, F.col("best_n")).alias("form_n")))
    top = formed.agg(F.max("n")).first()[0] or 1
    steps = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(1.0, math.log(top, ratio) + 1)))):  # chains of forms are no longer than that
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = checkpoint(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return (formed.join(steps, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    words = checkpoint(vocabulary(table(spark, sf_dir, "documents"), delete_every=31))
    return spelling_variants(words)
