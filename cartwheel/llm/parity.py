"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct 5-word shingles.  Two documents link when
the Jaccard similarity of their sets is at least ``percent`` (80 in op12), which
is to say that their symmetric difference has at most
(a + b) (100 - percent) / (100 + percent) shingles.

A parity sketch is a row of bits; every shingle flips the bit that its hash
names.  Shingles that both documents have flip the same bits, so the Hamming
distance of two sketches is never more than the symmetric difference.

1. *Size bands.*  Band k holds sizes from 2^k to 2^(k+1) (wider bands below
   50 %).  A link joins a band with itself or the next one, so a document is
   sketched in the window of its own band and, if a partner can be that large,
   in that of the next.
2. *Pigeonhole.*  In a window the sketch is cut into more parts than a link may
   have differences (at most d), each part with POSITIONS bits of its own, few
   of them set; a part is named by the hash of its set bits.  Parts that no
   difference falls into are equal, and there are ``parts - d`` of them at
   least.  So a document may leave out its ``parts - d - 1`` commonest parts, by
   one order for all documents (parts of one shingle or none first, then by the
   number of documents with the same part): the rarest of the equal parts is
   kept by both.  A text whose parts are mostly its own drops out here.
3. Kept parts are joined: every document is tied to the least id with the same
   part (rows follow the parts, never pairs).  Components of ties are the
   candidate groups; no link can leave one.
4. *Verification* of a group in tasks of bounded size: first every member
   against the group's least id, then only the documents this leaves over
   against the group, in blocks by size.  A task compares dense parity sketches
   by popcount and then the full sets, and skips pairs that are connected already.
5. Components of the verified links.

Nothing is approximate but the 64-bit hashes of shingles and parts.

Scale: a document of n shingles makes about 0.4 n rows of 16 bytes.  A part
that very many documents share costs one aggregate, combined before the
shuffle, and an equi-join that AQE can split; its rows mostly go in step 2.
Equal sets are one document from the start.

Cases: a null or empty text, or one without words, has an empty set and is
linked with nothing.  Fewer than five words make one shingle of the whole
sequence.  Rows with equal ids count as one document.  A row without an id is
linked with nothing and has no component.  An empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashing as H
from .common import checkpoint, map_arrow, map_batches, steps, table
from .components import connected_components
from .minhash import shingle_sets

PERCENT = 80
RATIO = 2               # of the sizes in a band
POSITIONS = 1 << 16     # bits of a part
SPARE = 1.15            # parts for each difference and one more
BLOCK = 150_000         # shingles in a block of a verification task, on average
DOCUMENTS = 2_000       # documents in a block
SKETCH_BITS = 1 << 29   # dense sketches of a task
_LARGEST = 1 << 40      # shingles


def band_edges(percent: int) -> np.ndarray:
    """Least size of every band."""
    ratio = max(100 / percent, RATIO)
    count = int(np.log(_LARGEST) / np.log(ratio)) + 3
    return np.ceil(ratio ** np.arange(count) - 1e-9).astype(np.int64)


def allowed(a, b, percent: int):
    """The most shingles that linked sets of ``a`` and ``b`` can differ by."""
    return (a + b) * (100 - percent) // (100 + percent)


def windows(n: np.ndarray, percent: int, edges: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the own and the next window: its number, its parts, the differences a link may have (-1: no link)."""
    band = np.searchsorted(edges, n, "right") - 1
    widest = n * 100 // percent  # the largest partner
    out = []
    for t in (0, 1):
        high = edges[band + t + 1] - 1
        most = np.minimum(high, widest)
        parts = np.maximum(2, np.ceil(SPARE * (allowed(high, high, percent) + 1))).astype(np.int64)
        d = np.where(most >= (n if t == 0 else edges[band + 1]), allowed(n, most, percent), -1)
        # equal sets are one document already, so a link needs a difference
        out.append((band + t, parts, np.where((n > 0) & (d > 0), d, -1)))
    return out


def part_keys(elements: np.ndarray, off: np.ndarray, window: np.ndarray, parts: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the parts to compare, row after row, the offsets of the rows, and
    how many of a row's keys it may still leave out."""
    rows = len(off) - 1
    takes = d >= 0
    row = np.repeat(np.arange(rows), np.where(takes, np.diff(off), 0))
    x = elements[np.repeat(takes, np.diff(off))] if rows else elements
    parts = np.where(takes, parts, 0)
    first = np.concatenate(([0], np.cumsum(parts)))
    h = H.mix(x ^ H.times(3))
    slot = first[row] + (((h >> np.uint64(32)) * parts[row].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    flip = H.mix((h & np.uint64(POSITIONS - 1)) + H.times(5))  # the hash of one set bit; two flips cancel
    key = np.zeros(first[-1], np.uint64)
    np.bitwise_xor.at(key, slot, flip)
    filled = np.bincount(slot, minlength=first[-1]) if len(slot) else np.zeros(first[-1], np.int64)
    owner = np.repeat(np.arange(rows), parts)
    place = np.arange(first[-1]) - first[owner] if rows else np.empty(0, np.int64)
    key = H.combine([key, place.astype(np.uint64), window[owner].astype(np.uint64)], seed=7) if rows else key
    spare = np.where(takes, parts - d - 1, 0)
    # parts of one shingle or none are the commonest: they go first, in the order of their keys
    light = np.flatnonzero(filled <= 1)
    light = light[np.lexsort((key[light], owner[light]))]
    nth = np.arange(len(light)) - np.searchsorted(owner[light], owner[light])
    gone = light[nth < spare[owner[light]]]
    keep = np.ones(len(key), bool)
    keep[gone] = False
    left = np.bincount(owner[keep], minlength=rows) if rows else np.empty(0, np.int64)
    return key[keep], np.concatenate(([0], np.cumsum(left))), spare - np.bincount(owner[gone], minlength=rows)


def _features(batch: pa.RecordBatch, percent: int, edges: np.ndarray) -> pa.RecordBatch:
    elements, off = shingle_sets(batch.column("text"))
    n = np.diff(off)

    def total(x: np.ndarray) -> np.ndarray:  # order-free, so equal for equal sets
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))
        return (sums[off[1:]] - sums[off[:-1]]).view(np.int64)

    keys, ends, spares = [], [np.zeros(len(n), np.int64)], []
    for window, parts, d in windows(n, percent, edges):
        key, at, spare = part_keys(elements, off, window, parts, d)
        # the last bit tells the window, for the two of a document are neighbours
        keys.append((np.repeat(np.arange(len(n)), np.diff(at)), (key & ~np.uint64(1)) | (np.repeat(window, np.diff(at)) & 1).astype(np.uint64)))
        ends.append(np.diff(at))
        spares.append(pa.array(spare.astype(np.int32)))
    owner = np.concatenate([k[0] for k in keys])
    key = np.concatenate([k[1] for k in keys])[np.argsort(owner, kind="stable")]
    at = np.concatenate(([0], np.cumsum(sum(ends))))
    odd = (windows(n, percent, edges)[0][0] & 1).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(n), pa.array(total(H.mix(elements))), pa.array(total(H.mix(elements ^ H.GOLDEN))),
         pa.array(odd), *spares, pa.ListArray.from_arrays(at.astype(np.int32), key.view(np.int64))],
        names=["doc_id", "n_shingles", "f1", "f2", "odd", "spare0", "spare1", "keys"])


def features(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
                     partial(_features, percent=percent, edges=band_edges(percent)),
                     "doc_id long, n_shingles long, f1 long, f2 long, odd int, spare0 int, spare1 int, keys array<long>")


def candidate_ties(feats: DataFrame, reps: DataFrame) -> DataFrame:
    """``doc_id``, ``head``: every document of ``reps`` with the least id that kept the same part.

    ``reps``: ``doc_id`` (once each), ``odd``, ``spare0``, ``spare1``.  The copies of a document count where parts
    are counted, so that no arrays are shuffled to leave them out, and go with the rows of what nobody shares."""
    rows = feats.filter("doc_id is not null").select("doc_id", F.explode("keys").alias("h"))
    common = rows.groupBy("h").agg(F.count("*").alias("documents")).filter("documents > 1")
    next_ = F.col("h").bitwiseAND(F.lit(1)) != F.col("odd")  # a part of the next window
    order = Window.partitionBy("doc_id", "next").orderBy(F.desc("documents"), "h")  # parts of one document
    kept = checkpoint(rows.join(common, "h").join(reps, "doc_id").withColumn("next", next_)
                      .withColumn("nth", F.row_number().over(order))
                      .filter(F.col("nth") > F.when(F.col("next"), F.col("spare1")).otherwise(F.col("spare0"))).select("doc_id", "h"))
    heads = kept.groupBy("h").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("tail")).filter("head < tail").drop("tail")
    return kept.join(heads, "h").filter("doc_id > head").select("doc_id", "head").distinct()


# ---------------------------------------------------------------- verification

def _sketches(elements: np.ndarray, off: np.ndarray, bits: int) -> np.ndarray:
    """Dense parity sketches of ``bits`` bits, as rows of 64-bit words."""
    rows = len(off) - 1
    place = (H.mix(elements ^ H.times(9)) & np.uint64(bits - 1)).astype(np.int64)
    out = np.zeros((rows, bits // 64), np.uint64)
    at = np.repeat(np.arange(rows), np.diff(off)) * (bits // 64) + place // 64
    np.bitwise_xor.at(out.reshape(-1), at, np.uint64(1) << (place % 64).astype(np.uint64))
    return out


def verified(ids: list[int], label: list[int], left: np.ndarray, right: np.ndarray, elements: np.ndarray, off: np.ndarray,
             percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between rows ``left`` and rows ``right`` of different labels, as many as join their labels."""
    size = np.diff(off)
    most = int(allowed(int(size.max()), int(size.max()), percent)) if len(size) else 0
    # shorter sketches are still a lower bound
    bits = min((8 * most + 1).bit_length(), (SKETCH_BITS // max(1, len(size))).bit_length() - 1)
    sketch = _sketches(elements, off, 1 << max(9, bits))
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    edges = []
    other, sizes = sketch[right], size[right]
    for i in left.tolist():
        if not size[i]:
            continue
        limit = allowed(size[i], sizes, percent)
        near = np.flatnonzero((np.bitwise_count(other ^ sketch[i]).sum(axis=1, dtype=np.int64) <= limit)
                              & (np.abs(sizes - size[i]) <= limit) & (sizes > 0))
        own = elements[off[i]:off[i + 1]]
        for j in right[near].tolist():
            a, b = root(label[i]), root(label[j])
            if a == b:
                continue
            both = int(np.isin(own, elements[off[j]:off[j + 1]], assume_unique=True).sum())
            if 100 * both >= percent * (int(size[i]) + int(size[j]) - both):
                up[max(a, b)] = min(a, b)
                edges.append((ids[i], ids[j]))
    return edges


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by ``task``: a task's rows are gathered, then compared."""
    task, ids, label, side, parts = None, [], [], [], []
    edges: list[tuple[int, int]] = []

    def flush() -> None:
        probe = np.array(side, bool)
        if probe.any() and not probe.all():
            off = np.zeros(len(parts) + 1, np.int64)
            np.cumsum([len(p) for p in parts], out=off[1:])
            edges.extend(verified(ids, label, np.flatnonzero(probe), np.flatnonzero(~probe), np.concatenate(parts), off, percent))

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())],
                                          names=["a", "b"])

    for batch in batches:
        for s in steps(batch):
            elements, off = shingle_sets(s.column("text"))
            for i, (t, d, la, pr) in enumerate(zip(*(s.column(c).to_pylist() for c in ("task", "node", "label", "probe")))):
                if t != task:
                    flush()
                    task, ids, label, side, parts = t, [], [], [], []
                ids.append(d)
                label.append(la)
                side.append(pr)
                parts.append(elements[off[i]:off[i + 1]])
        if edges:
            yield out()
            edges.clear()
    flush()
    yield out()


def _links(docs: DataFrame, work: DataFrame, percent: int) -> DataFrame:
    """Links found by the tasks in ``work`` (``node``, ``label``, ``task``, ``probe``)."""
    text = docs.select(F.col("doc_id").cast("bigint").alias("node"), "text").filter("node is not null")
    rows = text.join(work, "node").select("task", "node", "label", "probe", "text")
    return map_batches(rows.repartition("task").sortWithinPartitions("task"), partial(_verify, percent=percent), "a long, b long")


def _blocks(n_shingles: str = "n_shingles"):
    """How many blocks the rows of a group make."""
    return F.greatest(F.ceil(F.sum(n_shingles) / BLOCK), F.ceil(F.count("*") / DOCUMENTS)).cast("int")


def _numbers(n):
    return F.explode(F.sequence(F.lit(0), n - 1))


def star_tasks(members: DataFrame) -> DataFrame:
    """Every member of a group against the group's least id, in chunks."""
    chunks = members.groupBy("component").agg(_blocks().alias("chunks"))
    heads = chunks.select(F.col("component").alias("node"), "component", _numbers(F.col("chunks")).alias("chunk"), F.lit(True).alias("probe"))
    rest = (members.filter("node <> component").join(chunks, "component")
            .select("node", "component", F.pmod(F.xxhash64("node"), "chunks").cast("int").alias("chunk"), F.lit(False).alias("probe")))
    return heads.unionByName(rest).select("node", F.col("node").alias("label"), F.xxhash64("component", "chunk").alias("task"), "probe")


def rest_tasks(members: DataFrame, percent: int) -> DataFrame:
    """What is not linked to its group's least id against all of the group, block by block.

    ``members``: ``node``, ``component``, ``n_shingles``, ``label`` (``component`` where linked to it).  A link
    needs sizes within ``percent``, so it stays in one size class or joins two neighbours."""
    step = max(float(-np.log(percent / 100)), 1e-6)
    left_over = F.col("label") != F.col("component")
    open_ = members.filter(left_over).select("component").distinct()
    m = members.join(open_, "component", "left_semi").withColumn("class", F.floor(F.log("n_shingles") / step + 1e-9))
    plan = m.groupBy("component", "class").agg(
        _blocks().alias("all"), F.greatest(F.ceil(F.sum(F.when(left_over, F.col("n_shingles"))) / BLOCK),
                                           F.ceil(F.count(F.when(left_over, 1)) / DOCUMENTS)).cast("int").alias("open"))
    m = m.join(plan, ["component", "class"])
    other = plan.select("component", F.col("class").alias("other"), F.col("all").alias("other_all"), F.col("open").alias("other_open"))
    m = m.withColumn("other", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1))).join(other, ["component", "other"])

    def block(n):
        return F.pmod(F.xxhash64("node"), n).cast("int")

    probes = m.filter(left_over).select(
        "node", "label", "component", F.col("class").alias("c1"), block(F.col("open")).alias("b1"),
        F.col("other").alias("c2"), _numbers(F.col("other_all")).alias("b2"), F.lit(True).alias("probe"))
    base = m.filter(F.col("other_open") > 0).select(
        "node", "label", "component", F.col("other").alias("c1"), _numbers(F.col("other_open")).alias("b1"),
        F.col("class").alias("c2"), block(F.col("all")).alias("b2"), F.lit(False).alias("probe"))
    return probes.unionByName(base).select("node", "label", F.xxhash64("component", "c1", "b1", "c2", "b2").alias("task"), "probe")


def jaccard_links(docs: DataFrame, feats: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """``a``, ``b``: links that join all that is linked among ``reps``."""
    groups = connected_components(candidate_ties(feats, reps), "doc_id", "head")
    sizes = feats.select(F.col("doc_id").alias("node"), "n_shingles").filter("n_shingles > 0").distinct()  # an id can have several
    members = checkpoint(groups.join(sizes, "node"))
    star = checkpoint(_links(docs, star_tasks(members), percent).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labelled = (members.join(star.select(F.col("b").alias("node"), F.col("a").alias("linked")).distinct(), "node", "left")
                .withColumn("label", F.coalesce("linked", "node")).drop("linked"))
    return star.unionByName(_links(docs, rest_tasks(labelled, percent), percent))


def jaccard_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row of ``docs``, linked from ``percent`` on."""
    feats = checkpoint(features(docs, percent))
    key = ["n_shingles", "f1", "f2"]
    named = feats.filter("doc_id is not null and n_shingles > 0").select("doc_id", *key, "odd", "spare0", "spare1")
    classes = named.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    classed = named.join(classes, key)
    # an id of several sets has no order of its own parts, so it keeps them all
    several = (F.min("f1") != F.max("f1")) | (F.min("f2") != F.max("f2"))
    ids = named.groupBy("doc_id").agg(several.alias("several"), *[F.max(c).alias(c) for c in ("odd", "spare0", "spare1")])
    reps = checkpoint(ids.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id")
                      .select("doc_id", "odd", *[F.when(F.col("several"), 0).otherwise(F.col(c)).alias(c) for c in ("spare0", "spare1")]))
    links = jaccard_links(docs, feats, reps, percent)
    # rows with one id but different sets are one document: they tie their classes
    same = classed.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = connected_components(links.unionByName(same), "a", "b")
    return (feats.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))


def op12_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws]
                                      ELSE list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT node, b FROM reach JOIN link ON other = a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) r ON r.node = d.doc_id
"""
