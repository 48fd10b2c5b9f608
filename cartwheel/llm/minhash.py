"""Near-duplicate documents: SuperMinHash, banding, verification, union-find.

A document is the set of its distinct 5-word shingles.  Two documents are
linked when the Jaccard similarity of their full sets is at least a threshold
(``percent``; 85 % in op7 and the pipeline, which their SQL and tests fix);
SuperMinHash signatures and bands only propose candidates.

Steps, all keyed by data that spreads:

1. One pass over the texts (Arrow batches, numpy) gives the set size, a 128-bit
   fingerprint of the set and the band keys of a 192-value signature (32 at 85 %).
2. Documents with equal sets form a class; only its least id goes on, so a
   group of copies of any size costs one aggregate.
3. Within a band bucket everybody is tied to the least id (rows grow with the
   documents, never with pairs).  The components of these ties are candidate
   groups: no link can leave one, short of a miss in all bands, which
   happens to a pair at the threshold with a chance below 3e-7.  A component that has
   become very heavy is looked at bucket by bucket instead.
4. Candidate groups are verified on full sets.  A large group is cut by set
   size (a link needs sizes within the threshold) and into blocks of bounded total
   size and number of documents; pairs of blocks are tasks.  A task compares
   sets by products of 0/1 matrices, a strip of rows at a time, and returns a
   spanning forest of its links, never all of them.
5. Components of the verified links.

Cases: a null or empty text, or one without words, has an empty set and is
linked with nothing.  Fewer than five words make one shingle of the whole
sequence.  Rows with equal ids count as one document.  A row without an id
cannot be named: it is linked with nothing, kept, and has no component.  An
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .common import checkpoint, map_arrow, map_batches, steps, table
from .components import connected_components

WORDS = 5
PERCENT = 85                      # of op7, and where nothing else is asked for
SIGNATURE = 192                   # 32 bands of 6 values at 85 %, 38 of 5 at 80 %
MISS = 3e-7                       # chance that a pair at the threshold shares no band
BLOCK = 150_000                   # shingles in a block of a verification task
DOCUMENTS = 2_000                 # documents in a block of a verification task, on average
HEAVY = 40 * BLOCK                # shingles of a component that is verified bucket by bucket
HEAVY_DOCUMENTS = 40 * DOCUMENTS  # or its documents
_COLUMNS = 4096                   # shingles compared in one matrix product
_STRIP = 512                      # rows whose counts are turned into links together


def shingle_sets(column: pa.Array, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows in one array, and the row offsets."""
    data, off = H.utf8(column)
    data = H.lower_ascii(data)
    starts, ends, first = H.words(data, off)
    w = H.hash_words(data, starts, ends)
    sets = []
    for lo, hi in zip(first[:-1], first[1:]):
        n = hi - lo
        if n >= k:
            sets.append(np.unique(H.combine([w[lo + j:hi - k + 1 + j] for j in range(k)])))
        else:
            sets.append(H.combine([w[i:i + 1] for i in range(lo, hi)], seed=1) if n else np.empty(0, np.uint64))
    off = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=off[1:])
    return np.concatenate(sets) if sets else np.empty(0, np.uint64), off


def superminhash(elements: np.ndarray, off: np.ndarray, m: int = SIGNATURE) -> np.ndarray:
    """One signature of ``m`` values per row of ``elements``; empty rows get infinity.

    Every element walks its own random permutation of the m places.  At step j
    it offers j plus a random fraction to the place it reaches; a place keeps
    the least offer.  Offers of step j are at least j, so a row stops as soon
    as its largest value is below the next step: large sets after one step,
    and the correlated places make the estimate less noisy than independent
    hashes.  All rows walk together, one numpy step for each j."""
    rows = len(off) - 1
    sig = np.full((rows, m), np.inf)
    flat = sig.reshape(-1)
    row = np.repeat(np.arange(rows), np.diff(off))
    seeds = H.mix(elements + H.GOLDEN)
    perm = None
    for j in range(m):
        if j:
            active = sig.max(axis=1, initial=0) >= j
            active &= np.diff(off) > 0
            keep = active[row]
            if not keep.any():
                break
            if perm is None:
                # only rows of few elements come here: places not hit in step 0
                row, seeds = row[keep], seeds[keep]
                perm = np.tile(np.arange(m, dtype=np.uint16), (len(row), 1))
                _swap(perm, 0, _place(seeds, 0, m))
            elif not keep.all():
                row, seeds, perm = row[keep], seeds[keep], perm[keep]
        place = _place(seeds, j, m)
        target = place if perm is None else _swap(perm, j, place)
        fraction = (H.mix(seeds + H.times(2 * j + 2)) >> np.uint64(11)) * 2.0 ** -53
        np.minimum.at(flat, row * m + target, fraction + j)
    return sig


def _place(seeds: np.ndarray, j: int, m: int) -> np.ndarray:
    r = H.mix(seeds + H.times(2 * j + 1)) >> np.uint64(32)
    return (j + ((r * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64))


def _swap(perm: np.ndarray, j: int, place: np.ndarray) -> np.ndarray:
    i = np.arange(len(perm))
    reached = perm[i, place]
    perm[i, place] = perm[:, j]
    perm[:, j] = reached
    return reached.astype(np.int64)


def band_rows(percent: int) -> int:
    """The longest bands that miss a pair at ``percent`` with a chance below MISS."""
    return next((r for r in range(SIGNATURE, 0, -1) if (1 - (percent / 100) ** r) ** (SIGNATURE // r) < MISS), 1)


def band_keys(sig: np.ndarray, rows: int = band_rows(PERCENT)) -> np.ndarray:
    """One 64-bit key per band of ``rows`` values; what is left over is in none."""
    bits = np.ascontiguousarray(sig).view(np.uint64)
    return np.stack([H.combine([bits[:, c] for c in range(b, b + rows)], seed=b + 2)
                     for b in range(0, sig.shape[1] - rows + 1, rows)], axis=1)


def _features(batch: pa.RecordBatch, rows: int) -> pa.RecordBatch:
    elements, off = shingle_sets(batch.column("text"))
    n = np.diff(off)
    keys = band_keys(superminhash(elements, off), rows).view(np.int64)

    def total(x: np.ndarray) -> np.ndarray:  # order-free, so equal for equal sets
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))
        return (sums[off[1:]] - sums[off[:-1]]).view(np.int64)

    bands = pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * keys.shape[1], keys.reshape(-1))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(n), pa.array(total(H.mix(elements))),
         pa.array(total(H.mix(elements ^ H.GOLDEN))), bands],
        names=["doc_id", "n_shingles", "f1", "f2", "bands"])


def features(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), partial(_features, rows=band_rows(percent)),
                     "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>")


def _forest(links: np.ndarray, ids: list[int]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph with adjacency matrix ``links``."""
    edges, seen = [], np.zeros(len(ids), bool)
    for root in range(len(ids)):
        if seen[root]:
            continue
        seen[root], todo = True, [root]
        while todo:
            new = np.flatnonzero(links[todo.pop()] & ~seen)
            seen[new] = True
            todo.extend(new.tolist())
            edges.extend((ids[root], ids[i]) for i in new)
    return edges


def verified(ids: list[int], side: np.ndarray, elements: np.ndarray, off: np.ndarray,
             percent: int = PERCENT) -> list[tuple[int, int]]:
    """Spanning forest of the links among rows whose ``side`` differ, or of all if one side."""
    n = len(ids)
    size = np.diff(off)
    row = np.repeat(np.arange(n), size)
    _, code, count = np.unique(elements, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    row, code = row[shared], code[shared]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    # only the two sides meet, or all rows if there is one side
    two = side.any() and not side.all()
    left, right = (np.flatnonzero(~side), np.flatnonzero(side)) if two else (np.arange(n), np.arange(n))
    # a column per shingle that several rows have, a few thousand columns at a time
    column = np.cumsum(np.concatenate(([0], code[1:] != code[:-1]))) if len(code) else code
    common = np.zeros((len(left), len(right)), np.float32)
    cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + _COLUMNS, _COLUMNS))
    for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        m = np.zeros((n, _COLUMNS), np.float32)
        m[row[lo:hi], column[lo:hi] - i * _COLUMNS] = 1
        other = m[right].T if two else m.T
        for k in range(0, len(left), _STRIP):
            common[k:k + _STRIP] += m[left[k:k + _STRIP]] @ other
    links = np.zeros((n, n), bool)
    for k in range(0, len(left), _STRIP):
        rows = left[k:k + _STRIP]
        both = common[k:k + _STRIP].astype(np.int64)
        near = (100 * both >= percent * (size[rows][:, None] + size[right][None, :] - both)) & (size[rows] > 0)[:, None]
        links[np.ix_(rows, right)] = near
        if two:
            links[np.ix_(right, rows)] = near.T
    return _forest(links, ids)


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by ``task``: a task's rows are gathered, then compared."""
    task, ids, side, parts = None, [], [], []
    edges: list[tuple[int, int]] = []

    def flush() -> None:
        if len(ids) > 1:
            off = np.zeros(len(parts) + 1, np.int64)
            np.cumsum([len(p) for p in parts], out=off[1:])
            edges.extend(verified(ids, np.array(side), np.concatenate(parts), off, percent))

    def out() -> pa.RecordBatch:
        a, b = [e[0] for e in edges], [e[1] for e in edges]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        for s in steps(batch):
            elements, off = shingle_sets(s.column("text"))
            for i, (t, d, r) in enumerate(zip(s.column("task").to_pylist(), s.column("doc_id").to_pylist(),
                                              s.column("side").to_pylist())):
                if t != task:
                    flush()
                    task, ids, side, parts = t, [], [], []
                ids.append(d)
                side.append(r)
                parts.append(elements[off[i]:off[i + 1]])
        if edges:
            yield out()
            edges.clear()
    flush()
    yield out()


def shared_buckets(reps: DataFrame) -> DataFrame:
    """``doc_id``, ``band``, ``key``, ``head`` of every band bucket with two documents or more."""
    rows = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))
    heads = rows.groupBy("band", "key").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("tail")).filter("head < tail")
    return rows.join(heads.drop("tail"), ["band", "key"])


def candidate_groups(reps: DataFrame) -> DataFrame:
    """``node``, ``component``, ``n_shingles``: groups in which links are looked for.

    A group is a component of the documents that share band buckets.  Where a
    component is heavier than HEAVY or HEAVY_DOCUMENTS its buckets are the groups instead, for a
    passage that very many documents share can tie them together though few
    of them are alike; a linked pair shares a bucket either way."""
    ties = shared_buckets(reps).filter("doc_id > head").select("doc_id", "head").distinct()
    member = checkpoint(connected_components(ties, "doc_id", "head")
                        .join(reps.select(F.col("doc_id").alias("node"), "n_shingles"), "node"))
    weight = (member.groupBy("component").agg(F.sum("n_shingles").alias("weight"), F.count("*").alias("documents"))
              .filter((F.col("weight") > HEAVY) | (F.col("documents") > HEAVY_DOCUMENTS)))
    if weight.isEmpty():
        return member
    heavy = weight.select("component")
    buckets = (member.join(heavy, "component", "left_semi").join(shared_buckets(reps), F.col("node") == F.col("doc_id"))
               .select("node", F.xxhash64(F.lit("bucket"), "band", "key").alias("component"), "n_shingles"))
    return member.join(heavy, "component", "left_anti").select("node", "component", "n_shingles").unionByName(buckets)


def block_tasks(groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``node``, ``task``, ``side``: blocks of bounded shingles and documents, and the pairs of them to compare."""
    # a link needs sizes within ``percent``, so it stays in one size class or joins two neighbours
    step = max(float(-np.log(percent / 100)), 1e-6)
    size_class = F.floor(F.log(F.col("n_shingles")) / step + 1e-9)
    whole = (F.col("weight") <= BLOCK) & (F.col("documents") <= DOCUMENTS)
    weight = groups.groupBy("component").agg(F.sum("n_shingles").alias("weight"), F.count("*").alias("documents"))
    member = (groups.join(weight, "component")
              .withColumn("class", F.when(whole, F.lit(0)).otherwise(size_class)))
    blocks = member.groupBy("component", "class").agg(
        F.greatest(F.ceil(F.sum("n_shingles") / BLOCK), F.ceil(F.count("*") / DOCUMENTS)).cast("int").alias("blocks"))
    up = blocks.select("component", (F.col("class") - 1).alias("class"), F.col("blocks").alias("above"))
    down = blocks.select("component", (F.col("class") + 1).alias("class"), F.col("blocks").alias("below"))
    plan = blocks.join(up, ["component", "class"], "left").join(down, ["component", "class"], "left")
    member = member.join(plan, ["component", "class"]).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def tasks(low_class, low, high_class, high):
        return F.struct(low_class.alias("c1"), low.alias("b1"), high_class.alias("c2"), high.alias("b2"))

    def upto(n):
        return F.when(n.isNull() | (n < 1), F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n - 1))

    c, b = F.col("class"), F.col("block")
    own = F.transform(upto(F.col("blocks")), lambda o: tasks(c, F.least(b, o), c, F.greatest(b, o)))
    above = F.transform(upto(F.col("above")), lambda o: tasks(c, b, c + 1, o))
    below = F.transform(upto(F.col("below")), lambda o: tasks(c - 1, o, c, b))
    return (member.select("component", "node", "class", "block", F.explode(F.concat(own, above, below)).alias("t"))
            .select("node", F.xxhash64("component", "t").alias("task"),
                    ((c == F.col("t.c2")) & (b == F.col("t.b2"))).alias("side")))


def verified_links(docs: DataFrame, groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges ``a``, ``b``: a spanning set of the links inside each candidate group."""
    # the text of each document once by id, then once for each of its tasks
    text = docs.select(F.col("doc_id").cast("bigint").alias("node"), "text").filter("node is not null")
    work = text.join(block_tasks(groups, percent), "node").select(F.col("node").alias("doc_id"), "task", "side", "text")
    spread = work.repartition("task").sortWithinPartitions("task")
    return map_batches(spread, partial(_verify, percent=percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs``, linked from ``percent`` on."""
    feats = checkpoint(features(docs, percent))
    named = feats.filter("doc_id is not null")
    key = ["n_shingles", "f1", "f2"]
    classes = named.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    classed = named.join(classes, key)
    reps = classed.filter("doc_id = rep").select("doc_id", "n_shingles", "bands")
    groups = candidate_groups(reps)
    links = verified_links(docs, groups, percent)
    # rows with one id but different sets are one document: they tie their classes
    same = classed.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = connected_components(links.unionByName(same), "a", "b")
    out = feats.join(found, feats["doc_id"] == found["node"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op7_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with one document of each group, the one of least id.

    Rows of equal id are one document, of which one row stays (the least, by
    all columns; maps, which have no order, by their JSON).  Rows without an id stay."""
    kept = near_duplicates(docs, percent).filter("kept and doc_id is not null").select("doc_id").distinct()
    row = F.struct(*docs.columns)
    order = F.struct(*[F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema.fields])
    least = F.min(row) if not any("map<" in f.dataType.simpleString() for f in docs.schema.fields) else F.min_by(row, order)
    stay = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(least.alias("row"))
    return stay.select("row.*").unionByName(docs.filter("doc_id is null"))


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
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT node, b FROM reach JOIN link ON other = a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) r ON r.node = d.doc_id
"""
