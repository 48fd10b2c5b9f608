"""Hard negatives by candidate lists that clusters of anchors share (after MAXIMUS).

A hard negative of an anchor and one of its positives (the K best rows of its
label) is a row of another label that scores close below the positive: from
FLOOR percent of its score up to it.  Scores are integer inner products of
floor(256 x).  Both searches are top-k searches of scores inside a window, and
both are exact.

Anchors are clustered by direction (spherical k-means, fitted on SAMPLE anchors
at most, taken by hash; every anchor is assigned).  If all members of a cluster
are within an angle b of its centroid, a candidate x at angle t to the centroid
scores no more than |u| |x| cos(max(0, t - b)) with a member u.  So the
candidates are sorted once for a cluster by |x| cos(max(0, t - b)), and every
member walks this list in steps, together with the members of its label, until
what is left is certified not to matter: |u| times the next bound is below the
window, or below the k-th best found inside it.

Scale: candidates are dealt by hash into shards, each vector once; only the
anchors, one row in a hundred, are sent to every shard.  A task holds one shard
and streams the anchors past it, sorted by cluster and then label, a block at
a time.  A shard yields k rows for each anchor and window, merged by a ranking
window that Spark limits to k before the shuffle.  Nothing grows with the table
on the driver but the number of shards.  A hot label changes only which rows of
a shard's list a member may take.

Cases: rows with a null id, label or vector, or with a null or non-finite
component, take no part.  Rows alike in id, label and vector count once; rows of
the anchor's own id are never its positives or negatives.  A vector shorter than
another counts as padded with zeros; a zero vector scores 0 everywhere.  A
negative positive score has an empty window.  Scores outside 64 bits are
returned as the nearest 64-bit number.  An empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, map_batches, table

K, FLOOR = 5, 80        # positives and negatives; percent of the positive's score
SHARD = 32_768          # candidates of a shard, on average, at most
BLOCK = 512             # anchors compared together
STEP = 1_024            # candidates of a list between two looks at the bounds
CLUSTERS, SAMPLE = 64, 4_096
SLACK = 1e-7            # of |u| |x|: rounding of angles


def takes_part(vectors: DataFrame, id_col: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``label``, ``v`` (array of long) and ``row``, a hash that names the row."""
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & F.col(vec).isNotNull() & F.coalesce(ok, F.lit(False)))
            .select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"),
                    F.transform(vec, lambda x: F.floor(256 * x.cast("double")).cast("bigint")).alias("v")).distinct())
    return rows.withColumn("row", F.xxhash64("vec_id", "label", "v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of integers; those longer than ``width`` are cut, for there is nothing to meet them."""
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros((len(size), width), np.int64)
    inside = at < width
    out[row[inside], at[inside]] = flat[inside]
    return out


def _exact(x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As doubles where all products are exact in them, as Python's integers where not."""
    top = float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(q.astype(float)).max(initial=0))
    kind = float if top * max(1, x.shape[1]) < 2.0 ** 52 else object
    return x.astype(kind), q.astype(kind)


def directions(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def fit_centroids(x: np.ndarray, clusters: int = CLUSTERS, rounds: int = 8) -> np.ndarray:
    """Unit centroids of spherical k-means, started from rows far from one another."""
    d = directions(x)
    chosen, near = [0], np.full(len(d), -np.inf)
    for _ in range(min(clusters, max(1, len(d) // 8)) - 1):
        near = np.maximum(near, d @ d[chosen[-1]])
        chosen.append(int(near.argmin()))
    c = d[chosen]
    for _ in range(rounds):
        own = (d @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, d)
        c = np.where(np.abs(sums).sum(axis=1, keepdims=True) > 0, directions(sums), c)
    return c


def angles(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(directions(x) @ centroid, -1, 1))


def shared_list(x: np.ndarray, centroid: np.ndarray, spread: float) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``x`` by the most they can score with a unit vector within ``spread`` of ``centroid``; these bounds."""
    size = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    bound = size * (np.cos(np.maximum(0, angles(x, centroid) - spread)) + SLACK)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def walk(q: np.ndarray, own: np.ndarray, windows: list[list[tuple]], x: np.ndarray, ids: np.ndarray, bound: np.ndarray,
         k: int = K) -> tuple[list[list[list[tuple[int, int]]]], int]:
    """For every row of ``q`` and each of its windows (least and largest score) the ``k`` best (score, id) among ``x``.

    ``x``, ``ids`` and ``bound`` are in the order of a shared list; also returns how many scores were computed."""
    best: list[list[list[tuple[int, int]]]] = [[[] for _ in w] for w in windows]
    size = np.sqrt((q.astype(float) ** 2).sum(axis=1)) * (1 + 1e-9)
    active = [i for i, w in enumerate(windows) if w]
    scored = 0
    for lo in range(0, len(x), STEP):
        if not active:
            break
        scores = q[active] @ x[lo:lo + STEP].T
        scored += scores.size
        after = bound[lo + STEP] if lo + STEP < len(x) else -np.inf
        names, left = ids[lo:lo + STEP], []
        for i, s in zip(active, scores):
            other = names != own[i]
            open_ = False
            for w, (low, high) in enumerate(windows[i]):
                found = best[i][w]
                least = max(low, found[-1][0]) if len(found) == k else low
                at = np.flatnonzero(other & (s >= least) & (s <= high))
                if len(at):
                    if len(at) > 4 * k and s.dtype != object:  # what is below the k-th here cannot stay
                        at = at[s[at] >= np.partition(s[at], -k)[-k]]
                    found = sorted(found + [(int(s[j]), int(names[j])) for j in at], key=lambda f: (-f[0], f[1]))[:k]
                    best[i][w] = found
                least = max(low, found[-1][0]) if len(found) == k else low
                open_ |= bool(size[i] * after >= least if after >= 0 else after > -np.inf and -size[i] * -after * (1 - 2e-9) >= least)
            if open_:
                left.append(i)
        active = left
    return best, scored


def _search(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, spreads: dict[int, float], same: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard; its candidates first, then anchors by cluster and label."""
    shard = x = ids = labels = None
    parts: list[pa.RecordBatch] = []
    block: list[dict] = []
    lists: dict[int, tuple] = {}

    def load() -> None:
        nonlocal x, ids, labels, parts
        t = pa.Table.from_batches(parts).combine_chunks()
        width = pc.max(pc.list_value_length(t["v"])).as_py() or 0
        x = _matrix(t["v"].combine_chunks(), max(width, centroids.shape[1]))
        ids, labels, parts = t["vec_id"].to_numpy(), t["label"].to_numpy(), []
        lists.clear()

    def search() -> list[tuple]:
        cluster, label = block[0]["cluster"], block[0]["label"]
        if cluster not in lists:  # once for the members of a cluster
            lists.clear()
            centre = np.zeros(x.shape[1])
            centre[:centroids.shape[1]] = centroids[cluster]
            lists[cluster] = shared_list(x, centre, spreads[cluster])
        order, bound = lists[cluster]
        take = (labels[order] == label) == same
        order, bound = order[take], bound[take]
        q = _matrix(pa.array([a["v"] for a in block], pa.list_(pa.int64())), x.shape[1])
        rows, q = _exact(x[order], q)
        if same:
            windows = [[(-math.inf, math.inf)] for _ in block]
        else:
            windows = [[(-(-FLOOR * p["score"] // 100), p["score"]) for p in a["positives"]] for a in block]
        found, _ = walk(q, np.array([a["vec_id"] for a in block]), windows, rows, ids[order], bound)
        return [(a["row"], a["vec_id"], w, i, s) for a, each in zip(block, found) for w, hits in enumerate(each) for s, i in hits]

    def flush() -> pa.RecordBatch:
        hits = search() if block and x is not None else []
        block.clear()
        low, high = -(1 << 63), (1 << 63) - 1
        columns = list(zip(*hits)) or [()] * 5
        columns[4] = [min(max(s, low), high) for s in columns[4]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "anchor_id", "window", "vec_id", "score"])

    for batch in batches:
        if not batch.num_rows:
            continue
        # pieces of one shard and kind
        mark = np.array([batch.column("shard").to_numpy(), batch.column("kind").to_numpy()])
        cuts = [0, *(np.flatnonzero((mark[:, 1:] != mark[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            piece = batch.slice(lo, hi - lo)
            s, kind = int(mark[0, lo]), int(mark[1, lo])
            if s != shard:
                if block:
                    yield flush()
                shard, x, parts = s, None, []
            if kind == 0:
                parts.append(piece.select(["vec_id", "label", "v"]))
                continue
            if parts:
                load()
            for a in piece.drop_columns(["shard", "kind"]).to_pylist():
                if block and (len(block) >= BLOCK or (block[0]["cluster"], block[0]["label"]) != (a["cluster"], a["label"])):
                    yield flush()
                block.append(a)
    if block:
        yield flush()


def _assign(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = _matrix(b.column("v"), centroids.shape[1])
        near = directions(x) @ centroids.T
        own = near.argmax(axis=1) if len(x) else np.empty(0, np.int64)
        # the angle of the whole vector, which may be longer than the centroid
        size = np.sqrt([float(sum(float(c) ** 2 for c in v)) for v in b.column("v").to_pylist()])
        inside = np.sqrt((x.astype(float) ** 2).sum(axis=1))
        cos = near[np.arange(len(x)), own] * np.divide(inside, size, out=np.zeros(len(x)), where=size > 0)
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(own), pa.array(np.arccos(np.clip(cos, -1, 1)))], names=["row", "cluster", "angle"])


def clustered(anchors: DataFrame) -> tuple[DataFrame, np.ndarray, dict[int, float]]:
    """Anchors with their ``cluster``, the centroids, and the widest angle in each cluster."""
    sample = anchors.orderBy("row").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    width = pc.max(pc.list_value_length(sample)).as_py() or 0 if len(sample) else 0
    x = _matrix(sample, width) if len(sample) else np.zeros((1, 0))
    centroids = fit_centroids(x)
    own = map_batches(anchors.select("row", "v"), partial(_assign, centroids=centroids), "row long, cluster long, angle double")
    member = checkpoint(anchors.join(own, "row"))
    spread = {r["cluster"]: r["angle"] + 1e-7 for r in member.groupBy("cluster").agg(F.max("angle").alias("angle")).collect()}
    return member.drop("angle"), centroids, spread


def _found(candidates: DataFrame, members: DataFrame, shards: int, centroids: np.ndarray, spread: dict[int, float], same: bool) -> DataFrame:
    """``row``, ``anchor_id``, ``window``, ``vec_id``, ``score``, ``rank``: the K best of every anchor and window over all shards."""
    none = F.lit(None).cast("array<struct<vec_id:bigint,score:bigint>>")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    c = candidates.select(F.pmod("row", F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "vec_id", "label", "v",
                          "row", F.lit(0).cast("bigint").alias("cluster"), none.alias("positives"))
    m = members.select(every.alias("shard"), F.lit(1).alias("kind"), "vec_id", "label", "v", "row", "cluster",
                       F.col("positives") if "positives" in members.columns else none.alias("positives"))
    dealt = c.unionByName(m).repartition("shard").sortWithinPartitions("shard", "kind", "cluster", "label", "row")
    hits = map_batches(dealt, partial(_search, centroids=centroids, spreads=spread, same=same),
                       "row long, anchor_id long, window long, vec_id long, score long")
    best = Window.partitionBy("row", "window").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= K)


def hard_negatives(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``rows`` and ``anchors`` are of ``takes_part``; anchors need not be among the rows."""
    shards = max(-(-rows.count() // SHARD), rows.sparkSession.sparkContext.defaultParallelism)
    member, centroids, spread = clustered(anchors)
    positives = _found(rows, member, shards, centroids, spread, same=True)
    listed = positives.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))  # K at most
    listed = listed.select("row", F.transform("p", lambda p: F.struct(p["vec_id"].alias("vec_id"), p["score"].alias("score"))).alias("positives"))
    asked = checkpoint(member.join(listed, "row"))
    found = _found(rows, asked, shards, centroids, spread, same=False)
    positive = F.col("positives")[F.col("window").cast("int")]
    return (found.join(asked.select("row", "positives"), "row")
            .select("anchor_id", positive["vec_id"].alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
                    positive["score"].alias("positive_score"), F.col("score").alias("negative_score")))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = checkpoint(takes_part(given.withColumn("label", moved)))
    return hard_negatives(rows, rows.filter("vec_id % 100 = 0"))


ORACLE_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth FROM s WHERE same),
neg AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.nth ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM pos p JOIN s ON p.nth <= 5 AND s.anchor_id = p.anchor_id AND NOT s.same
       AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5
"""
