"""Exact top-k inner products by MaxScore over signed dimensions.

Vectors become integers, floor(256 x).  A dimension gives a query one term: the
side, positive or negative, on which a candidate scores.  The bound of a term
is the query's weight times the largest value on that side in the shard.
Terms are split by these bounds: the least ones, as many as together stay below
the threshold (the k-th best score so far), are non-essential, for a candidate
that matches those alone cannot get in.  The essential terms are one dense
product over the shard, without posting lists, and the threshold is that of the
seed rows throughout; candidates are probed with the other terms, largest bound
first, while what they can still gain keeps them competitive.  A bound equal to
the threshold stays, because ties go to the smaller id.

Scale: candidates are dealt by hash into shards and queries into blocks of
bounded size; a task is one shard with one block, and yields k rows per query.
Shards are merged by a ranking window, which Spark limits to k rows per query
before the shuffle.  Nothing is broadcast.

Cases: vectors that are null or hold a null or a non-finite number, and rows
without an id, take no part.  Rows alike in id and vector count once.  A vector
shorter than another counts as padded with zeros; an empty one scores 0.
Fewer candidates than k are all returned.  Scores outside 64 bits are returned
as the nearest 64-bit number.  An empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import checkpoint, table

K = 5
SHARD, BLOCK = 8192, 512   # rows of a shard, queries of a block
SEED_ROWS = 256            # candidates scored first, for the first threshold
PROBE = 8                  # terms probed between two looks at the bounds


def integers(vectors: DataFrame, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``vec_id``, ``v`` (array of long) of the rows that take part."""
    ok = F.col(vec).isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & F.coalesce(ok, F.lit(False)))
            .select(F.col(id_col).cast("bigint").alias("vec_id"),
                    F.transform(vec, lambda x: F.floor(256 * x.cast("double")).cast("bigint")).alias("v")).distinct())


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(size), width))
    flat = column.flatten().to_numpy()
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    if len(flat) and float(np.abs(flat.astype(float)).max()) ** 2 * max(width, 1) >= 2.0 ** 53:
        out = np.zeros((len(size), width), object)  # too large for exact doubles
        flat = np.array(flat.tolist(), object)
    out[row, at] = flat
    return out


def search(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int = K) -> list[tuple[int, int, int]]:
    """(query's number, candidate's number, score) of the k best candidates of each query.

    ``ids`` are in ascending order, so that the earlier of equals is the smaller id."""
    if not len(ids) or not len(q):
        return []
    top, bottom = x.max(axis=0, initial=0), x.min(axis=0, initial=0)
    columns = np.ascontiguousarray(x.T)
    seeds = np.unique(np.linspace(0, len(ids) - 1, min(len(ids), SEED_ROWS)).astype(np.int64))
    first = q @ x[seeds].T
    out = []
    for i in range(len(q)):
        weight = q[i]
        bound = np.where(weight > 0, weight * top, weight * bottom)  # never below 0
        own = ids == query_ids[i]
        start = first[i][~own[seeds]]
        threshold = np.sort(start)[-k] if len(start) >= k else None
        order = np.argsort(bound.astype(float), kind="stable")
        gain = np.cumsum(bound[order])          # gain[j]: the most that the j + 1 least terms give
        split = 0 if threshold is None else int(np.searchsorted(gain.astype(float), float(threshold), "left"))
        essential, rest = order[split:], order[:split][::-1]
        if not len(essential):  # even all terms together stay below the threshold
            continue
        score = weight[essential] @ columns[essential]
        # without a match on the right side of an essential term a candidate gets no more than gain[split - 1]
        alive = np.flatnonzero(~own) if threshold is None else np.flatnonzero(~own & (score + (gain[split - 1] if split else 0) >= threshold))
        score = score[alive]
        for lo in range(0, len(rest), PROBE):
            part = rest[lo:lo + PROBE]
            score = score + weight[part] @ columns[np.ix_(part, alive)]
            left = split - lo - len(part)
            more = gain[left - 1] if left else 0
            if threshold is not None:
                keep = score + more >= threshold
                alive, score = alive[keep], score[keep]
        best = np.lexsort((alive, -score))[:k] if score.dtype != object else sorted(range(len(alive)), key=lambda j: (-score[j], alive[j]))[:k]
        out.extend((i, int(alive[j]), int(score[j])) for j in best)
    return out


def _task(group: pa.Table) -> pa.Table:
    group = group.sort_by([("vec_id", "ascending")])
    width = max((len(v) for v in group["v"].to_pylist()), default=0)
    x = _matrix(group["v"], width)
    ids, is_query, row = group["vec_id"].to_numpy(), group["is_query"].to_numpy(zero_copy_only=False), group["row"].to_numpy()
    c = ~is_query
    found = search(ids[c], x[c], ids[is_query], x[is_query])
    qi, ci = np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64)
    low, high = -(1 << 63), (1 << 63) - 1
    return pa.table({"query_id": pa.array(ids[is_query][qi], pa.int64()), "row": pa.array(row[is_query][qi], pa.int64()),
                     "vec_id": pa.array(ids[c][ci], pa.int64()),
                     "score": pa.array([min(max(f[2], low), high) for f in found], pa.int64())})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: of each row of ``queries`` the k best of ``vectors``.

    Both have ``vec_id`` and ``v``; a candidate with the query's id is left out."""
    ship_package(vectors.sparkSession)
    shards = max(1, -(-vectors.count() // SHARD))
    blocks = max(1, -(-queries.count() // BLOCK))
    dealt = F.xxhash64("vec_id", "v")

    def side(df: DataFrame, own: str, n: int, other: str, m: int, is_query: bool) -> DataFrame:
        return df.select("vec_id", "v", dealt.alias("row"), F.lit(is_query).alias("is_query"),
                         F.pmod(dealt, F.lit(n)).alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other))

    work = side(vectors, "shard", shards, "block", blocks, False).unionByName(side(queries, "block", blocks, "shard", shards, True))
    found = work.groupBy("shard", "block").applyInArrow(_task, "query_id long, row long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_maxscore(spark, sf_dir: str) -> DataFrame:
    vectors = checkpoint(integers(table(spark, sf_dir, "embeddings")))
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


ORACLE_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
