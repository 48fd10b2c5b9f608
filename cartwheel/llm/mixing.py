"""Mixing sources to target weights by temperature.

Shares of the sources, in tokens, are raised to an exponent between 0 (all
sources alike) and 1 (as they come) and normalised.  Bisection finds the least
exponent that keeps within a repetition limit, and the largest one that reaches
a target entropy; the limit comes first.  Weights times the token budget are
the tokens to draw from each source.

Drawing is by budgeted block permutations: the documents of a source are dealt
by hash into blocks; an epoch is a permutation of the blocks, each a permutation
of its documents, anew in every epoch.  Epochs follow each other until the
source's budget is spent: whole ones, then the part of one that fits.  By
default the budget is the least with which every source is used whole at least
once, so no document is lost and smaller sources are repeated.

Scale: only ids, sources and token counts are shuffled.  A source has at most
MAX_BLOCKS blocks, and blocks grow with the source, so running sums are taken
over blocks (few rows) and inside one block (one task each): a source with a
third of all rows is many tasks.  One row per source reaches the driver; more
than MAX_SOURCES sources raise an error.

Cases: tokens are words; a text without words, or null, counts as one token,
so that it takes part.  A null source is a source of its own.  Rows equal in
id and tokens are interchangeable.  An empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, table

BLOCK_TOKENS, MAX_BLOCKS = 1 << 18, 4096
MAX_SOURCES = 100_000
TARGET_ENTROPY = 0.95   # share of the entropy of equal weights
MAX_REPEATS = 1.5
SEED = 9


def token_count(text: Column) -> Column:
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.greatest(F.coalesce(F.size(words), F.lit(0)), F.lit(1)).cast("bigint")


def temperature_weights(shares: list[float], exponent: float) -> list[float]:
    top = max(shares)
    raised = [(p / top) ** exponent for p in shares]
    total = math.fsum(raised)
    return [x / total for x in raised]


def entropy(weights: list[float]) -> float:
    return -math.fsum(w * math.log(w) for w in weights if w > 0)


def repeats(shares: list[float], weights: list[float], budget: float | None) -> float:
    """How often the most repeated source is used, with a budget in shares of all tokens."""
    uses = [w / p for w, p in zip(weights, shares)]
    return max(uses) * budget if budget else max(uses) / min(uses)


def bisect(reached, low: float = 0.0, high: float = 1.0, rounds: int = 60) -> float:
    """The border in [low, high] up to which ``reached`` holds, from ``low`` on."""
    if reached(high):
        return high
    if not reached(low):
        return low
    for _ in range(rounds):
        middle = (low + high) / 2
        low, high = (middle, high) if reached(middle) else (low, middle)
    return low


def exponent_for(shares: list[float], target_entropy: float | None = TARGET_ENTROPY,
                 max_repeats: float | None = MAX_REPEATS, budget: float | None = None) -> float:
    """The exponent for the target entropy, raised as far as the repetition limit asks."""
    wanted = 0.0
    if target_entropy is not None:
        goal = target_entropy * math.log(len(shares))
        wanted = bisect(lambda a: entropy(temperature_weights(shares, a)) >= goal)
    if max_repeats is not None:
        # from 1 downwards: how far the exponent may fall
        fall = bisect(lambda d: repeats(shares, temperature_weights(shares, 1 - d), budget) <= max_repeats * (1 + 1e-12))
        wanted = max(wanted, 1 - fall)
    return wanted


def plan(totals: dict, target_entropy: float | None = TARGET_ENTROPY, max_repeats: float | None = MAX_REPEATS,
         budget: int | None = None) -> dict:
    """source -> (tokens there are, weight, tokens to draw)."""
    if not totals:
        return {}
    names, everything = list(totals), sum(totals.values())
    shares = [totals[s] / everything for s in names]
    weights = temperature_weights(shares, exponent_for(shares, target_entropy, max_repeats, budget and budget / everything))
    if budget is None:
        scale = max(totals[s] / w for s, w in zip(names, weights))
        return {s: (totals[s], w, max(totals[s], round(w * scale))) for s, w in zip(names, weights)}
    return {s: (totals[s], w, int(w * budget + 1e-6)) for s, w in zip(names, weights)}


def draw(docs: DataFrame, target_entropy: float | None = TARGET_ENTROPY, max_repeats: float | None = MAX_REPEATS,
         budget: int | None = None) -> DataFrame:
    """One row per drawn copy of a document: ``doc_id``, ``source``, ``n_tokens``, ``epoch``, ``block``,
    ``position`` (0 to 1, where its tokens begin in the stream of its source) and ``weight``.

    Ordered by ``position``, the streams of all sources together keep the weights at every point."""
    spark = docs.sparkSession
    rows = checkpoint(docs.select("doc_id", F.col("source").cast("string").alias("source"), token_count(F.col("text")).alias("n_tokens")))
    totals = rows.groupBy("source").agg(F.sum("n_tokens").alias("n")).orderBy("source").limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources to mix")
    planned = plan({r["source"]: r["n"] for r in totals}, target_entropy, max_repeats, budget)
    table_ = spark.createDataFrame(
        [(s, n, w, b, max(1, min(MAX_BLOCKS, math.ceil(n / BLOCK_TOKENS))), math.ceil(b / n)) for s, (n, w, b) in planned.items()],
        "s string, total long, weight double, budget long, blocks int, epochs int")
    # one row per source, at most MAX_SOURCES
    each = (rows.join(F.broadcast(table_), rows["source"].eqNullSafe(table_["s"])).drop("s")
            .withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "n_tokens"), F.col("blocks")).cast("int")))
    sizes = each.groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens"), F.first("total").alias("total"),
                                                F.first("epochs").alias("epochs"))
    epochs = F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)).alias("epoch")
    order = Window.partitionBy("source", "epoch").orderBy(F.xxhash64(F.lit(SEED), "epoch", "block"), "block")
    before = (sizes.select("source", "block", "block_tokens", "total", epochs)
              .withColumn("offset", F.sum("block_tokens").over(order) - F.col("block_tokens") + F.col("epoch") * F.col("total"))
              .select(F.col("source").alias("s"), F.col("block").alias("b"), F.col("epoch").alias("e"), "offset"))
    copies = each.select("doc_id", "source", "n_tokens", "weight", "budget", "block", epochs)
    inside = Window.partitionBy("source", "epoch", "block").orderBy(
        F.xxhash64(F.lit(SEED), "epoch", "doc_id", "n_tokens"), "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    summed = copies.withColumn("upto", F.sum("n_tokens").over(inside))
    placed = summed.join(before, summed["source"].eqNullSafe(before["s"]) & (summed["block"] == before["b"])
                         & (summed["epoch"] == before["e"])).withColumn("end", F.col("offset") + F.col("upto"))
    return placed.filter(F.col("end") <= F.col("budget")).select(
        "doc_id", "source", "n_tokens", "epoch", "block", ((F.col("end") - F.col("n_tokens")) / F.col("budget")).alias("position"), "weight")


def op9_mix_sources(spark, sf_dir: str) -> DataFrame:
    return draw(table(spark, sf_dir, "documents"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The drawn copies as rows of ``docs``, with its columns.

    Rows are told apart by a hash of all their columns; rows that are equal
    throughout share their draws.  The texts are shuffled once."""
    row = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.xxhash64(*row).alias("id"), F.struct(*row).alias("row"), "source", "text")
    drawn = draw(keyed.select(F.col("id").alias("doc_id"), "source", "text"))
    copies = drawn.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").cast("int").alias("copies"))
    one = keyed.select("id", "row").dropDuplicates(["id"])
    return one.join(copies, "id").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
