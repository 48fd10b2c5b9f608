"""Quality rules by weak supervision (DataFrame functions only).

Each rule votes good (1), bad (0) or abstains (null) on a document.  No labels
are used: expectation-maximisation over the counts of vote patterns estimates
how accurate every rule is and how many documents are good, and a document is
kept when its posterior probability of being good reaches a threshold.

Scale: one scan computes the statistics of a text inside its row, without a
shuffle; they are stored for the second step.  The only shuffle is the count of vote patterns; rules are fixed, so
there are at most 3^rules patterns however large the corpus is, and the
iteration runs over that table of counts.

Cases: a null or empty text has zero words, fails the base rule and is not
kept; repeated rows and ties get equal results; an empty table gives an empty
result; columns beyond the id and the text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, table

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP_AT = 0.5


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(words: Column) -> Column:
    """Words inside 8-word windows found twice or more in ``words``.

    A window is compared by a 64-bit hash of its eight words.  With the starts
    of repeated windows in order, each covers the words up to the next start,
    8 at most."""
    def once(value: Column, f) -> Column:  # computes ``value`` once, however often ``f`` uses it
        return F.get(F.transform(F.array(value), f), F.lit(0))

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def ordered(w: Column) -> Column:
        return F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def starts(a: Column) -> Column:
        return F.array_sort(F.array_compact(F.transform(a, lambda x, j: F.when(
            (x["h"] == F.get(a, j - 1)["h"]) | (x["h"] == F.get(a, j + 1)["h"]), x["i"]))))

    def covered(s: Column) -> Column:
        return F.aggregate(F.transform(s, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(s, j + 1) - p, F.lit(WINDOW)))),
                           F.lit(0), lambda a, x: a + x)

    return F.when(F.size(words) <= WINDOW, 0).otherwise(
        once(F.transform(words, lambda w: F.xxhash64(w)), lambda h: once(windows(h), lambda w: F.when(
            F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(once(ordered(w), lambda a: once(starts(a), covered))))))


def text_stats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with the counts that the rules read."""
    t = F.coalesce(F.col(text), F.lit(""))
    raw = docs.select(F.col(id_col).alias("doc_id"), t.alias("_t")).select(
        "doc_id", "_t",
        F.filter(F.split("_t", SPACE), lambda w: w != "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: _without(x, SPACE_CHARS) != "").alias("_l"))
    letters = F.regexp_replace("_t", r"[^\p{L}]+", "")
    return raw.select(
        "doc_id",
        F.size("_w").cast("bigint").alias("n_words"),
        F.char_length(_without(F.col("_t"), SPACE_CHARS)).cast("bigint").alias("word_chars"),
        (F.char_length("_t") - F.char_length(_without(F.col("_t"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("_w")).cast("bigint").alias("n_repeat_words"),
        F.size("_l").cast("bigint").alias("n_lines"),
        F.char_length(letters).cast("bigint").alias("n_letters"),
        (F.char_length(letters) - F.char_length(F.regexp_replace("_t", r"[^\p{L}]+|\p{Lu}+", ""))).cast("bigint").alias("n_upper"))


def votes() -> dict[str, Column]:
    """Rule name -> 1 (good), 0 (bad) or null (abstains), on ``text_stats``.

    A rule that looks for one fault only votes bad or abstains: a text without
    that fault may have another."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    length = F.col("word_chars") / words
    symbols = F.col("n_symbols") / words
    repeats = F.col("n_repeat_words") / words
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    upper = F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1))
    letters = F.col("n_letters") / F.greatest(F.col("word_chars"), F.lit(1))

    def bad_if(x: Column) -> Column:
        return F.when(x, 0)

    return {
        "word_length": bad_if((length < 2) | (length > 16)),
        "symbols": bad_if(symbols > 0.2),
        "repeated_windows": bad_if(repeats > 0.25),
        "repeated_lines": bad_if((F.col("n_lines") >= 4) & (lines > 0.3)),
        "upper_case": bad_if((F.col("n_letters") >= 50) & (upper > 0.5)),
        "letters": F.when(letters < 0.6, 0).when((letters >= 0.85) & (symbols <= 0.05), 1),
        "plain_prose": F.when((length >= 2.5) & (length <= 12) & (upper <= 0.2) & (symbols <= 0.05) & (repeats <= 0.25), 1),
    }


# Chance that a rule votes bad, votes good or abstains on a good and on a bad
# document, before any data is seen.
START = {"good": (0.02, 0.6, 0.38), "bad": (0.3, 0.3, 0.4)}
BAD, GOOD, ABSTAIN = 0, 1, 2


def fit(patterns: list[tuple[tuple[int | None, ...], int]], rounds: int = 200, prior: float = 0.9,
        weight: float = 10.0) -> dict:
    """Expectation-maximisation over counted vote patterns.

    Returns the share of good documents and, per rule, the chances of a bad
    vote, a good vote and abstaining on good and on bad documents.  ``weight``
    documents of the starting guess stay in every estimate, so it is defined
    for an empty table.  A rule must be at least as right as a coin: where its
    bad votes are likelier on good documents than on bad ones, or its good
    votes on bad ones, both classes get the pooled chance; so the two classes
    cannot trade places."""
    k = len(patterns[0][0]) if patterns else 0
    model = {"good": prior, "rules": [START] * k}
    for _ in range(rounds):
        total = good = 0.0
        seen = [{"good": [0.0] * 3, "bad": [0.0] * 3} for _ in range(k)]
        for pattern, n in patterns:
            p = posterior(model, pattern)
            total, good = total + n, good + n * p
            for s, v in zip(seen, pattern):
                s["good"][_vote(v)] += n * p
                s["bad"][_vote(v)] += n * (1 - p)
        new = {"good": (good + weight * prior) / (total + weight), "rules": [_rule(s, weight) for s in seen]}
        moved = abs(new["good"] - model["good"]) + sum(
            abs(x - y) for r, q in zip(new["rules"], model["rules"]) for c in r for x, y in zip(r[c], q[c]))
        model = new
        if moved < 1e-10:
            break
    return model


def _vote(v: int | None) -> int:
    return ABSTAIN if v is None else v


def _rule(seen: dict, weight: float) -> dict:
    n = {c: sum(seen[c]) + weight for c in seen}
    out = {c: [(x + weight * g) / n[c] for x, g in zip(seen[c], START[c])] for c in seen}
    for v, wrong in ((BAD, out["good"][BAD] > out["bad"][BAD]), (GOOD, out["bad"][GOOD] > out["good"][GOOD])):
        if wrong:
            pooled = sum(out[c][v] * n[c] for c in out) / sum(n.values())
            for c in out:
                out[c][v] = pooled
    return {c: tuple(x / sum(p) for x in p) for c, p in out.items()}


def accuracies(model: dict) -> list[float]:
    """Per rule, the estimated chance that a vote it casts is right."""
    g = model["good"]
    return [(g * r["good"][GOOD] + (1 - g) * r["bad"][BAD])
            / max(1e-12, g * sum(r["good"][:2]) + (1 - g) * sum(r["bad"][:2])) for r in model["rules"]]


def _odds(a: float, b: float) -> float:
    return math.log(max(a, 1e-9)) - math.log(max(b, 1e-9))


def _evidence(model: dict) -> tuple[float, list[list[float]]]:
    """Log odds of being good: of the prior, and of each outcome of each rule."""
    return (_odds(model["good"], 1 - model["good"]),
            [[_odds(r["good"][v], r["bad"][v]) for v in (BAD, GOOD, ABSTAIN)] for r in model["rules"]])


def posterior(model: dict, pattern: tuple[int | None, ...]) -> float:
    base, rules = _evidence(model)
    x = base + sum(r[_vote(v)] for r, v in zip(rules, pattern))
    return 1 / (1 + math.exp(-x)) if x >= 0 else 1 - 1 / (1 + math.exp(x))


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", reuse: bool = True) -> DataFrame:
    """Statistics, votes ``v_<rule>``, posterior ``p_good``, ``base_failed`` and ``kept``.

    ``reuse`` stores ids, statistics and votes between the two uses of them;
    without it they are computed twice, which suits ids as wide as a text."""
    rules = votes()
    cols = [f"v_{r}" for r in rules]
    voted = text_stats(docs, id_col, text).select("*", *[v.cast("int").alias(f"v_{r}") for r, v in rules.items()])
    if reuse:
        voted = checkpoint(voted)
    counted = voted.groupBy(*cols).count().collect()  # 3^rules rows at most
    model = fit(sorted(((tuple(r[c] for c in cols), r["count"]) for r in counted),
                       key=lambda x: tuple(-1 if v is None else v for v in x[0])))
    base, evidence = _evidence(model)
    odds = F.lit(base)
    for c, e in zip(cols, evidence):
        odds = odds + F.when(F.col(c) == 1, e[GOOD]).when(F.col(c) == 0, e[BAD]).otherwise(e[ABSTAIN])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (voted.withColumn("p_good", 1 / (1 + F.exp(-odds)))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_AT)))


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept", "p_good")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns.

    The verdict is computed in the row itself, so no join is needed."""
    stamped = docs.select(F.struct(*docs.columns).alias("doc_id"), F.col("text").alias("text"))
    return score(stamped, reuse=False).filter("kept").select("doc_id.*")
