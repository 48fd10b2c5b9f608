"""Keyword segmentation as column expressions (X1 / F8), whole texts only.

The reference calls a third-party Chinese segmenter per row.  Here a text
becomes an array of tokens with built-in functions, so the work stays in the
JVM and inside whole-stage code generation:

* ``word_tokens``: maximal runs of letters and digits of any script, lower-cased
  (or of another pattern).
* ``cjk_bigrams``: overlapping character pairs of each run of Han characters
  (the usual dictionary-free fallback for Chinese search terms).

Dictionary segmentation is a join: ``operators.keywords.dictionary_words``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default token pattern and the Han character class.
WORD_TOKEN = r"[\p{L}\p{N}]+"
WORD_TOKEN_NOT_HAN = r"[[\p{L}\p{N}]&&[^\p{IsHan}]]+"
HAN_RUN = r"\p{IsHan}+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(text, pattern: str = WORD_TOKEN) -> Column:
    """All matches of ``pattern`` in the whole text, lower-cased."""
    return F.transform(F.regexp_extract_all(_c(text), F.lit(pattern), 0), lambda w: F.lower(w))


def cjk_bigrams(text) -> Column:
    """Overlapping bigrams of each Han run; a one-character run is kept whole."""
    runs = F.regexp_extract_all(_c(text), F.lit(HAN_RUN), 0)

    def grams(run):
        n = F.length(run)
        return F.when(n <= 1, F.array(run)).otherwise(
            F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(run, i, 2)))

    return F.flatten(F.transform(runs, grams))

