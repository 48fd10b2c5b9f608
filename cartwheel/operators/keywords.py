"""Search-phrase segmentation as a table operation."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import WORD_TOKEN, WORD_TOKEN_NOT_HAN, cjk_bigrams, word_tokens
from ..session import ship_package


def keyword_explode(df: DataFrame, text: str = "full_word", pattern: str | None = None,
                    cjk: bool = False, keep=("rt",)) -> DataFrame:
    """``LATERAL TABLE(split(text))``: one row per word (inner: a phrase with
    no word yields no row).  ``cjk=True`` cuts Han runs into bigrams instead of
    keeping them whole."""
    toks = word_tokens(text, pattern or (WORD_TOKEN_NOT_HAN if cjk else WORD_TOKEN))
    if cjk:
        toks = F.concat(toks, cjk_bigrams(text))
    return df.select(*keep, F.explode(toks).alias("word"))


CHUNK = 1_000        # positions of a text that are looked at together
SLOT_BITS = 21       # of the slots that mark the words of a dictionary and their beginnings
PIECES = 256         # pieces of texts in one numpy step
BROADCAST = 8 << 20  # bytes of words up to which a dictionary is sent to every task
_FACTOR = 0x9E3779B97F4A7C15


def prefix_levels(dictionary: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A dictionary (column ``word``) as a prefix tree of three levels.

    ``first``: the first characters of its words, at most one row per character
    there is; ``stem``, ``sizes``: their beginnings of the length of the
    shortest word, each with the lengths that its words have; ``word``."""
    words = dictionary.select("word").filter(F.length("word") > 0).distinct()
    least = words.select(F.min(F.length("word"))).scalar()
    stems = (words.select(F.substr("word", F.lit(1), least).alias("stem"), F.length("word").alias("size")).distinct()
             .groupBy("stem").agg(F.collect_set("size").alias("sizes")))  # one for each length of a word
    return words.select(F.substr("word", F.lit(1), F.lit(1)).alias("first")).distinct(), stems, words


def _slots(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(29))) * np.uint64(_FACTOR) >> np.uint64(64 - SLOT_BITS)


def _word_slots(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """``whole``, ``slot``: of every word (true), and of every shorter beginning of ``least`` characters or more (false)."""
    for batch in batches:
        whole, hashes = [], []
        for word in batch.column("word").to_pylist():
            h = 1
            for i, c in enumerate(word, 1):
                h = (h * _FACTOR + ord(c)) & 0xFFFFFFFFFFFFFFFF
                if i >= least:
                    whole.append(i == len(word))
                    hashes.append(h)
        slots = _slots(np.array(hashes, np.uint64)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(whole, pa.bool_()), pa.array(slots)], names=["whole", "slot"])


def word_slots(words: DataFrame, least: int) -> np.ndarray:
    """Per slot 1 if a word is in it, 2 if a shorter beginning of a word is, 3 if both; of one size however many words there are."""
    out = np.zeros(1 << SLOT_BITS, np.uint8)
    ship_package(words.sparkSession)
    marked = (words.select("word").mapInArrow(partial(_word_slots, least=least), "whole boolean, slot long")
              .groupBy("whole", F.bitmap_bucket_number(F.col("slot") + 1).alias("bucket"))  # its buckets count from 1
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot") + 1)).alias("bits")))
    for r in marked.collect():
        bits = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8), bitorder="little")
        part = out[(r.bucket - 1) * len(bits):r.bucket * len(bits)]
        part |= bits[:len(part)] << (0 if r.whole else 1)
    return out


def likely_words(pieces: list[str], chunk: int, least: int, most: int, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece and position (from 0, below ``chunk``) where the dictionary words in the pieces begin, and few others.

    All positions take ``least`` characters, and those go on, by one character
    at a time, whose beginning ``marked`` has as that of a longer word.  A word
    may seem to lie across two pieces; whether it is one is seen later."""
    size = np.array([len(p) for p in pieces], np.int64)
    start = np.cumsum(size) - size
    n = int(size.sum())
    codes = np.zeros(n + most, np.uint64)
    codes[:n] = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
    h = np.full(n, _FACTOR, np.uint64)
    for k in range(least):
        if k:
            h *= np.uint64(_FACTOR)
        h += codes[k:k + n]
    found = marked[_slots(h)]
    at = np.flatnonzero(found)
    found, h = found[at], h[at]
    hit = np.zeros(n, bool)
    for k in range(least, most + 1):
        hit[at[found & 1 > 0]] = True
        on = found > 1
        at, h = at[on], h[on]
        if k == most or not len(at):
            break
        h = h * np.uint64(_FACTOR) + codes[at + k]
        found = marked[_slots(h)]
    at = np.flatnonzero(hit)
    piece = np.searchsorted(start, at, "right") - 1
    at -= start[piece]
    inside = at < chunk
    return piece[inside], at[inside]


def dictionary_words(df: DataFrame, dictionary: DataFrame, text: str = "full_word", keep=("rt",), longest: bool = False) -> DataFrame:
    """Dictionary segmentation (X1): every substring that is a dictionary word, with
    its position, so repeats are counted.

    ``longest``: only words that do not lie inside another one found; ``keep``
    then has to name the text (rows alike in it are one text).

    Most positions of a text begin no word.  They are left out before they
    become rows: slots of fixed size mark the hashes of all words and of their
    beginnings, and the positions of a batch are extended, all together, while
    their beginning is marked.  No word is missed by that; the few other
    positions that pass walk down the levels of the dictionary
    (``prefix_levels``) with the rest: a position goes on if a word begins with
    its character, then if a word begins with its stem, and then only for the
    lengths of the words with that stem.  The first level has no more rows than
    there are characters, so it is broadcast, and so are the others of a
    dictionary up to BROADCAST bytes; those of a larger one are joined as Spark
    chooses.  Texts are cut into pieces of CHUNK positions that overlap by the
    longest word, so no row holds all substrings of its text.
    """
    first, stems, words = prefix_levels(dictionary)
    least, most, total = words.select(F.min(F.length("word")), F.max(F.length("word")), F.sum(F.octet_length("word"))).first()
    least, most, chunk = least or 1, most or 0, CHUNK
    marked = word_slots(words, least) if most else None
    if (total or 0) <= BROADCAST:
        stems, words = F.broadcast(stems), F.broadcast(words)
    pieces = (df.filter(F.length(text) > 0)
                .select(*keep, F.posexplode(F.transform(
                    F.sequence(F.lit(0), F.floor((F.length(text) - 1) / chunk).cast("int")),
                    lambda i: F.substr(F.col(text), i * chunk + 1, F.lit(chunk - 1 + most)))).alias("_n", "_piece")))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for received in batches if most else ():
            for lo in range(0, received.num_rows, PIECES):
                batch = received.slice(lo, PIECES)
                texts = batch.column("_piece").to_pylist()
                piece, at = likely_words(texts, chunk, least, most, marked)
                kept = batch.select([*keep, "_n"]).take(pa.array(piece))
                pos = kept.column("_n").to_numpy().astype(np.int64) * chunk + at + 1
                rest = [texts[p][i:i + most] for p, i in zip(piece.tolist(), at.tolist())]
                yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in keep), pa.array(pos.astype(np.int32)), pa.array(rest, pa.string())],
                                                 names=[*keep, "pos", "_rest"])

    schema = T.StructType([*(pieces.schema[c] for c in keep), T.StructField("pos", T.IntegerType()), T.StructField("_rest", T.StringType())])
    at = pieces.mapInArrow(positions, schema)
    begun = at.join(F.broadcast(first), F.substr("_rest", F.lit(1), F.lit(1)) == F.col("first"), "left_semi")
    stemmed = begun.withColumn("_stem", F.substr("_rest", F.lit(1), F.lit(least))).join(stems, F.col("_stem") == F.col("stem"))
    cand = (stemmed.select(*keep, "pos", "_rest", F.explode("sizes").alias("_size")).filter(F.length("_rest") >= F.col("_size"))
            .select(*keep, "pos", F.substr("_rest", F.lit(1), F.col("_size")).alias("word")))
    found = cand.join(words, "word", "left_semi").select("word", *keep, "pos")
    if not longest:
        return found
    # the longest word at a place comes first; a word stays if none before it reaches as far
    end = F.col("pos") + F.length("word")
    reach = F.max(end).over(Window.partitionBy(*keep).orderBy("pos", end.desc(), F.desc("word")).rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("_reach", reach).filter(F.col("_reach").isNull() | (F.col("_reach") < end)).select("word", *keep, "pos")


def register_split_udtf(spark, name: str = "SplitFunction", pattern: str = WORD_TOKEN):
    """A SQL-callable table function for ``LATERAL`` queries.

    Row-at-a-time Python; use ``keyword_explode`` on large inputs.  Returns the
    registered function, or ``None`` where Python UDTFs or the ``regex`` module are missing.
    """
    try:
        import regex
        from pyspark.sql.functions import udtf
    except ImportError:  # pragma: no cover
        return None
    rx = regex.compile(pattern)
    ship_package(spark)

    @udtf(returnType="word: string")
    class _Split:
        def eval(self, text):
            if text is None:
                return
            for m in rx.finditer(text):
                yield (m.group(0).lower(),)

    spark.udtf.register(name, _Split)
    return _Split
