"""Token counts of sections by offset-mapped attribution.

A document is encoded once, whole, with a byte-level BPE vocabulary.  The bytes
of its tokens give each token's place in the text; places are joined with the
intervals of the sections.  A token inside one section counts for it.  A token
across a border counts whole for the section that holds most of its bytes, the
earlier one on ties; so the sections' counts add up to the document's.

A section is a line with its line end, unless intervals are given.  Tokens
that touch no given interval are counted under section -1.

Scale: one pass without a shuffle; both sides of the interval join are ordered
within a document, so it is a merge inside the row.  Given intervals meet the
documents in one join by id.

Cases: a null or empty text has one empty section without tokens; an empty
table gives an empty result; repeated rows get equal results; further columns
are ignored.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, table

MODEL = "byte_bpe_50k.tiktoken"
# the library's pattern needs stack for every white space of a run
_LONG_RUN = regex.compile(r"\p{White_Space}{10000,}")


class Encoder:
    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.length[i] = len(token)

    def encode(self, text: str) -> list[int]:
        """The library's ids.  It takes long runs of white space as pieces of their own: all of a run but the last
        character, which the pattern leaves to the word behind it."""
        out, done = [], 0
        for m in _LONG_RUN.finditer(text):
            end = m.end() - (m.end() < len(text))
            out += self.encoding.encode_ordinary(text[done:m.start()]) + self.encoding._encode_single_piece(text[m.start():end])
            done = end
        return out + self.encoding.encode_ordinary(text[done:])

    def borders(self, text: str) -> np.ndarray:
        """Byte positions between the tokens of ``text``, both ends included."""
        return np.concatenate(([0], np.cumsum(self.length[self.encode(text)])))


@lru_cache(maxsize=2)
def load(model: str) -> Encoder:
    """A vocabulary by path, or by its name in ``public_tokenizers``."""
    import public_tokenizers
    return Encoder(model if os.path.isabs(model) else public_tokenizers.path(model), public_tokenizers.PATTERN)


def attribute(borders: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """Tokens of each interval (ordered, not overlapping, in bytes), then those of none; how many crossed."""
    lo, hi = borders[:-1], borders[1:]
    n = len(starts)
    first = np.searchsorted(ends, lo, "right")       # the first interval that ends after the token starts
    last = np.searchsorted(starts, hi, "left") - 1   # the last one that starts before the token ends
    owner = np.where(first <= last, first, n)
    crossing = np.flatnonzero(last > first)
    for t in crossing.tolist():
        k = np.arange(first[t], last[t] + 1)
        owner[t] = k[np.argmax(np.minimum(ends[k], hi[t]) - np.maximum(starts[k], lo[t]))]  # the earlier of equals
    return np.bincount(owner, minlength=n + 1), len(crossing)


def line_intervals(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    if not len(ends) or ends[-1] != len(data):
        ends = np.append(ends, len(data))
    return np.concatenate(([0], ends[:-1])), ends


def _characters(data: bytes, places: np.ndarray) -> np.ndarray:
    """Code points before each byte position."""
    begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.concatenate(([0], np.cumsum(begins)))[places]


def _count_lines(model: str):
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = load(model)
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        sizes = []
        for text in batch.column("text").to_pylist():
            data = (text or "").encode("utf-8")
            starts, ends = line_intervals(data)
            counts, _ = attribute(enc.borders(text or ""), starts, ends)
            sizes.append(len(starts))
            for o, x in zip(out, (np.arange(len(starts)), _characters(data, starts), _characters(data, ends), counts[:-1])):
                o.append(x)
        ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
        return pa.RecordBatch.from_arrays([ids] + [pa.array(np.concatenate(o).astype(np.int64)) for o in out[:4]],
                                          names=["doc_id", "section", "start", "end", "n_tokens"])
    return step


def _count_given(model: str):
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = load(model)
        at, section, start, end, n = [], [], [], [], []
        for i, (text, given) in enumerate(zip(batch.column("text").to_pylist(), batch.column("sections").to_pylist())):
            text = text or ""
            given = sorted(given or [], key=lambda s: (s["start"], s["end"]))
            place = np.concatenate(([0], np.cumsum([len(c.encode("utf-8")) for c in text]))).astype(np.int64)
            cut = lambda k: place[np.clip(np.array([s[k] for s in given], np.int64), 0, len(text))]
            counts, _ = attribute(enc.borders(text), cut("start"), cut("end"))
            rows = [(s["section"], s["start"], s["end"], c) for s, c in zip(given, counts.tolist())]
            if counts[-1] or not rows:
                rows.append((-1, 0, len(text), int(counts[-1])))
            for row in rows:
                at.append(i)
                for o, x in zip((section, start, end, n), row):
                    o.append(x)
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64()))] + [pa.array(o, pa.int64()) for o in (section, start, end, n)],
                                          names=["doc_id", "section", "start", "end", "n_tokens"])
    return step


def section_tokens(docs: DataFrame, sections: DataFrame | None = None, model: str = MODEL) -> DataFrame:
    """``doc_id``, ``section``, ``start``, ``end`` (code points, end exclusive), ``n_tokens``.

    ``sections``: ``doc_id``, ``section`` (a number), ``start``, ``end``, not
    overlapping within a document; without it, lines."""
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, section long, start long, end long, n_tokens long")
    rows = docs.select("doc_id", "text")
    if sections is None:
        return map_arrow(rows, _count_lines(model), schema)
    given = (sections.filter("doc_id is not null").groupBy("doc_id").agg(F.collect_list(F.struct("section", "start", "end")).alias("sections")))
    return map_arrow(rows.join(given, "doc_id", "left"), _count_given(model), schema)


def op6_section_tokens(spark, sf_dir: str) -> DataFrame:
    return section_tokens(table(spark, sf_dir, "documents"))
