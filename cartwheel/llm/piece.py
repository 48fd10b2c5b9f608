"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

Encoding merges adjacent symbols, always the pair whose joined piece has the
best score, the leftmost on ties.  A normalised text is a row of segments, each
a run of the space mark and the characters up to the next one.  No piece goes
on past the end of a segment (checked when the vocabulary is loaded), so
segments are encoded one by one and the distinct ones are remembered, up to a
bound, by each Python worker.

Short segments of an Arrow batch are merged together: each has an agenda of its
adjacent pairs, a row of a matrix, and every round takes the best pair of every
row.  Long ones use a heap as agenda.  Every newly encoded segment is checked
against the ``sentencepiece`` library; should they differ, the ids of the
library are returned and counted in ``n_corrected``.

Scale: one pass without a shuffle; memory is bounded by the batch step and the
number of remembered segments.  The vocabulary is opened by name from the
installed ``public_tokenizers`` package, or by a path that every executor sees.

Cases: a null text is an empty one, which has the end id only; an empty table
gives an empty result; repeated rows get equal results; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
SHORT = 24              # segments up to so many characters are merged in a matrix
LONG_SEGMENT = 64         # characters; longer segments are not remembered
REMEMBERED = 500_000    # distinct segments in each of the two generations that a worker keeps
STEP = 1 << 22          # bytes of text encoded together
_NONE = -0x7FFFFFFF     # no symbol
_EMPTY = np.iinfo(np.int32).max


class Pieces:
    """A BPE vocabulary and its merge table, read through the library."""

    def __init__(self, model_file: str):
        import sentencepiece
        self.lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        sp, n = self.lib, self.lib.get_piece_size()
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        normal = [i for i in range(n) if not special[i]]
        self.id = {self.piece[i]: i for i in normal}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece goes on after a space mark inside it; segments are not independent")
        self.byte = {int(self.piece[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        # rank 0 is the best score; equal scores have equal ranks, and the leftmost pair wins
        score = {i: sp.get_score(i) for i in normal}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {i: rank[s] for i, s in score.items()}
        # symbols are numbered by piece id; single characters outside the vocabulary get no pair
        self.merge: dict[tuple[int, int], int] = {}
        for p, i in self.id.items():
            for cut in range(1, len(p)):
                a, b = self.id.get(p[:cut]), self.id.get(p[cut:])
                if a is not None and b is not None:
                    self.merge[a, b] = i
        self._pair_table()
        # symbol of every single character: its piece, or a negative number outside the vocabulary
        self.symbol = -1 - np.arange(0x110000, dtype=np.int32)
        for p, i in self.id.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        self.plain = [None if i in self.byte_of or i == self.unknown else p if i in self.rank else ""
                      for i, p in enumerate(self.piece)]

    def _pair_table(self) -> None:
        """Open-addressing table of pair -> (rank, piece) for whole arrays of pairs."""
        pairs = np.array([(a << 32) | b for a, b in self.merge], np.int64)
        made = np.array(list(self.merge.values()), np.int64)
        bits = int(np.ceil(np.log2(len(pairs) * 4 + 16)))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.made = np.zeros(1 << bits, np.int32)
        self.ranks = np.full(1 << bits, _EMPTY, np.int32)
        place, left, self.probes = self._place(pairs), np.arange(len(pairs)), 0
        while len(left):
            self.probes += 1
            free = self.keys[place[left]] == -1
            slot, first = np.unique(place[left[free]], return_index=True)
            taken = left[free][first]
            self.keys[slot], self.made[slot] = pairs[taken], made[taken]
            self.ranks[slot] = [self.rank[i] for i in made[taken].tolist()]
            left = np.setdiff1d(left, taken, assume_unique=True)
            place[left] = (place[left] + 1) & self.mask

    def _place(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or a very large one) and piece of each pair; negative symbols never merge."""
        pairs = (a.astype(np.int64) << 32) | b
        place = self._place(pairs)
        rank = np.full(len(pairs), _EMPTY, np.int32)
        made = np.zeros(len(pairs), np.int32)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        for _ in range(self.probes):
            at = place[todo]
            key = self.keys[at]
            hit = key == pairs[todo]
            rank[todo[hit]], made[todo[hit]] = self.ranks[at[hit]], self.made[at[hit]]
            todo = todo[~hit & (key != -1)]
            if not len(todo):
                break
            place[todo] = (place[todo] + 1) & self.mask
        return rank, made

    # ---- encoding

    def _symbols(self, text: str) -> np.ndarray:
        return self.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def _ids(self, symbols: list[int]) -> list[int]:
        """Symbols outside the vocabulary become the ids of their bytes."""
        if min(symbols) >= 0:
            return symbols
        out = []
        for s in symbols:
            if s >= 0:
                out.append(s)
            elif self.byte:
                out.extend(self.byte[b] for b in chr(-s - 1).encode("utf-8", "replace"))
            elif not out or out[-1] != self.unknown:  # a run of unknown characters is one id
                out.append(self.unknown)
        return out

    def merge_long(self, segment: str) -> list[int]:
        """Agenda as a heap of (rank, position) over a linked list of symbols."""
        sym = self._symbols(segment).tolist()
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def add(i: int) -> None:
            j = after[i]
            if j < n and (made := self.merge.get((sym[i], sym[j]))) is not None:
                heapq.heappush(agenda, (self.rank[made], i, sym[i], sym[j]))

        for i in range(n - 1):
            add(i)
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = after[i] if sym[i] == a else n
            if j >= n or sym[j] != b:
                continue  # one of the two has been merged meanwhile
            sym[i], sym[j] = self.merge[a, b], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                add(before[i])
            add(i)
        return self._ids([s for s in sym if s is not None])

    def merge_short(self, segments: list[str]) -> list[list[int]]:
        """Agendas of many short segments, one best pair of each per round."""
        out: list[list[int]] = [[] for _ in segments]
        length = np.array([len(s) for s in segments])
        width = int(length.max())
        sym = np.full((len(segments), width), _NONE, np.int64)
        at = np.arange(width) < length[:, None]
        sym[at] = self._symbols("".join(segments))
        rank = np.full((len(segments), max(width - 1, 1)), _EMPTY, np.int32)
        made = np.zeros_like(rank)
        if width > 1:
            r, m = self.look_up(sym[:, :-1].reshape(-1), sym[:, 1:].reshape(-1))
            rank, made = r.reshape(len(segments), -1), m.reshape(len(segments), -1)
        rows = np.arange(len(segments))
        while True:
            best = rank.argmin(axis=1)  # the leftmost of the least
            more = rank[np.arange(len(rows)), best] != _EMPTY
            for k in np.flatnonzero(~more).tolist():
                out[rows[k]] = self._ids(sym[k, :length[k]].tolist())
            if not more.any():
                return out
            rows, sym, rank, made, length, best = rows[more], sym[more], rank[more], made[more], length[more], best[more]
            k = np.arange(len(rows))
            sym[k, best] = made[k, best]
            # close the gap: what stands right of the merged pair moves one place left
            wide = np.arange(sym.shape[1])[None, :] > best[:, None]
            sym = np.where(wide, np.concatenate((sym[:, 1:], np.full((len(k), 1), _NONE)), axis=1), sym)
            gap = np.arange(rank.shape[1])[None, :] > best[:, None]
            rank = np.where(gap, np.concatenate((rank[:, 1:], np.full((len(k), 1), _EMPTY, np.int32)), axis=1), rank)
            made = np.where(gap, np.concatenate((made[:, 1:], np.zeros((len(k), 1), np.int32)), axis=1), made)
            length = length - 1
            # the two pairs next to the new symbol
            for side in (best - 1, best):
                ok = np.flatnonzero((side >= 0) & (side + 1 < length))
                r, m = self.look_up(sym[ok, side[ok]], sym[ok, side[ok] + 1])
                rank[ok, side[ok]], made[ok, side[ok]] = r, m
            last = np.flatnonzero(best + 1 >= length)
            last = last[best[last] < rank.shape[1]]
            rank[last, best[last]] = _EMPTY

    def encode_segments(self, segments: list[str]) -> list[tuple[list[int], bool]]:
        """Ids of each segment, and whether the library says the same."""
        out: list[list[int] | None] = [None] * len(segments)
        short = [i for i, s in enumerate(segments) if len(s) <= SHORT]
        for lo in range(0, len(short), 8192):
            part = short[lo:lo + 8192]
            for i, ids in zip(part, self.merge_short([segments[i] for i in part])):
                out[i] = ids
        for i, s in enumerate(segments):
            if out[i] is None:
                out[i] = self.merge_long(s)
        # the library puts the first space mark itself
        known = self.lib.encode([s[1:].replace(SPACE, " ") for s in segments], num_threads=1) if segments else []
        return [(k if k else o, o == k or not k) for o, k in zip(out, known)]

    # ---- decoding

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: the first space, which encoding has put there, is dropped."""
        first = next((i for i in ids if self.plain[i] != ""), None)
        text = self.decode_inner(ids)
        return text[1:] if first is not None and (self.plain[first] or "").startswith(SPACE) else text

    def decode_inner(self, ids: list[int]) -> str:
        """Pieces joined, bytes put together, space marks as spaces."""
        try:
            return "".join([self.plain[i] for i in ids]).replace(SPACE, " ")
        except TypeError:  # there are bytes or unknown characters
            pass
        out, pending = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(_bytes(pending))
                pending = bytearray()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i in self.rank:
                out.append(self.piece[i])
        if pending:
            out.append(_bytes(pending))
        return "".join(out).replace(SPACE, " ")


def _bytes(b: bytearray) -> str:
    """UTF-8 text; each byte that is not part of a character becomes U+FFFD."""
    out, i = [], 0
    while i < len(b):
        for n in (1, 2, 3, 4):
            try:
                out.append(bytes(b[i:i + n]).decode("utf-8"))
            except UnicodeDecodeError:
                continue
            i += n
            break
        else:
            out.append("�")
            i += 1
    return "".join(out)


@lru_cache(maxsize=2)
def load(model: str) -> Pieces:
    """A vocabulary by path, or by its name in ``public_tokenizers``."""
    if not os.path.isabs(model):
        import public_tokenizers
        model = public_tokenizers.path(model)
    return Pieces(model)


def segments_of(text: str) -> list[str]:
    """Segments of the normalised text: a run of space marks and what follows it."""
    if not text:
        return []
    words = (" " + text).replace(SPACE, " ").split(" ")[1:]
    if "" not in words:
        return [SPACE + w for w in words]
    out, marks = [], 0
    for k, w in enumerate(words):
        marks += 1
        if w or k == len(words) - 1:
            out.append(SPACE * marks + w)
            marks = 0
    return out


class Memory:
    """segment -> its ids as text, for the segments met lately.

    ``odd`` has, of the same segments, those whose decoded text is not the
    segment itself or whose ids the library corrected.  A segment of more than
    LONG_SEGMENT characters, such as a text without spaces, is forgotten with
    the next ones, so memory is bounded in bytes."""

    def __init__(self, pieces: Pieces, limit: int = REMEMBERED):
        self.pieces, self.limit = pieces, limit
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.odd: dict[str, tuple[str, bool]] = {}
        self.long: list[str] = []

    def learn(self, segments: set[str]) -> dict[str, str]:
        """Ids of all ``segments``, new ones encoded."""
        for s in self.long:
            self.young.pop(s, None)
            self.odd.pop(s, None)
        self.long = [s for s in segments if len(s) > LONG_SEGMENT]
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
            self.odd = {s: x for s, x in self.odd.items() if s in self.old}
        young, old = self.young, self.old
        wanted = [s for s in segments if s not in young]
        for s in wanted:
            if s in old:
                young[s] = old[s]
        new = [s for s in wanted if s not in old]
        for s, (ids, same) in zip(new, self.pieces.encode_segments(new)):
            young[s] = " ".join(map(str, ids))
            decoded = self.pieces.decode_inner(ids)
            if not same or decoded != s.replace(SPACE, " "):
                self.odd[s] = (decoded, not same)
        return young


@lru_cache(maxsize=2)
def memory(model: str, limit: int = REMEMBERED) -> Memory:
    return Memory(load(model), limit)


def _encode_texts(texts: list[str | None], model: str, add_end: bool, remember: int = REMEMBERED) -> list[tuple[str, int, str, int]]:
    pieces, known = load(model), memory(model, remember)
    parts = [segments_of(t or "") for t in texts]
    known_ids = known.learn({s for p in parts for s in p})
    # a segment begins with a space mark, so neither bytes nor ids of two segments belong together
    last = f" {pieces.end}" if add_end else ""
    out = []
    for p in parts:
        ids = (" ".join(map(known_ids.__getitem__, p)) + last).lstrip()
        odd = [s for s in p if s in known.odd] if known.odd else ()
        text = "".join([known.odd[s][0] if s in known.odd else s for s in p] if odd else p).replace(SPACE, " ")
        out.append((ids, ids.count(" ") + 1 if ids else 0, text[1:], sum(known.odd[s][1] for s in odd)))
    return out


def encode_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """The contract's columns; only digests leave the Python workers."""
    def sha(x: str) -> str:
        return hashlib.sha256(x.encode("utf-8")).hexdigest()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = _encode_texts(batch.column("text").to_pylist(), model, True)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([r[1] for r in rows], pa.int64()), pa.array([sha(r[0]) for r in rows]),
             pa.array([sha(r[2]) for r in rows]), pa.array([r[3] for r in rows], pa.int64())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_corrected"])
    return map_arrow(docs.select("doc_id", "text"), step,
                     f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, "
                     "decoded_sha256 string, n_corrected long", most=STEP)


def encode_documents(docs: DataFrame, model: str = MODEL, remember: int = 100_000) -> DataFrame:
    """``doc_id``, ``source``, ``ids`` (with the end id), ``n_tokens`` and the decoded ``text`` of every row.

    Workers that stay alive keep what they remember, beside whatever runs next
    on the executor; ``remember`` is smaller here than for the query alone."""
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = _encode_texts(batch.column("text").to_pylist(), model, True, remember)
        ids = [np.array(r[0].split(), np.int32) for r in rows]
        off = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("source"),
             pa.ListArray.from_arrays(off.astype(np.int32), np.concatenate(ids) if ids else np.empty(0, np.int32)),
             pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())],
            names=["doc_id", "source", "ids", "n_tokens", "text"])
    kinds = {c: docs.schema[c].dataType.simpleString() for c in ("doc_id", "source")}
    return map_arrow(docs.select("doc_id", "source", "text"), step,
                     f"doc_id {kinds['doc_id']}, source {kinds['source']}, ids array<int>, n_tokens long, text string")


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))
