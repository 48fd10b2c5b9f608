"""Vectorised 64-bit hashing of words over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(BASE, -1, 1 << 64)
_WINDOW = 1 << 18          # bytes hashed in one numpy step
_LONG_WORD = 1 << 16       # longer words are hashed one by one


def times(k: int) -> np.uint64:
    """``k`` steps of the golden ratio, modulo 2^64."""
    return np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)


def _powers(b: int, n: int) -> np.ndarray:
    out = np.full(n, b, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS, _INVERSES = _powers(BASE, _WINDOW + _LONG_WORD), _powers(_INVERSE, _WINDOW + _LONG_WORD)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    a = pc.fill_null(column, "").cast(pa.large_string())
    off = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], dtype=np.uint8) if off[-1] else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + (((data >= 65) & (data <= 90)) * np.uint8(32)).astype(np.uint8)


def not_space(data: np.ndarray) -> np.ndarray:
    return ~((data == 32) | ((data >= 9) & (data <= 13)))


def letter_or_digit(data: np.ndarray) -> np.ndarray:
    """ASCII letters and digits, and every byte of other characters."""
    return (data >= 128) | ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122)) | ((data >= 65) & (data <= 90))


def words(data: np.ndarray, off: np.ndarray, inside_of=not_space) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, a run of bytes ``inside_of``, and the first word of each row."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(off), np.int64)
    inside = inside_of(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate(([True], ~inside[:-1]))))
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate((~inside[1:], [True])))) + 1
    return starts, ends, np.searchsorted(starts, off)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, equal for equal bytes wherever they stand."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _WINDOW, "right")))
        if ends[i] - base > _LONG_WORD:
            word = data[base:ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            i += 1
            continue
        chunk = data[base:ends[j - 1]]
        sums = np.zeros(len(chunk) + 1, np.uint64)
        np.cumsum(_BYTES[chunk] * _POWERS[:len(chunk)], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * _INVERSES[s])
        i = j
    return out


def combine(columns: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """Hash of equally long columns, row by row; the order of columns counts."""
    acc = np.full(len(columns[0]), times(seed) ^ np.uint64(1), dtype=np.uint64)
    for c in columns:
        acc = mix(acc * np.uint64(BASE) + c)
    return acc
