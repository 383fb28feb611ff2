"""Words and hashes of many texts at once, on the bytes of an Arrow column.

All hashes are 64-bit polynomials over a table of byte values, finished by a mixer; they depend
on the bytes alone, so the same words hash alike in every task.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


VALUES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
LOWER_VALUES = VALUES[ASCII_LOWER]


@lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, max(20, int(n).bit_length()))


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts end to end, and where each text starts (one more entry than texts)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def prefix_hash(data: np.ndarray, values: np.ndarray = VALUES) -> np.ndarray:
    out = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(values[data] * powers(BASE, len(data))[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    h = (prefix[ends] - prefix[starts]) * powers(INVERSE, len(prefix))[starts]
    return mix(h + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, at: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for every text the number of its first word."""
    inside = is_word[data]
    fresh = np.ones(len(data) + 1, dtype=bool)
    fresh[1:-1] = ~inside[:-1]
    fresh[at[:-1]] = True
    last = np.ones(len(data) + 1, dtype=bool)
    last[:-2] = ~inside[1:]
    last[at[1:] - 1] = True  # of an empty text at the start this is the spare last entry
    starts = np.flatnonzero(inside & fresh[:-1])
    ends = np.flatnonzero(inside & last[:-1]) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(texts: pa.Array, is_word: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lowered, and for every text the number of its first word."""
    data, at = column_bytes(texts)
    starts, ends, first = word_spans(data, at, is_word)
    return span_hash(prefix_hash(data, LOWER_VALUES), starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every n consecutive words of a text, or of the whole sequence of a shorter one."""
    odd = mix(np.arange(1, n + 1, dtype=U)) | U(1)
    counts = np.diff(first)
    long = np.maximum(counts - n + 1, 0)
    short = (counts > 0) & (counts < n)
    per = np.where(short, 1, long)
    begin = np.concatenate([[0], np.cumsum(per)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1], per) + np.repeat(first[:-1], per)
    size = np.repeat(np.minimum(counts, n), per)
    total = size.astype(U) * U(0xA0761D6478BD642F)
    for j in range(n):
        there = j < size
        if there.all():
            total += words[at + j] * odd[j]
        else:
            total[there] += words[at[there] + j] * odd[j]
    return mix(total), begin


def text_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
