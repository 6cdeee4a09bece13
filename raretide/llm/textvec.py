"""Vectorised word and shingle hashing over Arrow string batches (runs inside Spark tasks).

Words are maximal runs of bytes outside a separator set, after lower-casing A-Z, so a word never needs
decoding: every separator used here is an ASCII byte.  A word's hash is a polynomial over its bytes
modulo 2**64, taken from one running sum over the batch, then mixed.  Memory is bounded by
``SEGMENT`` bytes per step, whatever the length of a text.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SEGMENT = 1 << 20
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACE_SEP = np.zeros(256, dtype=bool)
SPACE_SEP[[0x20, *range(0x09, 0x0E)]] = True


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_P, _P_INV):
        p = np.full(n + 1, base, dtype=U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (two multiply-xorshift rounds)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets (n + 1) of a string array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    offs = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=n + 1 + texts.offset)[texts.offset:]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]] if n else data[:0], (offs - offs[0]) if n else np.zeros(1, np.int64)


def _segments(data: np.ndarray, offs: np.ndarray, sep: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SEGMENT bytes that end at a text boundary or at a separator."""
    at, end = 0, len(data)
    while at < end:
        to = min(at + SEGMENT, end)
        if to < end:
            cut = int(offs[np.searchsorted(offs, to, side="right") - 1])
            if cut <= at:  # inside one long text: the last separator, or else the next one
                back = np.flatnonzero(sep[data[at:to]])
                if len(back):
                    cut = at + int(back[-1]) + 1
                else:
                    limit, cut = int(offs[np.searchsorted(offs, at, side="right")]), to
                    while cut < limit and not sep[data[cut]]:
                        cut += 1
            to = cut
        yield at, to
        at = to


def word_hashes(data: np.ndarray, offs: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    hashes, starts = [], []
    for at, to in _segments(data, offs, sep):
        part = data[at:to]
        gap = sep[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        lo, hi = np.searchsorted(offs, [at, to])
        edge[offs[lo:hi] - at] = True
        edge[0] = edge[-1] = True
        word = ~gap
        before = np.empty(len(part), dtype=bool)
        before[0], before[1:] = True, gap[:-1]
        s = np.flatnonzero(word & (before | edge[:-1]))
        after = np.empty(len(part), dtype=bool)
        after[-1], after[:-1] = True, gap[1:]
        e = np.flatnonzero(word & (after | edge[1:])) + 1
        up, down = _powers(max(SEGMENT, len(part)))
        run = np.zeros(len(part) + 1, dtype=U)
        np.cumsum((LOWER[part].astype(U) + U(1)) * up[:len(part)], out=run[1:])
        hashes.append(mix((run[e] - run[s]) * down[s] + (e - s).astype(U)))
        starts.append(s + at)
    if not hashes:
        return np.zeros(0, U), np.zeros(len(offs) - 1, np.int64)
    pos = np.concatenate(starts)
    return np.concatenate(hashes), np.diff(np.searchsorted(pos, offs))


def shingle_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles in order and their number per text.

    A text of fewer words, but not none, has one shingle: its whole sequence."""
    n_out = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(counts)])
    out_first = np.concatenate([[0], np.cumsum(n_out)])
    total = int(out_first[-1])
    if not total:
        return np.zeros(0, U), n_out
    doc = np.repeat(np.arange(len(counts)), n_out)
    at = first[doc] + (np.arange(total) - out_first[doc])
    full = counts[doc] >= width
    acc = np.zeros(total, dtype=U)
    factor = [U(pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64)) for j in range(width)]
    for j in range(width):
        if j == 0:
            acc += words[at] * factor[0]
            continue
        has = full | (j < counts[doc])
        acc[has] += words[at[has] + j] * factor[j]
    return mix(acc + np.minimum(counts[doc], width).astype(U)), n_out


def min_per_text(values: np.ndarray, counts: np.ndarray, fill: np.uint64) -> np.ndarray:
    """Smallest value of each text's run; ``fill`` where it has none."""
    out = np.full(len(counts), fill, dtype=values.dtype)
    has = counts > 0
    if has.any():
        out[has] = np.minimum.reduceat(values, (np.cumsum(counts) - counts)[has])
    return out


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a record batch so that the column's texts hold about ``limit`` bytes (one text at least)."""
    _, offs = buffers(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
        yield batch.slice(at, min(to, n) - at)
        at = to


@functools.lru_cache(maxsize=1)
def letter_flags() -> np.ndarray:
    """Whether each code point is a letter, or a mark, which belongs to one."""
    return np.array([unicodedata.category(chr(cp))[0] in "LM" for cp in range(0x110000)])


@functools.lru_cache(maxsize=1)
def base_letter_flags() -> np.ndarray:
    """Whether each code point is a letter itself."""
    return np.array([unicodedata.category(chr(cp))[0] == "L" for cp in range(0x110000)])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gaps_joined(cp: np.ndarray, is_letter: np.ndarray) -> np.ndarray:
    """Code points with every run of non-letters as one space; none at the start."""
    if not len(cp):
        return cp
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    return np.where(is_letter, cp, 32)[keep]


def release() -> None:
    """Give free memory, Arrow's and the C library's, back at the end of a task: the worker process goes on to others."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)
