"""Document fingerprints by one-permutation MinHash.

Each five-word shingle is hashed once; the top bits choose a bin, the smallest rest stays.  Empty bins take
the value of a filled one by optimal densification: every bin has its own random order of the others and
takes the first that is filled.  Of each value, rehashed with its bin number, the low ``BITS`` bits are
packed; likeness corrects the share of equal cells for chance hits of 2**-BITS.

Words are runs of characters other than ASCII white space, A-Z lower-cased.  A text of fewer than five words
is one shingle.  Null and empty texts, and texts without words, have the empty fingerprint ``""``: likeness
1 to each other and 0 to all else.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from raretide.llm import textvec as tv
from raretide.llm.common import ordered_pieces, table

BINS, BITS, WIDTH = 512, 4, 5
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_ROWS = 2048


@functools.lru_cache(maxsize=1)
def _orders() -> tuple[np.ndarray, np.ndarray]:
    """For each bin a random order of all bins, and each bin's place in it."""
    cell = np.arange(BINS * BINS, dtype=np.uint64).reshape(BINS, BINS) + np.uint64(0x51ED270B)
    order = np.argsort(tv.mix(cell * np.uint64(0x9E3779B97F4A7C15)), axis=1, kind="stable")
    return order, np.argsort(order, axis=1, kind="stable")


def _densify(cells: np.ndarray) -> np.ndarray:
    order, place = _orders()
    filled = cells != _NONE
    out = cells.copy()
    doc, bin_ = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for t in range(24):  # most bins meet a filled one soon
        if not len(doc):
            return out
        take = order[bin_, t]
        ok = filled[doc, take]
        out[doc[ok], bin_[ok]] = cells[doc[ok], take[ok]]
        doc, bin_ = doc[~ok], bin_[~ok]
    for d in np.unique(doc):  # few filled bins: look for the first of them in each bin's order
        have = np.flatnonzero(filled[d])
        want = bin_[doc == d]
        out[d, want] = cells[d, have[place[np.ix_(want, have)].argmin(axis=1)]]
    return out


def sketch(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells (texts x BINS, values below 2**BITS) and whether each text has words."""
    words, counts = tv.word_hashes(*tv.buffers(texts), tv.SPACE_SEP)
    hashes, n = tv.shingle_hashes(words, counts, WIDTH)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    cells = np.full((len(n), BINS), _NONE)
    at = np.repeat(np.arange(len(n)), n) * BINS + (hashes >> shift).astype(np.int64)
    np.minimum.at(cells.reshape(-1), at, hashes & ((np.uint64(1) << shift) - np.uint64(1)))
    own = np.arange(BINS, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (tv.mix(_densify(cells) ^ own) & np.uint64((1 << BITS) - 1)).astype(np.uint8), n > 0


def pack(cells: np.ndarray, has: np.ndarray) -> list[str]:
    packed = cells[:, 0::2] | (cells[:, 1::2] << 4)
    return [base64.b64encode(row.tobytes()).decode() if h else "" for row, h in zip(packed, has)]


def likeness(a: np.ndarray, has_a: np.ndarray, b: np.ndarray, has_b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard likeness of paired sketches, corrected for chance hits, in 0 to 1."""
    chance = 2.0 ** -BITS
    hit = (a == b).mean(axis=1)
    out = np.clip((hit - chance) / (1 - chance), 0.0, 1.0)
    return np.where(has_a & has_b, out, (has_a == has_b).astype(float))


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with a packed fingerprint of the column ``text`` added (or replaced)."""
    from pyspark.sql import functions as F
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def packed(s):
        import pandas as pd
        parts = []
        for at in range(0, len(s), _ROWS):
            batch = pa.RecordBatch.from_arrays([pa.array(s.iloc[at:at + _ROWS], pa.string(), from_pandas=True)], ["t"])
            for piece in tv.slices(batch, "t"):
                parts += pack(*sketch(piece.column(0)))
        return pd.Series(parts, dtype=object)

    return docs.withColumn(out, packed(F.col(text)))


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one piece in order, ended by the next piece's first document."""
    rest: tuple | None = None  # the last row seen: its successor is still to come
    closed = False

    def judged(ids, texts, follow, cells, has, next_cells, next_has):
        edited = []
        for s, t in zip(texts, follow):
            half = len(s) // 2
            edited.append(s[:len(s) - half] + t[:half])
        e_cells, e_has = sketch(pa.array(edited, pa.large_string()))
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(s) for s in texts], pa.int64()),
            pa.array([hashlib.sha256(s.encode()).hexdigest() for s in edited]),
            pa.array(pack(cells, has)), pa.array(pack(e_cells, e_has)),
            pa.array(likeness(cells, has, e_cells, e_has)), pa.array(likeness(cells, has, next_cells, next_has)),
        ], names=[f.split()[0] for f in _SCHEMA.split(", ")])

    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            for part in tv.slices(batch.slice(at, _ROWS), "text"):
                if closed:
                    continue
                ids = part.column("doc_id").to_pylist()
                texts = [t or "" for t in part.column("text").to_pylist()]
                halo = part.column("halo").to_pylist()
                stop = halo.index(True) + 1 if True in halo else len(ids)
                closed = stop < len(ids) or (stop and halo[stop - 1])
                ids, texts, halo = ids[:stop], texts[:stop], halo[:stop]
                cells, has = sketch(pa.array(texts, pa.large_string()))
                if rest:
                    ids, texts, halo = [rest[0], *ids], [rest[1], *texts], [False, *halo]
                    cells, has = np.concatenate([rest[2], cells]), np.concatenate([rest[3], has])
                n = len(ids) - 1
                if n:
                    known = np.array([i is not None for i in ids[:n]])
                    follow = [t if k else "" for t, k in zip(texts[1:], known)]
                    yield judged(ids[:n], texts[:n], follow, cells[:n], has[:n], cells[1:], has[1:] & known)
                rest = None if closed else (ids[-1], texts[-1], cells[-1:], has[-1:])
    if rest:  # only documents without an id: nothing follows
        none = np.zeros_like(rest[2])
        yield judged([rest[0]], [rest[1]], [""], rest[2], rest[3], none, np.zeros(1, bool))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each document and of its text with the second half replaced by the start of the next
    document's (ascending ``doc_id``; repeated ids in order of their texts; after the last the first).

    A document without an id has no next one: its edited text is its first half, ``near_next`` compares with
    the empty text.  An empty table gives an empty result."""
    return ordered_pieces(docs.select("doc_id", "text"), halo=True).select("doc_id", "text", "halo").mapInArrow(_compare, _SCHEMA)


def op1_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
