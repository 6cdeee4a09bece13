"""Byte-level BPE ids of whole texts and back, with long texts encoded by halves (tree concatenation).

A text of more than ``LEAF`` code points is halved until every part has at most that many.  The parts are rows of their own, encoded in
parallel wherever they land, and meet again by document in order, one document at a time in a task.  There neighbours are joined pairwise,
up the tree of halves, touching only the ids around each join:

* The *field* of a join reaches from the last place on its left to the first place on its right where the vocabulary's pattern cuts
  in every context: between a printable ASCII character and a white space.  Outside the field no id can change.
* In the field, pre-tokens that one half had already are taken over.  The ones that the cut broke are built from what the halves
  have of them: a window of a few ids on each side of the join is encoded again and grows until its first and last id are the ones the
  halves have at these places.  A sequence of ids of one pre-token is its BPE encoding exactly if each two neighbours are the
  encoding of their own bytes, so with both ends agreeing the joined ids are those of the whole.

Strings of the vocabulary's added tokens in a text are those tokens, as in the library, and nothing is joined across them.

Null texts are empty and have no ids.  Repeated rows keep a row each, with or without ids of their own; other columns are ignored; an empty
table gives an empty one.  ``docs`` should be a table (a scan), so that a repeated task meets the same rows again.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from raretide.llm import textvec as tv
from raretide.llm.common import table

LEAF, WINDOW = 16_384, 8
# Fixed value: the pattern by which byte-level vocabularies of this kind cut texts into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SAFE = re.compile(rb"[!-~][ \t\n\r]")
IDS = "doc_id long, ids array<int>"


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter by which such vocabularies write each byte: printable ones as they are, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    letters.update((chr(256 + k), b) for k, b in enumerate(b for b in range(256) if b not in plain))
    return letters


class Codec:
    """The vocabulary: ids of texts and of single pre-tokens, bytes of ids."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import pre_tokenizers
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        letters, model = _byte_letters(), told["model"]
        added = {t["content"]: t for t in told["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added.values()) or told["normalizer"] is not None:
            raise ValueError("added tokens that take in their surroundings, and normalizers, are not supported")
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in model["vocab"].items() if t not in added}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        made = [model["vocab"][a + b] for a, b in pairs]
        if made != sorted(made):
            raise ValueError("ids of this vocabulary do not follow the order of its merges")
        self.core = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.added = {t: x["id"] for t, x in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.bytes: list[bytes] = [b""] * (1 + max([*ranks.values(), *self.added.values()]))
        for t, i in itertools.chain(ranks.items(), ((t.encode(), i) for t, i in self.added.items())):
            self.bytes[i] = t
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)

    def segments(self, text: str) -> list[str]:
        """The text cut around added tokens, which are segments of their own."""
        if not self.cut or not any(t in text for t in self.added):
            return [text]
        return [s for s in self.cut.split(text) if s]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for s in self.segments(text):
            out += [self.added[s]] if s in self.added else self.core.encode_ordinary(s)
        return out

    def text_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def pre_tokens(self, raw: bytes) -> list[int]:
        """Byte positions of the borders of the pre-tokens, 0 and the end included."""
        return [0, *itertools.accumulate(len(s) for s, _ in self.level.pre_tokenize_str(raw.decode()))]


@functools.lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    own = Codec(path)
    tv.release()  # the parsed file
    return own


def splice(own: Codec, left: list[int], middle: bytes, right: list[int]) -> list[int]:
    """Ids of one pre-token from ids of its beginning and of its end and the bytes between."""
    i = j = WINDOW
    while True:
        a, b = left[-i:], right[:j]
        raw = own.text_bytes(a) + middle + own.text_bytes(b)
        ids = own.core.encode_single_piece(raw) if raw else []
        fits_left, fits_right = i >= len(left) or ids[0] == a[0], j >= len(right) or ids[-1] == b[-1]
        if fits_left and fits_right:
            return [*left[:-i], *ids, *right[j:]]
        i, j = (i if fits_left else 2 * i), (j if fits_right else 2 * j)


def _edge(own: Codec, ids: list[np.ndarray], end: bool) -> list[int]:
    """The ids of the field that a part of a text has at its end (or at its beginning)."""
    total, want = sum(map(len, ids)), 16
    while True:
        take, held = [], 0
        for x in reversed(ids) if end else ids:
            take.append(x[max(0, len(x) - want + held):] if end else x[:want - held])
            held += len(take[-1])
            if held >= want:
                break
        near = np.concatenate(take[::-1] if end else take) if take else np.zeros(0, np.int64)
        raw, at = own.text_bytes(near.tolist()), -1
        if end:
            for at in (m.start() + 1 for m in _SAFE.finditer(raw)):
                pass
        elif m := _SAFE.search(raw):
            at = m.start() + 1
        if at >= 0:
            k = int(np.searchsorted(np.cumsum(own.lengths[near]), at)) + 1
            return near[k:].tolist() if end else near[:k].tolist()
        if held >= total:
            return near.tolist()
        want *= 4


def _trim(ids: list[np.ndarray], n: int, end: bool) -> list[np.ndarray]:
    """Without ``n`` ids at the end (or at the beginning)."""
    out = list(ids)
    while n:
        x = out[-1] if end else out[0]
        if len(x) > n:
            out[-1 if end else 0] = x[:-n] if end else x[n:]
            break
        n -= len(x)
        out.pop(-1 if end else 0)
    return out


def _own_pieces(own: Codec, ids: list[int], raw: bytes, shift: int) -> dict[tuple[int, int], list[int]]:
    """The ids of each pre-token of a field, by its borders."""
    ends = [0, *itertools.accumulate(own.lengths[ids].tolist())]
    place = {e: k for k, e in enumerate(ends)}
    cuts = own.pre_tokens(raw)
    return {(a + shift, b + shift): ids[place[a]:place[b]] for a, b in itertools.pairwise(cuts)}


def join(own: Codec, left: list[np.ndarray], right: list[np.ndarray]) -> list[np.ndarray]:
    """Ids of a text from the ids of its two parts, each a list of arrays; only ids in the field are looked at."""
    if not left or not right:
        return left or right
    if _SAFE.fullmatch(own.bytes[left[-1][-1]][-1:] + own.bytes[right[0][0]][:1]):
        return left + right
    a, b = _edge(own, left, True), _edge(own, right, False)
    raw_a, raw_b = own.text_bytes(a), own.text_bytes(b)
    raw, split = raw_a + raw_b, len(raw_a)
    of_a, of_b = _own_pieces(own, a, raw_a, 0), _own_pieces(own, b, raw_b, split)
    begins, ends = {x: (y, ids) for (x, y), ids in of_a.items()}, {y: (x, ids) for (x, y), ids in of_b.items()}
    field: list[int] = []
    for x, y in itertools.pairwise(own.pre_tokens(raw)):
        ids = of_a.get((x, y)) or of_b.get((x, y))
        if ids is None:
            _, head = begins.get(x, (x, []))
            until = x + np.cumsum(own.lengths[head])
            head = head[:int(np.searchsorted(until, y, side="right"))]
            low = x + int(own.lengths[head].sum())
            first, tail = ends.get(y, (y, []))
            since = first + np.cumsum(own.lengths[tail]) - own.lengths[tail]
            tail = tail[int(np.searchsorted(since, low)):]
            ids = splice(own, head, raw[low:y - int(own.lengths[tail].sum())], tail)
        field += ids
    return _trim(left, len(a), True) + [np.array(field, dtype=np.int64)] + _trim(right, len(b), False)


def halves(text: str) -> list[str]:
    """The text in 2**k even parts of at most ``LEAF`` code points."""
    size = math.ceil(len(text) / (1 << max(0, math.ceil(math.log2(max(1, len(text)) / LEAF)))))
    return [text[k:k + size] for k in range(0, len(text), max(1, size))]


class Tree:
    """Joins the parts of a text as they come: equal halves as soon as both are there."""

    def __init__(self, own: Codec):
        self.own, self.done, self.open = own, [], []

    def add(self, ids: np.ndarray, fresh: bool) -> None:
        """``fresh``: the part begins a new segment, which nothing is joined to from before."""
        if fresh:
            self.close()
        node, size = [ids], 1
        while self.open and self.open[-1][1] == size:
            before, n = self.open.pop()
            node, size = join(self.own, before, node), size + n
        self.open.append((node, size))

    def close(self) -> None:
        while len(self.open) > 1:
            node, n = self.open.pop()
            before, m = self.open.pop()
            self.open.append((join(self.own, before, node), n + m))
        self.done += [x for node, _ in self.open for x in node]
        self.open = []

    def ids(self) -> np.ndarray:
        self.close()
        return np.concatenate(self.done) if self.done else np.zeros(0, np.int64)


def _listed(ids: list) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int32, count=int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _encode_whole(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in tv.slices(batch, "text"):
                ids = [own.encode(t) if t else [] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _listed(ids)], names=["doc_id", "ids"])
        tv.release()
    return run


def _cut(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in tv.slices(batch, "text"):
                rows = []
                for row, doc_id, text in zip(*(part.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                    leaf = 0
                    for s in own.segments(text):
                        for k, half in enumerate(halves(s)):
                            rows.append((row, doc_id, leaf, k == 0, half))
                            leaf += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()))],
                                                 names=["row", "doc_id", "leaf", "fresh", "text"])
    return run


def _encode_leaves(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in tv.slices(batch, "text"):
                ids = [np.array(own.encode(t), dtype="<u4").tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "doc_id", "leaf", "fresh")), pa.array(ids, pa.binary())],
                                                 names=["row", "doc_id", "leaf", "fresh", "ids"])
        tv.release()
    return run


def _join_leaves(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        at, doc, tree = None, None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), _listed([tree.ids()])], names=["doc_id", "ids"])

        for batch in batches:
            for row, doc_id, fresh, ids in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "fresh", "ids"))):
                if row != at:
                    if tree:
                        yield out()
                    at, doc, tree = row, doc_id, Tree(own)
                tree.add(np.frombuffer(ids, dtype="<u4").astype(np.int64), fresh)
        if tree:
            yield out()
        tv.release()
    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of every document's whole text, as the tokenizers library gives them without special tokens."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    long = F.length("text") > LEAF
    whole = docs.where(~long).mapInArrow(_encode_whole(path), IDS)
    leaves = (docs.where(long).withColumn("row", F.monotonically_increasing_id())
              .mapInArrow(_cut(path), "row long, doc_id long, leaf int, fresh boolean, text string").repartition("row", "leaf")
              .mapInArrow(_encode_leaves(path), "row long, doc_id long, leaf int, fresh boolean, ids binary"))
    joined = leaves.repartition("row").sortWithinPartitions("row", "leaf").mapInArrow(_join_leaves(path), IDS)
    return whole.unionByName(joined)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``text``, the text that the ids stand for; added tokens are written out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids = batch.column("ids")
            ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            texts = [own.text_bytes(flat[a:b].tolist()).decode("utf-8", "replace") for a, b in itertools.pairwise(ends.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])
        tv.release()
    return encoded.select("doc_id", "ids").mapInArrow(run, IDS + ", text string")


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path()
    both = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2(F.col("text"), 256).alias("decoded_sha256"))
