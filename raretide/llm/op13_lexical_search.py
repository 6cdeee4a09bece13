"""Ranked lexical search over an inverted index of all documents: Block-Max MaxScore in every shard, then a merge of the shards' best.

Index (one written table): tasks cut their documents into shards of about ``SHARD_WORDS`` words.  A shard has one row with its documents' ids
and lengths (term null) and one row per term: document frequency, the highest impact of a posting, and blocks of ``BLOCK`` postings.
A block's head tells its first document, its highest impact and where its bytes lie; the bytes are gaps and term frequencies in as few bytes as
the block needs.  Terms are 64-bit hashes of their lower-cased bytes.

Search: the lists of the items' terms go to their shards' tasks.  For each item a task knows the score that its best ``k`` so far ask for.
Lists whose bounds together stay below that score are non-essential: they name no candidates.  The candidates of the others (essential,
decoded whole) are looked up in the non-essential lists, highest bound first; a candidate goes as soon as its score, the maximum of the
block it would be in and the bounds of the lists to come stay below the score asked for, and only blocks with a
candidate left are decoded.  A task sends its best ``k`` per item; a window with a group limit merges them.

Item terms go to the tasks in blocks of at most ``QUERY_ROWS`` (item, term) pairs, one search each.  Every row of the items is an item of its own;
null texts have no terms, and documents without a term are not counted.  Documents without an id come last among equals; repeated
documents and ids are ranked each.  Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from raretide.llm import textvec as tv
from raretide.llm.common import table, written

SHARD_WORDS, SHARD_DOCS, BLOCK, QUERY_ROWS, TOP = 1 << 20, 50_000, 64, 200_000, 10
LIST = "shard long, term long, df int, top int, heads binary, payload binary"
HEAD = np.dtype([("first", "<u2"), ("at", "<u4"), ("top", "<u4"), ("gap_bytes", "u1"), ("tf_bytes", "u1")])

# The characters between terms, all of ASCII but digits and letters.
SEPARATORS = np.zeros(256, dtype=bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    SEPARATORS[_low:_high + 1] = True


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norms(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of each document, from its number of terms."""
    if len(n) and 90 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([10 + 90 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
    return 10 + 90 * n * n_docs // n_terms


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


# ---------------------------------------------------------------- index

def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = terms = 0
        for part in tv.slices(batch, "text"):
            data, offs = tv.buffers(part.column("text"))
            begins = ~SEPARATORS[data]
            edge = np.zeros(len(data) + 1, dtype=bool)
            edge[offs] = True
            begins[1:] &= ~begins[:-1] | edge[1:-1] if len(data) else False
            n = np.diff(np.concatenate([[0], np.cumsum(begins)])[offs])
            docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
        yield pa.RecordBatch.from_pydict({"docs": pa.array([docs], pa.int64()), "terms": pa.array([terms], pa.int64())})
    tv.release()


def _binaries(data: bytes, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data)])


def shard_rows(shard: int, ids: pa.Array, hashes: np.ndarray, counts: np.ndarray, n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
    """The rows of one shard from its documents' term hashes in order and their numbers (all above 0)."""
    names = [f.split()[0] for f in LIST.split(", ")]
    known = pa.array([b"".join([np.array(ids.fill_null(0), dtype="<i8").tobytes(), np.array(ids.is_null(), dtype="u1").tobytes()])], pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([None], pa.int64()), pa.array([len(counts)], pa.int32()), pa.array([0], pa.int32()),
                                      known, pa.array([counts.astype("<i8").tobytes()], pa.binary())], names=names)
    order = np.argsort(hashes, kind="stable")
    term, doc = hashes[order], np.repeat(np.arange(len(counts)), counts)[order]
    new = np.ones(len(term) + 1, dtype=bool)
    new[1:-1] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    tf, term, doc = np.diff(at), term[at[:-1]], doc[at[:-1]]  # one posting each
    impact = impacts(tf, norms(counts, n_docs, n_terms)[doc])
    begins = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    df = np.diff(np.append(begins, len(term)))
    place = np.arange(len(term)) - np.repeat(begins, df)
    head_at = np.flatnonzero(place % BLOCK == 0)
    size = np.diff(np.append(head_at, len(term)))
    block = np.repeat(np.arange(len(head_at)), size)
    gap = np.diff(doc, prepend=0)
    gap[head_at] = 0
    heads = np.zeros(len(head_at), dtype=HEAD)
    heads["first"], heads["top"] = doc[head_at], np.maximum.reduceat(impact, head_at)
    heads["gap_bytes"] = np.where(np.maximum.reduceat(gap, head_at) < 256, 1, 2)
    most = np.maximum.reduceat(tf, head_at)
    heads["tf_bytes"] = np.select([most < 256, most < 65536], [1, 2], 4)
    gap_bytes, tf_bytes = heads["gap_bytes"].astype(np.int64), heads["tf_bytes"].astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size * (gap_bytes + tf_bytes))])
    payload = np.zeros(int(offsets[-1]), dtype=np.uint8)
    inside = place % BLOCK
    for value, width, start in ((gap, gap_bytes, offsets[:-1]), (tf, tf_bytes, offsets[:-1] + size * gap_bytes)):
        to = start[block] + inside * width[block]
        for k in range(int(width.max())):
            has = width[block] > k
            payload[to[has] + k] = (value[has] >> (8 * k)) & 255
    first_block = np.append(block[begins], len(head_at))
    heads["at"] = offsets[:-1] - np.repeat(offsets[first_block[:-1]], np.diff(first_block))
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(len(begins), shard)), pa.array(term[begins].view(np.int64)), pa.array(df.astype(np.int32)),
        pa.array(np.maximum.reduceat(impact, begins).astype(np.int32)), _binaries(heads.tobytes(), first_block * HEAD.itemsize),
        _binaries(payload.tobytes(), offsets[first_block])], names=names)


def _build(n_docs: int, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        words = docs = 0

        def out() -> Iterator[pa.RecordBatch]:
            yield from shard_rows(shard, pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held]),
                                  np.concatenate([h[2] for h in held]), n_docs, n_terms)

        for batch in batches:
            for part in tv.slices(batch, "text"):
                hashes, counts = tv.word_hashes(*tv.buffers(part.column("text")), SEPARATORS)
                some = counts > 0
                if not some.any():
                    continue
                held.append((part.column("doc_id").filter(pa.array(some)), hashes, counts[some]))
                words, docs = words + len(hashes), docs + int(some.sum())
                if words >= SHARD_WORDS or docs >= SHARD_DOCS:
                    yield from out()
                    shard, held, words, docs = shard + 1, [], 0, 0
        if held:
            yield from out()
        tv.release()
    return run


@dataclass
class Index:
    lists: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame) -> Index:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_docs, n_terms = docs.select("text").mapInArrow(_sizes, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0
    return Index(written(docs.mapInArrow(_build(n_docs, n_terms), LIST), "lexical-index"), n_docs, n_terms)


# ---------------------------------------------------------------- search

class Postings:
    """One term's list in one shard."""

    def __init__(self, df: int, top: int, heads: bytes, payload: bytes, m: np.ndarray):
        self.df, self.top, self.payload, self.m = df, top, payload, m
        self.heads = np.frombuffer(heads, dtype=HEAD)
        self.firsts, self.tops = self.heads["first"].astype(np.int64), self.heads["top"].astype(np.int64)
        self.all = None
        self.decoded = 0

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block."""
        _, at, _, gap_bytes, tf_bytes = self.heads[b].tolist()
        n = min(BLOCK, self.df - b * BLOCK)
        gap = np.frombuffer(self.payload, f"<u{gap_bytes}", n, at)
        tf = np.frombuffer(self.payload, f"<u{tf_bytes}", n, at + n * gap_bytes).astype(np.int64)
        doc = np.cumsum(gap, dtype=np.int64) + self.firsts[b]
        self.decoded += 1
        return doc, impacts(tf, self.m[doc])

    def blocks(self, which) -> tuple[np.ndarray, np.ndarray]:
        got = [self.block(b) for b in which]
        return np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if self.all is None:
            self.all = self.blocks(range(len(self.heads)))
        return self.all


def best_of_shard(lists: list[tuple[int, Postings]], size: int, asked: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores of all that score ``asked`` (at least 1) or more, for (weight, postings) of an item's terms."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].top)
    bounds = np.cumsum([w * p.top for w, p in lists])
    aside = int(np.searchsorted(bounds, asked))  # these lists together stay below it
    if aside == len(lists):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = np.zeros(size, dtype=np.int64)
    for w, p in lists[aside:]:
        doc, impact = p.whole()
        total[doc] += w * impact
    rest = int(bounds[aside - 1]) if aside else 0
    docs = np.flatnonzero(total >= max(1, asked - rest))
    scores = total[docs]
    for k in range(aside - 1, -1, -1):
        w, p = lists[k]
        rest = int(bounds[k - 1]) if k else 0
        block = np.searchsorted(p.firsts, docs, side="right") - 1
        live = scores + np.where(block >= 0, w * p.tops[block], 0) + rest >= asked
        docs, scores, block = docs[live], scores[live], block[live]
        wanted = np.unique(block[block >= 0])
        if len(wanted):
            doc, impact = p.whole() if p.all is not None else p.blocks(wanted.tolist())
            at = np.minimum(np.searchsorted(doc, docs), len(doc) - 1)
            scores = scores + np.where(doc[at] == docs, w * impact[at], 0)
        live = scores + rest >= asked
        docs, scores = docs[live], scores[live]
    return docs, scores


class Best:
    """The best ``k`` of an item so far: highest score, then lowest id, without an id last."""

    def __init__(self, k: int):
        self.k, self.rows = k, np.zeros((0, 3), dtype=np.int64)

    @property
    def asked(self) -> int:
        return int(self.rows[-1, 0]) if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([scores, nulls, ids], axis=1)])
        self.rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))][:self.k]


def _search(items, n_docs: int, n_terms: int, k: int):
    """``items``: broadcast {row: (item_id, {term: weight})}."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {q: Best(k) for q in items.value}
        shard, lists, ids, nulls, m = None, {}, None, None, None

        def close() -> None:
            for q, (_, weights) in items.value.items():
                found = [(w, lists[t]) for t, w in weights.items() if t in lists]
                if found:
                    docs, scores = best_of_shard(found, len(ids), best[q].asked)
                    if len(docs):
                        best[q].add(scores, nulls[docs], ids[docs])

        for batch in batches:
            for s, term, df, top, heads, payload in zip(*(batch.column(c).to_pylist() for c in ("shard", "term", "df", "top", "heads", "payload"))):
                if term is None:  # sorts first in its shard
                    if shard is not None:
                        close()
                    shard, lists = s, {}
                    ids, nulls = np.frombuffer(heads, "<i8", df), np.frombuffer(heads, "u1", df, 8 * df).astype(np.int64)
                    m = norms(np.frombuffer(payload, "<i8"), n_docs, n_terms)
                else:
                    lists[term] = Postings(df, top, heads, payload, m)
        if shard is not None:
            close()
        rows = [(q, items.value[q][0], None if null else i, score) for q, b in best.items() for score, null, i in b.rows.tolist()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["q", "item_id", "doc_id", "score"])
        tv.release()
    return run


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, counts = tv.word_hashes(*tv.buffers(batch.column("text")), SEPARATORS)
        row = np.repeat(np.arange(len(counts)), counts)
        pairs = np.unique(np.stack([row, hashes.view(np.int64)], axis=1), axis=0) if len(row) else np.zeros((0, 2), np.int64)
        take = pa.array(pairs[:, 0])
        yield pa.RecordBatch.from_arrays([batch.column("q").take(take), batch.column("item_id").take(take), pa.array(pairs[:, 1])], names=["q", "item_id", "term"])


def search(index: Index, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` highest-scoring documents of every row of ``items`` (item_id, text)."""
    spark = items.sparkSession
    asked = items.select(F.monotonically_increasing_id().alias("q"), F.col("item_id").cast("long").alias("item_id"), "text")
    pairs = written(asked.mapInArrow(_terms, "q long, item_id long, term long"), "item-terms")
    blocks = max(1, math.ceil(pairs.count() / QUERY_ROWS))
    found = None
    for b in range(blocks):
        told = pairs.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).collect()  # about QUERY_ROWS rows
        own = F.broadcast(spark.createDataFrame([(t,) for t in {r["term"] for r in told}], "term long"))
        df = {r["term"]: r["df"] for r in index.lists.select("term", "df").join(own, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weights: dict[int, tuple] = {}
        for q, item_id, term in told:
            if term in df and (w := weight(index.n_docs, df[term])):
                weights.setdefault(q, (item_id, {}))[1][term] = w
        lists = index.lists.join(own, "term", "left_semi").select(*index.lists.columns).unionByName(index.lists.where("term IS NULL"))
        part = (lists.repartition("shard").sortWithinPartitions("shard", "term")
                .mapInArrow(_search(spark.sparkContext.broadcast(weights), index.n_docs, index.n_terms, k), "q long, item_id long, doc_id long, score long"))
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


# Terms, statistics and scores written out for every pair of an item and a document that share a term.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts FROM benchmark),
it AS (SELECT q, item_id, unnest(ts) AS term FROM b),
st AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
post AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(ts)::BIGINT AS n, unnest(ts) AS term FROM d)
         WHERE term IN (SELECT term FROM it) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM post, st GROUP BY term),
s AS (SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM it JOIN post USING (term) JOIN w USING (term), st GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""
