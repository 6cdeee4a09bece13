"""MinHash near-duplicates by tensored banding, with exact confirmation and connected components.

Signature: two collections of ``HALVES`` half keys of ``ROWS`` MinHashes each.  A table key pairs one half key of
either collection, so ``HALVES``**2 tables of 2 * ``ROWS`` rows cost only 2 * ``HALVES`` * ``ROWS`` MinHashes.  Two
documents of likeness s share a table with probability (1 - (1 - s**ROWS)**HALVES)**2: 0.9996 at 0.8, and it falls off
steeply below.

Steps, all on written tables:
1. Equal shingle sets become one class (grouped by a 128-bit digest with map-side combine: copies cost nothing later).
2. Half keys that only one class has are dropped; what is left is paired to table keys.
3. In each table every class is compared with the smallest only (never all pairs): first each class with its
   smallest partner, then pairs that are not yet known to be in one component.
4. Classes whose likeness to a common partner is ``GLUE`` or more form a family.  Each table's classes that are not
   so near to its smallest that a near copy of theirs must be in the family are its rest.  Families, and rests of
   more than one family, are groups: members outside a group's largest component are compared with all its members,
   in blocks of bounded bytes, by an inverted index in each block; no pair rows are made.  So no link between two
   classes that share a table is left out for having been no pivot's.
5. Links confirmed on full sets are joined to components by large-star / small-star rounds.

Words are runs of characters other than ASCII white space, A-Z lower-cased.  Null and empty texts and texts without
words have no shingles and are linked with nothing.  Fewer words than ``width``: the whole sequence is one shingle.
Repeated rows are copies.  Documents without an id take part; a component's id is its smallest id (null if none has
one).  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from raretide.llm import textvec as tv
from raretide.llm.common import broadcast_up_to, table, written

HALVES, ROWS = 16, 4
THRESHOLD, GLUE = 80, 50  # percent
BROADCAST_ROWS, BLOCK_BYTES = 500_000, 2 << 20

_SEEDS = tv.mix(np.arange(1, 4 * HALVES * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def half_keys(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Half keys (texts x 2 * HALVES) of texts that have shingles."""
    out = np.empty((len(counts), 2 * HALVES), dtype=np.uint64)
    starts = np.cumsum(counts) - counts
    for half in range(2 * HALVES):
        key = np.full(len(counts), half + 1, dtype=np.uint64)
        for row in range(ROWS):
            k = 2 * (half * ROWS + row)
            key = tv.mix(key ^ np.minimum.reduceat((shingles ^ _SEEDS[k]) * (_SEEDS[k + 1] | np.uint64(1)), starts))
        out[:, half] = key
    return out


def _shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    return tv.shingle_hashes(*tv.word_hashes(*tv.buffers(texts), tv.SPACE_SEP), width)


def _sets(hashes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return [np.unique(part) for part in np.split(hashes, np.cumsum(counts)[:-1])] if len(counts) else []


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, "text", 1 << 20):
                hashes, counts = _shingles(part.column("text"), width)
                sets = _sets(hashes, counts)
                halves: list = [None] * len(counts)
                has = np.flatnonzero(counts)
                if len(has):
                    for i, keys in zip(has, half_keys(hashes, counts[has]).view(np.int64)):
                        halves[i] = keys
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("tie"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array(halves, pa.list_(pa.int64()))], names=["doc_id", "tie", "n", "cls", "half"])
        tv.release()
    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, "text"):
                sets = _sets(*_shingles(part.column("text"), width))
                yield pa.RecordBatch.from_arrays([part.column("cid"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cid", "s"])
        tv.release()
    return run


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both, either = [], []
        for a, b in zip(batch.column("sx"), batch.column("sp")):  # views, no copies
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            both.append(common)
            either.append(len(a) + len(b) - common)
        yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("p"), pa.array(both, pa.int64()), pa.array(either, pa.int64())],
                                         names=["x", "p", "both", "either"])
    tv.release()


def confirm(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Sizes of intersection and union of each pair (x, p)."""
    return written(pairs.join(sets.select(F.col("cid").alias("x"), F.col("s").alias("sx")), "x")
                   .join(sets.select(F.col("cid").alias("p"), F.col("s").alias("sp")), "p")
                   .select("x", "p", "sx", "sp").mapInArrow(_confirm, "x long, p long, both long, either long"), name)


def _is_open(edges: DataFrame) -> bool:
    """Whether ``a, b`` edges (a > b, each once) are not yet stars around the smallest nodes: a node with two edges down, or one down and one up."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.agg(F.count_if(F.expr("down > 1 OR (down > 0 AND up > 0)"))).first()[0] > 0


def components(edges: DataFrame, name: str) -> DataFrame:
    """``node, label`` (the smallest node of its component) for every node of ``a, b`` edges."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while _is_open(now):  # stars need no round, nor one that finds no change
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        now = written(small.select("a", F.col("m").alias("b")).union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(), name)
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.union(labels.select(F.col("label").alias("node"), "label").distinct())


def _candidates(reps: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs (x, p): classes that share a table key, with that table's smallest class; keys (cid, key) of the classes;
    pivots (key, p, n) of the tables that n > 1 classes share."""
    halves = reps.select("cid", F.posexplode("half").alias("i", "h"))
    shared = halves.groupBy("h").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo < hi").select("h")
    left = halves.join(shared, "h").groupBy("cid").agg(
        F.collect_list(F.when(F.col("i") < HALVES, F.col("h"))).alias("a"), F.collect_list(F.when(F.col("i") >= HALVES, F.col("h"))).alias("b"))
    keys = (left.select("cid", "b", F.explode("a").alias("ha")).select("cid", "ha", F.explode("b").alias("hb"))
            .select("cid", F.xxhash64("ha", "hb").alias("key")))
    keys = written(keys, "table-keys")
    pivots = written(keys.groupBy("key").agg(F.min("cid").alias("p"), F.max("cid").alias("q"), F.count("*").alias("n")).where("p < q").select("key", "p", "n"), "pivots")
    return written(keys.join(pivots, "key").where("cid <> p").select(F.col("cid").alias("x"), "p").distinct(), "pairs"), keys, pivots


def _linked(tested: DataFrame, percent: int) -> DataFrame:
    return tested.where(F.col("both") * 100 >= F.col("either") * percent)


def _block_links(threshold: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        xs, comps = left.column("cid").to_pylist(), left.column("comp").to_pylist()
        sets = [np.frombuffer(s, np.uint64) for s in left.column("s").to_pylist()]
        found: dict[tuple[int, int], None] = {}
        if sets and right.num_rows:
            size = np.array([len(s) for s in sets])
            every = np.concatenate(sets)
            order = np.argsort(every, kind="stable")
            every, owner = every[order], np.repeat(np.arange(len(sets)), size)[order]
            for y, comp, s in zip(right.column("cid").to_pylist(), right.column("comp").to_pylist(), right.column("s").to_pylist()):
                s = np.frombuffer(s, np.uint64)
                lo, hi = np.searchsorted(every, s, "left"), np.searchsorted(every, s, "right")
                n = hi - lo
                at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                both = np.bincount(owner[at], minlength=len(sets))
                for i in np.flatnonzero(both * 100 >= (size + len(s) - both) * threshold):
                    if comps[i] != comp:
                        found[min(comps[i], comp), max(comps[i], comp)] = None
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})
    return run


def _rests(keys: DataFrame, pivots: DataFrame, tested: DataFrame, families: DataFrame, sets: DataFrame, near: int) -> DataFrame:
    """Members (cid, family) of the tables' rests that hold more than one family, equal rests once: each rest by itself,
    or all rests that hang together as one group where that moves fewer bytes.

    A class of likeness ``near`` percent or more to the pivot is no rest: by the triangle inequality of the Jaccard
    distance all its near copies have ``GLUE`` or more to the pivot, so they are in its family."""
    own = families.select(F.col("node").alias("cid"), F.col("family").alias("of"))
    rows = (keys.join(pivots.where("n > 2"), "key").where("cid <> p").join(own, "cid", "left")
            .select("key", "cid", "p", F.coalesce("of", "cid").alias("of")))
    mixed = written(rows.groupBy("key").agg(F.min("of").alias("lo"), F.max("of").alias("hi")).where("lo < hi").select("key"), "mixed-tables")
    done = _linked(tested, near).select(F.col("x").alias("cid"), "p")
    rows = written(rows.join(mixed, "key").join(done, ["cid", "p"], "left_anti").select("key", "cid", "of"), "rests")
    rests = rows.groupBy("key").agg(F.min("of").alias("lo"), F.max("of").alias("hi"), F.count("*").alias("n"),
                                    F.bit_xor(F.xxhash64("cid")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("h2"))
    once = rests.where("lo < hi").groupBy("n", "h1", "h2").agg(F.min("key").alias("key")).select("key")
    rows = written(rows.join(written(once, "open-tables"), "key").join(sets.select("cid", F.length("s").alias("bytes")), "cid"), "open-rests")
    if not rows.limit(1).count():
        return rows.select("cid", F.col("key").alias("family"))
    first = rows.groupBy("key").agg(F.min("cid").alias("b"))
    pools = written(components(rows.join(first, "key").select(F.col("cid").alias("a"), "b"), "pools")
                    .select(F.col("node").alias("cid"), F.col("label").alias("pool")), "rest-pools")
    rows = written(rows.join(pools, "cid"), "pooled-rests")
    moved = rows.groupBy("pool", "cid").agg(F.first("bytes").alias("bytes"), F.sum("bytes").alias("each"))
    whole = written(moved.groupBy("pool").agg(F.sum("bytes").alias("bytes"), F.sum("each").alias("each"))
                    .where(F.ceil(F.col("bytes") / BLOCK_BYTES) * F.col("bytes") <= F.col("each")).select("pool"), "whole-pools")
    return (rows.join(whole, "pool", "left_anti").select("cid", F.col("key").alias("family"))
            .union(pools.join(whole, "pool").select("cid", F.col("pool").alias("family"))))


def _family_links(groups: DataFrame, comps: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Edges between components that share a group (rows cid, family) which only members away from the pivots bear."""
    members = (groups.join(comps.withColumnRenamed("node", "cid"), "cid", "left").select("cid", "family", F.coalesce("label", "cid").alias("comp"))
               .join(sets.select("cid", F.length("s").alias("bytes")), "cid"))
    sizes = written(members.groupBy("family", "comp").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")), "family-sizes")
    plan = sizes.groupBy("family").agg(F.max(F.struct("n", F.negate("comp").alias("neg"), F.col("bytes"))).alias("m"), F.count("*").alias("k"), F.sum("bytes").alias("bytes")).where("k > 1")
    plan = written(plan.select("family", (-F.col("m.neg")).alias("main"), F.ceil(F.col("bytes") / BLOCK_BYTES).cast("long").alias("shards"),
                               F.ceil((F.col("bytes") - F.col("m.bytes")) / BLOCK_BYTES).cast("long").alias("blocks")), "family-plan")
    if not plan.limit(1).count():
        return plan.select(F.col("family").alias("a"), F.col("main").alias("b"))
    open_ = written(members.join(plan, "family").join(sets, "cid").select("family", "cid", "comp", "s", "main", "shards", "blocks"), "family-members")
    spread = F.xxhash64("cid")
    outside = open_.where("comp <> main").select("family", F.pmod(spread, "blocks").alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), "cid", "comp", "s")
    inside = open_.select("family", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.pmod(spread, "shards").alias("shard"), "cid", "comp", "s")
    by = ["family", "block", "shard"]
    return outside.groupBy(*by).cogroup(inside.groupBy(*by)).applyInArrow(_block_links(threshold), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: row, doc_id, tie (text hash), n (distinct shingles), label (component, null without
    shingles) and component_id (smallest doc_id of the component)."""
    tied = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    sig = written(tied.mapInArrow(_signatures(width), "doc_id long, tie long, n long, cls binary, half array<long>")
                  .withColumn("row", F.monotonically_increasing_id()), "signatures")
    reps = written(sig.where("n > 0").groupBy("cls").agg(F.min(F.struct("row", "doc_id", "tie", "half")).alias("m"))
                   .select("cls", F.col("m.row").alias("cid"), F.col("m.doc_id").alias("doc_id"), F.col("m.tie").alias("tie"), F.col("m.half").alias("half")), "classes")
    pairs, keys, pivots = _candidates(reps)
    wanted = pairs.select(F.col("x").alias("cid")).union(pairs.select(F.col("p").alias("cid"))).distinct()
    wanted = broadcast_up_to(written(reps.select("cid", "doc_id", "tie").join(wanted, "cid"), "candidates"), BROADCAST_ROWS)
    found = tied.alias("d").join(wanted.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.tie") == F.col("w.tie")))
    sets = written(found.select("w.cid", "d.text").mapInArrow(_full_sets(width), "cid long, s binary").dropDuplicates(["cid"]), "sets")

    first = confirm(pairs.groupBy("x").agg(F.min("p").alias("p")), sets, "tested-1")
    star = _linked(first, threshold).select(F.col("x").alias("node"), F.col("p").alias("to"))
    hop = star.select(F.col("node").alias("to"), F.col("to").alias("on"))
    star = written(star.join(hop, "to", "left").select("node", F.coalesce("on", "to").alias("to")), "stars")
    rest = pairs.join(first.select("x", "p"), ["x", "p"], "left_anti")
    for c in ("x", "p"):
        rest = rest.join(star.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")), c, "left")
    rest = rest.where(F.coalesce("to_x", "x") != F.coalesce("to_p", "p")).select("x", "p")
    tested = first.unionByName(confirm(rest, sets, "tested-2"))

    least = min(GLUE, threshold)
    links = components(_linked(tested, threshold).select(F.col("x").alias("a"), F.col("p").alias("b")), "links")
    glue = _linked(tested, least).select(F.col("x").alias("a"), F.col("p").alias("b"))
    families = components(glue, "families").withColumnRenamed("label", "family")
    groups = families.select(F.col("node").alias("cid"), "family").union(_rests(keys, pivots, tested, families, sets, 100 + least - threshold))
    more = components(_family_links(groups, links, sets, threshold), "joined").select(F.col("node").alias("label"), F.col("label").alias("last"))
    named = reps.select("cls", "cid").join(links.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("label", F.coalesce("label", "cid")).join(more, "label", "left").select("cls", F.coalesce("last", "label").alias("label"))
    rows = written(sig.select("row", "doc_id", "tie", "n", "cls").join(written(named, "class-labels"), "cls", "left").drop("cls"), "labelled")
    ids = written(rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("m"))
                  .select("label", "component_id", F.col("m.row").alias("first_row")), "components")
    return rows.join(ids, "label", "left").select(
        "row", "doc_id", "tie", "n", "label", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("row") == F.col("first_row"), F.lit(True)).alias("stays"))


def keep_one(docs: DataFrame, width: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each component left (the smallest id); all documents without words stay."""
    found = written(near_duplicates(docs, width, threshold), "near-duplicates")
    by_key = found.groupBy("doc_id", "tie").agg(F.max("stays").alias("stays"), F.count("*").alias("n"), F.max("label").alias("label"))
    odd = broadcast_up_to(written(by_key.where("NOT stays OR (n > 1 AND label IS NOT NULL)").select("doc_id", "tie", "stays"), "not-once"), BROADCAST_ROWS)
    tied = docs.withColumn("__tie", F.xxhash64("text"))

    def same(other):
        return F.col("d.doc_id").eqNullSafe(F.col(f"{other}.doc_id")) & (F.col("d.__tie") == F.col(f"{other}.tie"))

    out = tied.alias("d").join(odd.alias("o"), same("o"), "left_anti")
    repeated = odd.where("stays")  # exactly repeated rows, of which one stays
    if repeated.limit(1).count():
        out = out.unionByName(tied.alias("d").join(repeated.alias("r"), same("r"), "left_semi").dropDuplicates(["doc_id", "__tie"]))
    return out.drop("__tie")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), width=2)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
