"""Shared pieces of the operators: reading, scratch tables, held-out folds, guarded broadcasts, ordered pieces."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType

from raretide.session import scratch_path, written  # noqa: F401  (used by the operators)

PIECE_ROWS, MAX_PIECES = 200_000, 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % mod


def seeded(doc_id: Column | str, seed: str) -> Column:
    """A seeded hexadecimal hash of the id; every engine gives the same."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(c.cast("string"), F.lit("null"))).cast("binary"))


def below(key: Column, share: Column | float) -> Column:
    """Whether a seeded hash lies in the lowest ``share`` (0 to 1) of all."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") <= F.lit(2.0 ** 32) * share


def lowest(df: DataFrame, seed: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those whose ids have the lowest seeded hashes (ties: lowest id).

    A share of the hashes that holds twice as many is cut out first, so the task that orders them reads about that
    many, however many partitions the table has."""
    n = df.count()
    some = df if n <= 2 * rows else df.where(below(seeded("doc_id", seed), 2.0 * rows / n))
    return some.orderBy(seeded("doc_id", seed), "doc_id").limit(rows)


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` has at most ``rows`` rows; beyond, Spark shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_key() -> Column:
    """A hash of the text; with doc_id it names a document and its equals."""
    return F.coalesce(F.xxhash64("text"), F.lit(0))


def without(docs: DataFrame, keys: DataFrame, rows: int = 500_000) -> DataFrame:
    """``docs`` but for the documents in ``keys`` (doc_id, tie), which is broadcast up to ``rows`` rows; all columns stay as they are."""
    keys = broadcast_up_to(keys, rows)
    tied = docs.withColumn("__tie", text_key())
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.__tie") == F.col("k.tie"))
    return tied.alias("d").join(keys.alias("k"), same, "left_anti").drop("__tie")


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Let batches to and from Python workers be of a few MB: their buffers stay with the executor, stage after stage."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def piece_count(docs: DataFrame) -> int:
    """Pieces for tables of any size: the session's shuffle partitions, or more so that a piece has about ``PIECE_ROWS`` documents."""
    return max(parallelism(docs.sparkSession), min(MAX_PIECES, -(-docs.count() // PIECE_ROWS)))


def cut_points(docs: DataFrame, pieces: int) -> list[int]:
    """At most ``pieces`` ids, the first of each piece, that cut the non-null ids into even ranges."""
    share = [i / pieces for i in range(1, pieces)] or [0.5]
    low, cuts = docs.agg(F.min("doc_id"), F.percentile_approx("doc_id", share, max(10_000, 20 * pieces))).first()
    if low is None:
        return []
    return sorted({int(low), *(map(int, cuts) if pieces > 1 else ())})


def piece_of(doc_id: Column, firsts: list[int]) -> Column:
    """Number of the piece that holds an id (two short searches over the cut points, on the JVM)."""
    step = math.isqrt(max(1, len(firsts) - 1)) + 1
    coarse, fine = firsts[::step], F.lit([*firsts])
    block = F.size(F.filter(F.lit([*coarse]), lambda c: c <= doc_id)) - 1
    inside = F.size(F.filter(F.slice(fine, block * step + 1, step), lambda c: c <= doc_id))
    return (block * step + inside - 1).cast("int")


def ordered_pieces(docs: DataFrame, ids: DataFrame | None = None, halo: bool = False) -> DataFrame:
    """Deal documents out by id range, one piece a partition, sorted by id inside (ties by text).

    Adds ``piece`` and ``halo``.  With ``halo`` each piece ends with a copy of the first document of the
    next piece (the last piece: of the first).  Documents without an id have no place in the order: they
    are spread by text hash and come first in their piece.  ``ids``, if given, is a cheaper frame of the same
    ids to take the cut points from."""
    ids = docs if ids is None else ids
    firsts = cut_points(ids, piece_count(ids))
    n = max(1, len(firsts))
    doc_id = F.col("doc_id").cast(LongType())
    own = piece_of(doc_id, firsts) if firsts else F.lit(0)
    piece = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")).otherwise(own)
    copies = F.array(F.struct(piece.alias("piece"), F.lit(False).alias("halo")))
    if halo and firsts:
        before = F.pmod(piece - 1, F.lit(n)).cast("int")
        copies = F.when(F.col("doc_id").isin(firsts),
                        F.array_append(copies, F.struct(before.alias("piece"), F.lit(True).alias("halo")))).otherwise(copies)
    dealt = docs.select(*docs.columns, F.inline(copies))
    return dealt.repartitionById(n, F.col("piece")).sortWithinPartitions("piece", "halo", "doc_id", "text")
