"""Benchmark decontamination with a broadcast set of normalised test n-grams, in DataFrame operations only.

Words: A-Z lower-cased runs of characters outside ``GAP``.  A window is ``N`` consecutive words of an item; an item of
fewer words, but not none, is one window.  The scan looks up grams of the windows' middle length: of windows of
L words, every L-G+1-th gram of G words of a document is enough, since every occurrence of a window holds just one
of them.  Grams found in the broadcast set are verified against the whole window.

The set is broadcast in blocks of ``BLOCK`` grams at most, each one scan, so any benchmark size works.  Each
document sends one row and its hits through one shuffle by document, nothing else.

Null texts have no words; repeated rows each keep their own row; empty tables give empty or clean results; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from raretide.llm.common import broadcast_up_to, table, written

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # once A-Z is lower-cased; words are all else
N = 10
BLOCK = 400_000
MAX_BROADCAST = 500_000  # contaminated documents to drop; beyond, the anti join shuffles
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised_words(text: Column) -> Column:
    """Words of a text in order; null and empty texts have none."""
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.array_remove(F.split(low, GAP), ""), F.array().cast("array<string>"))


def _gram(length: int) -> tuple[int, int]:
    """Words of a gram for windows of this length, and the step between the document's grams."""
    size = (length + 1) // 2
    return size, length - size + 1


def windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """Distinct windows: ``w`` words, ``length``, ``items`` that have them."""
    words = benchmark.select("item_id", normalised_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    length = F.least(F.lit(n), F.size("words"))
    each = words.select("item_id", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - length + 1), lambda i: F.slice("words", i, length))).alias("w"))
    return each.groupBy("w").agg(F.array_sort(F.collect_set("item_id")).alias("items")).withColumn("length", F.size("w"))


def _grams(found: DataFrame, length: int) -> DataFrame:
    """Every gram of the windows of one length: hash, place in the window, the window."""
    size, step = _gram(length)
    return (found.where(F.col("length") == length)
            .select("w", "items", F.explode(F.sequence(F.lit(0), F.lit(length - size))).alias("o"))
            .select(F.xxhash64(F.slice("w", F.col("o") + 1, size)).alias("h"), "o", "w", "items"))


def hits(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per document (``start`` -1) and one per occurrence of a window: ``doc_id``, ``tie`` (text hash),
    ``n_words``, ``start`` (word index), ``length``, ``items``."""
    found = written(windows(benchmark, n), "windows")
    lengths = [(r["length"], r["count"]) for r in found.groupBy("length").count().collect()]
    worded = docs.select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tie"), normalised_words(F.col("text")).alias("words"))
    base = worded.select("doc_id", "tie", F.size("words").alias("n_words"), F.lit(-1).alias("start"), F.lit(0).alias("length"),
                         F.lit(None).cast(found.schema["items"].dataType).alias("items"))
    out, first = None, True
    for length, count in sorted(lengths, reverse=True):
        size, step = _gram(length)
        grams = _grams(found, length)
        blocks = -(-count * step // BLOCK)
        for block in range(blocks):
            part = grams if blocks == 1 else grams.where(F.pmod(F.col("h"), F.lit(blocks)) == block)
            places = F.when(F.size("words") >= size, F.sequence(F.lit(0), F.size("words") - size, F.lit(step)))
            # a gram's row carries the words that a window around it can reach, not the document
            side = length - size
            looked = F.transform(places, lambda p: F.struct(
                p.alias("p"), F.xxhash64(F.slice("words", p + 1, size)).alias("g"),
                F.slice("words", F.greatest(p - side, F.lit(0)) + 1, F.lit(size + 2 * side)).alias("near")))
            if first:  # the document's own row goes along, with no gram
                own = F.array(F.struct(F.lit(-1).alias("p"), F.lit(None).cast("long").alias("g"), F.lit(None).cast("array<string>").alias("near")))
                looked = F.concat(own, F.coalesce(looked, F.array().cast("array<struct<p:int,g:bigint,near:array<string>>>")))
            rows = worded.select("doc_id", "tie", F.size("words").alias("n_words"), F.inline(looked))
            joined = rows.join(F.broadcast(part), F.col("g") == F.col("h"), "left" if first else "inner")
            at = F.col("p") - F.col("o")
            inside = F.greatest(at - F.greatest(F.col("p") - side, F.lit(0)), F.lit(0))
            real = (at >= 0) & (F.slice("near", inside + 1, length) == F.col("w"))
            kept = joined.where((F.col("p") == -1) | real if first else real).select(
                "doc_id", "tie", "n_words", F.when(F.col("p") == -1, -1).otherwise(at).alias("start"),
                F.when(F.col("p") == -1, 0).otherwise(length).alias("length"), "items")
            out = kept if out is None else out.unionByName(kept)
            first = False
    return base if out is None else out


def judge(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """Per document: doc_id, tie, n_words, n_hit, items (sorted ids with an occurring window)."""
    found = hits(docs, benchmark, n)
    order = Window.partitionBy("doc_id", "tie").orderBy("start", "length")
    reach = F.max(F.col("start") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("length") - F.greatest(F.col("start"), F.coalesce(reach, F.lit(0))))
    items = F.array_distinct(F.flatten(F.collect_set("items")))
    per_doc = found.withColumn("fresh", F.when(F.col("start") < 0, 0).otherwise(fresh)).groupBy("doc_id", "tie").agg(
        F.max("n_words").cast("long").alias("n_words"), F.sum("fresh").cast("long").alias("n_hit"), items.alias("items"),
        F.sum((F.col("start") < 0).cast("int")).alias("copies"))
    return per_doc.select("doc_id", "tie", "n_words", "n_hit", "items", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def clean(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; clean documents stay as they are."""
    dirty = written(judge(docs, benchmark, n).where(F.col("n_hit") > 0).select("doc_id", "tie").distinct(), "contaminated")
    dirty = broadcast_up_to(dirty, MAX_BROADCAST)
    tied = docs.withColumn("__tie", F.coalesce(F.xxhash64("text"), F.lit(0)))
    return (tied.alias("d").join(dirty.alias("x"), F.col("d.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.col("d.__tie") == F.col("x.tie")), "left_anti")
            .drop("__tie"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return judged.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM b WHERE len(words) > 0)),
ln AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
  FROM (SELECT d.*, ln.n, unnest(range(1, len(words) - ln.n + 2)) AS i FROM d, ln WHERE len(words) >= ln.n)),
hit AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw USING (n, w)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(pos.n_hit, 0)::BIGINT AS n_hit, coalesce(it.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(it.names, '')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
