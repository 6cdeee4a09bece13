"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Targets: the budget is shared by weight; a source that would pass ``max_epochs`` times its size is clamped there
and the excess is reshared by weight until none passes (the level of a water-filling: with sources by ascending
cap/weight, the first k are clamped where the level left for the others does not reach the next cap).

Sampling: a document is repeated floor(target/size of its source) times, and once more if it lies before the
point, in the source's seeded hash order, where the sizes sum up to what is left.  The point is found in two
steps: sums per hash bucket, then a running sum inside the one bucket that holds it, so no task sees a source.
The taken words miss a target by half a document at most.

Null and empty texts have size 0 and are listed; null sources are a source of their own, the last; repeated rows
count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from raretide.llm.common import broadcast_up_to, seeded, table, written

GAP = r"[\x20\x09-\x0D]+"  # words are the runs between
SEED, BUCKET_DIGITS = "mix-1", 3  # 16**3 hash buckets per source
MAX_SOURCES_BROADCAST = 100_000
MAX_ODD_BROADCAST = 500_000


def sizes(docs: DataFrame) -> DataFrame:
    """One narrow row per document: doc_id, source, size in words, seeded hash."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"),
                       F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), GAP), "")).cast("long").alias("size"),
                       seeded("doc_id", SEED).alias("key"), F.xxhash64("text").alias("tie"))


def water_fill(source_sizes: DataFrame, weight: Column, share: float, max_epochs: float) -> DataFrame:
    """``source, source_size`` -> adds ``target``.  One row per source; the windows run over that small table.

    ``weight`` may use ``rank``, the source's number from 0 in code point order, null last."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    sized = (source_sizes.withColumn("rank", F.row_number().over(by_name) - 1)
             .withColumn("weight", weight.cast("double"))
             .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = sized.select("*", (F.sum("source_size").over(everything) * F.lit(float(share))).alias("budget"),
                         F.sum("weight").over(everything).alias("all_weight"),
                         F.coalesce(F.sum("cap").over(order), F.lit(0.0)).alias("caps_before"),
                         F.coalesce(F.sum("weight").over(order), F.lit(0.0)).alias("weight_before"))
    level = level.withColumn("level", (F.col("budget") - F.col("caps_before")) / (F.col("all_weight") - F.col("weight_before")))
    free = F.col("level") * F.col("weight") <= F.col("cap")
    chosen = level.withColumn("final", F.min_by("level", F.when(free, F.struct(F.col("cap") / F.col("weight"), F.col("rank")))).over(everything))
    return chosen.select("source", "source_size",
                         F.coalesce(F.least("cap", F.col("final") * F.col("weight")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, weight: Column, share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """Per document: doc_id, source, tie (text hash), size, source_size, target, taken (its words in the mix,
    repeats counted) and repeats."""
    narrow = written(sizes(docs), "mix-sizes")
    bucket = F.substring("key", 1, BUCKET_DIGITS)
    sums = written(narrow.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")), "mix-buckets")
    targets = water_fill(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weight, share, max_epochs)
    targets = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    targets = targets.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    cut = (before.join(targets, before["source"].eqNullSafe(targets["source"]))
           .where((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("words")))
           .select(before["source"].alias("source"), F.col("bucket").alias("cut"), "before"))
    targets = (targets.alias("t").join(cut.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
               .select("t.*", F.coalesce("c.cut", F.lit("")).alias("cut"), F.coalesce("c.before", F.lit(0)).alias("before")))
    targets = broadcast_up_to(written(targets, "mix-targets"), MAX_SOURCES_BROADCAST)
    rows = (narrow.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
            .select("d.*", "t.source_size", "t.target", "t.whole", "t.left", "t.cut", "t.before", bucket.alias("bucket")))
    # Only the bucket that holds the point needs an order; the rest are whole before or after it.
    inside = Window.partitionBy("source").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    edge = rows.where(F.col("bucket") == F.col("cut")).withColumn("extra", (at + F.col("size") / 2.0 <= F.col("left")).cast("int"))
    clear = rows.where(F.col("bucket") != F.col("cut")).withColumn("extra", (F.col("bucket") < F.col("cut")).cast("int"))
    mixed = clear.unionByName(edge).withColumn("repeats", F.col("whole") + F.col("extra"))
    return mixed.select("doc_id", "source", "tie", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"), "repeats")


def repeat(docs: DataFrame, weight: Column, share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """``docs`` with each row as often as the mix takes it.

    Rows that agree in id, source and text are told apart by number only: their repeats are summed and shared."""
    counts = (mix(docs, weight, share, max_epochs).groupBy("doc_id", "source", "tie")
              .agg(F.sum("repeats").alias("__repeats"), F.count("*").alias("__rows")))
    other = F.col("repeats") != 1  # most rows stay as they are, if the share is near 1
    odd = written(counts.withColumn("repeats", F.when(F.col("__rows") == 1, F.col("__repeats")).otherwise(F.lit(-1)))
                  .where(other), "mix-repeats")
    tied = docs.withColumn("__tie", F.xxhash64("text"))
    same = (F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("d.__tie") == F.col("o.tie"))
            & F.col("d.source").cast("string").eqNullSafe(F.col("o.source")))
    joined = tied.alias("d").join(broadcast_up_to(odd, MAX_ODD_BROADCAST).alias("o"), same, "left")
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    plain = joined.where(F.coalesce(F.col("o.repeats"), F.lit(1)) >= 0).select(
        *columns, F.explode(F.array_repeat(F.lit(0), F.coalesce(F.col("o.repeats"), F.lit(1)).cast("int"))).alias("__copy")).drop("__copy")
    if not odd.where("repeats < 0").limit(1).count():
        return plain
    alike = Window.partitionBy("__id", "__source", "__tie").orderBy(F.lit(0))
    again = (joined.where(F.col("o.repeats") < 0)
             .select(*columns, F.col("d.doc_id").alias("__id"), F.col("d.source").alias("__source"), "__tie", "o.__repeats", "o.__rows")
             .withColumn("__r", F.row_number().over(alike) - 1))
    own = F.floor(F.col("__repeats") / F.col("__rows")) + (F.col("__r") < F.col("__repeats") % F.col("__rows")).cast("int")
    return plain.unionByName(again.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), own.cast("int"))).alias("__copy")).drop("__copy"))


def cycle_weight() -> Column:
    return F.element_at(F.array(F.lit(3), F.lit(1), F.lit(2)), (F.col("rank") % 3 + 1).cast("int"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), cycle_weight()).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, [3.0, 1.0, 2.0][(rank % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM r),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                 - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / (sum(weight) OVER ()
                 - coalesce(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM w),
f AS (SELECT max(final) AS final FROM (SELECT level AS final FROM l WHERE level * weight <= cap ORDER BY cap / weight, rank LIMIT 1)),
t AS (SELECT source, source_size, coalesce(least(cap, final * weight), cap) AS target FROM l, f),
o AS (SELECT d.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN before + size / 2.0::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM o
"""
