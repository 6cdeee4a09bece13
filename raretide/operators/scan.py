"""Ordered scans over series without one task per series.

A window ``partitionBy(entity).orderBy(ts)`` puts a whole series into one task; a series without a key
(``Window.orderBy`` alone) puts the whole table into one task, and one hot entity may hold a third of
all rows.  The helpers below split every series into bounded pieces and stitch them back together:

* ``with_row_index``    position of each row in its series: row_number inside (keys, time bucket) plus
                        the row count of all earlier buckets (prefix sum over the small per-bucket table).
* ``row_block_halo``    copies the few rows a lag/lead needs from the neighbouring row block, so that
                        row-offset windows run per (keys, block of C rows).
* ``time_halo``         copies each row into every time bucket its window horizon reaches, so that bounded
                        time windows run per (keys, time bucket).
* ``carry_last`` / ``carry_max``   unbounded scans (forward fill, last failure): local running value
                        per piece, combined with the value carried in from all earlier pieces.

* ``by_length``         series that fit one task are run whole, without pieces and summaries; only longer ones are cut.
* ``in_pieces``         the time buckets of the scans above; a bucket that one key crowds is cut at measured points
                        of its time, then of its tiebreak.
* ``nth_keys``          the row at a position, by narrowing counts; no row is moved.
* ``range_cuts``        even pieces of any distribution, from quantiles.

The per-piece summary tables hold one row per (keys, piece); they are joined back by an ordinary join
that adaptive execution turns into a broadcast only when its measured size is under the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from raretide.functions.timecols import DAY_US
from raretide.session import written

DEFAULT_BUCKET_US = DAY_US
DEFAULT_BLOCK_ROWS = 65_536
CROWDED_ROWS = 1_000_000  # rows of one key in one time bucket beyond which the bucket is cut
MAX_PARTS = 4_096  # parts of one crowded bucket
MAX_CUTS_BROADCAST = 2_000_000  # 8 bytes each

_UNB = Window.unboundedPreceding


def _shared(d: DataFrame) -> DataFrame:
    """Write a windowed pass that feeds both the row side and the per-piece summary to the shared folder.

    Column pruning makes the two consumers' plans differ, so Spark would not reuse the shuffle and would
    recompute the whole upstream lineage once per consumer (doubling at every nested scan).  A written
    table also ends the plan's growth, survives lost executors and leaves nothing cached."""
    return written(d, "scan")


def join_pieces(rows: DataFrame, summary: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join the one-row-per-piece ``summary`` back to its rows; NULL keys are keys like any other."""
    renamed = summary.select(*[F.col(c).alias(f"_on{on.index(c)}") if c in on else F.col(c) for c in summary.columns])
    same = F.lit(True)
    for i, c in enumerate(on):
        same = same & F.col(c).eqNullSafe(F.col(f"_on{i}"))
    return rows.join(renamed, same, how).drop(*[f"_on{i}" for i in range(len(on))])


def _part(keys: Sequence[str], *extra: str) -> Window:
    cols = [*keys, *extra]
    return Window.partitionBy(*cols) if cols else Window.partitionBy()


def _series_window(keys: Sequence[str], order: str) -> Window:
    """Window over the small per-piece summary table, ordered by piece."""
    return (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(order)


def by_length(df: DataFrame, keys: Sequence[str], rows: int, run: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
    """``run(part, whole)`` of the series of at most ``rows`` rows (``whole``) and of the longer ones, as one table.

    Lengths come from one narrow count.  There is at most one longer series per ``rows`` rows, so their keys are few."""
    keys = list(keys)
    size = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    longer, rest = size.agg(F.count_if(F.col("_n") > rows), F.count_if(F.col("_n") <= rows)).first()
    if not longer or not rest:
        return run(df, not longer)
    cut = written(size.where(F.col("_n") > rows).select(*keys, F.lit(True).alias("_long")), "long")
    marked = join_pieces(df, F.broadcast(cut) if longer <= MAX_CUTS_BROADCAST else cut, keys, "left")
    return run(marked.where(F.col("_long").isNull()).drop("_long"), True).unionByName(run(marked.where("_long").drop("_long"), False))


def time_bucket(us: str | Column, bucket_us: int) -> Column:
    c = F.col(us) if isinstance(us, str) else us
    return F.floor(c / F.lit(bucket_us)).cast("long")


def _crowded_cuts(d: DataFrame, groups: Sequence[str], by: str, rows: int, one: str | None) -> tuple[DataFrame, int] | None:
    """Points of ``by`` that cut every group of more than ``rows`` rows into parts of about half as many, and the stride
    of its index (``_coarse``); None if no group is so large.  With ``one`` only groups that hold a single value of it.

    A value that fills several parts is cut off from the values above it, so it is alone in its part."""
    told = [F.count(F.lit(1)).alias("_n")] + ([F.min(one).alias("_low"), F.max(one).alias("_high")] if one else [])
    large = d.groupBy(*groups).agg(*told).where(F.col("_n") > rows)
    large = large.where(F.col("_low").eqNullSafe(F.col("_high"))) if one else large
    top = large.agg(F.max("_n")).first()[0]
    if top is None:
        return None
    parts = min(MAX_PARTS, -(-2 * top // rows))
    stride = math.isqrt(2 * parts) + 1
    large = written(large.select(*groups, "_n"), "crowded")
    share = [i / parts for i in range(1, parts)]
    found = join_pieces(d.select(*groups, by), large, groups).groupBy(*groups, "_n").agg(
        F.coalesce(F.percentile_approx(by, share, max(10_000, 10 * parts)), F.array().cast("array<long>")).alias("_v"))
    step = F.greatest(F.lit(1), F.floor(F.lit(rows * parts) / (2 * F.col("_n")))).cast("int")
    found = found.withColumn("_v", F.filter("_v", lambda x, i: (i + 1) % step == 0))
    above = F.transform(F.filter("_v", lambda x, i: x == F.get("_v", i - 1)), lambda x: x + 1)
    found = found.withColumn("_cuts", F.array_sort(F.array_distinct(F.concat("_v", above))))
    cuts = written(found.select(*groups, "_cuts", F.filter("_cuts", lambda x, i: i % stride == 0).alias("_coarse")), "cuts")
    return cuts, stride


def in_pieces(df: DataFrame, keys: Sequence[str], us: str, bucket_us: int = DEFAULT_BUCKET_US, tiebreak: str | None = None,
              rows: int = CROWDED_ROWS) -> DataFrame:
    """Add ``_bkt``, the piece of its series a row lies in; pieces are ordered as (us, tiebreak) is.

    A piece is a time bucket.  Where one key has more than ``rows`` rows in a bucket, the bucket is cut at measured points of
    ``us`` and, where one instant alone has that many, of ``tiebreak`` (a number; other types and no tiebreak leave the instant
    whole).  Rows of one instant are never parted without a tiebreak.  The usual case costs one narrow count."""
    d = df.withColumn("_bkt", time_bucket(us, bucket_us))
    groups = [*keys, "_bkt"]
    for by, one in ((us, None), (tiebreak, us)):
        if by is None or not isinstance(d.schema[by].dataType, IntegralType):
            break
        measured = _crowded_cuts(d, groups, by, rows, one)
        if measured is None:
            if one is None:
                break  # no bucket is crowded, so no instant is
            continue
        cuts, stride = measured
        if cuts.agg(F.sum(F.size("_cuts"))).first()[0] <= MAX_CUTS_BROADCAST:
            cuts = F.broadcast(cuts)
        d = join_pieces(d, cuts, groups, "left")
        low = F.size(F.filter("_coarse", lambda x: x <= F.col(by)))
        inside = F.size(F.filter(F.slice("_cuts", F.greatest(low - 1, F.lit(0)) * stride + 1, F.lit(stride)), lambda x: x <= F.col(by)))
        part = F.when(low > 0, (low - 1) * stride + inside).otherwise(0)
        d = d.withColumn("_bkt", F.struct(F.col("_bkt").alias("of"), part.alias("part"))).drop("_cuts", "_coarse")
    return d


def with_row_index(df: DataFrame, keys: Sequence[str], us: str = "_us", tiebreak: str | None = None,
                   bucket_us: int = DEFAULT_BUCKET_US, name: str = "rn",
                   total_name: str | None = None, piece_rows: int = CROWDED_ROWS, whole: bool = False) -> DataFrame:
    """Add ``name`` = 1-based position of the row in its series ``keys`` ordered by (us, tiebreak).

    Optionally ``total_name`` = number of rows of the series.  Works for ``keys=[]`` (one global series):
    only the per-bucket count table is ordered globally, and it has one row per time bucket.  The bucket
    sizes come from the same windowed pass as the local row numbers (its first row per bucket), so the
    input is shuffled once and the small summary reuses that exchange.  A bucket that one key crowds is cut
    (``in_pieces``), so no task holds many more than ``piece_rows`` rows of a series with a numeric tiebreak.
    ``whole``: every series fits one task, so positions are counted at once.
    """
    keys = list(keys)
    order = [F.col(us)] + ([F.col(tiebreak)] if tiebreak else [])
    if whole:
        d = df.withColumn(name, F.row_number().over(_part(keys).orderBy(*order)).cast("long"))
        return d.withColumn(total_name, F.count(F.lit(1)).over(_part(keys))) if total_name else d
    w = _part(keys, "_bkt")
    d = (in_pieces(df, keys, us, bucket_us, tiebreak, piece_rows)
           .withColumn("_lrn", F.row_number().over(w.orderBy(*order)))
           .withColumn("_bn", F.count(F.lit(1)).over(w)))
    d = _shared(d)
    counts = d.where(F.col("_lrn") == 1).select(*keys, "_bkt", "_bn")
    sw = _series_window(keys, "_bkt")
    offs = counts.withColumn("_off", F.coalesce(F.sum("_bn").over(sw.rowsBetween(_UNB, -1)), F.lit(0)))
    cols = [*keys, "_bkt", "_off"]
    if total_name:
        offs = offs.withColumn(total_name, F.sum("_bn").over(_part(keys)))
        cols.append(total_name)
    d = join_pieces(d.drop("_bn"), offs.select(*cols), [*keys, "_bkt"])
    return d.withColumn(name, (F.col("_off") + F.col("_lrn")).cast("long")).drop("_off", "_lrn", "_bkt")


def row_block_halo(df: DataFrame, rn: str = "rn", block_rows: int = DEFAULT_BLOCK_ROWS,
                   before: int = 0, after: int = 0) -> DataFrame:
    """Assign row blocks of ``block_rows`` consecutive rows and copy halo rows into neighbours.

    Adds ``_hb`` (block the copy belongs to) and ``_home`` (true for the original).  A row is copied into
    the next block when it is one of the last ``before`` rows of its block (a lag source) and into the
    previous block when it is one of the first ``after`` rows (a lead source).
    """
    if before > block_rows or after > block_rows:
        raise ValueError("halo larger than the block")
    c = F.lit(block_rows)
    blk = F.floor((F.col(rn) - 1) / c).cast("long")
    pos = F.pmod(F.col(rn) - 1, c)
    targets = F.array_compact(F.array(
        blk,
        F.when(pos >= F.lit(block_rows - before), blk + 1) if before > 0 else F.lit(None).cast("long"),
        F.when((pos < F.lit(after)) & (blk > 0), blk - 1) if after > 0 else F.lit(None).cast("long"),
    ))
    return (df.withColumn("_blk", blk)
              .withColumn("_hb", F.explode(targets))
              .withColumn("_home", F.col("_hb") == F.col("_blk"))
              .drop("_blk"))


def time_halo(df: DataFrame, us: str, span_us: int, bucket_us: int = DEFAULT_BUCKET_US) -> DataFrame:
    """Copy every row into each time bucket whose windows (t - span, t] can contain it.

    Adds ``_hb`` and ``_home``; windows then run per (keys, _hb) and only ``_home`` rows are kept.
    With day buckets and a 12 h horizon each row has at most 2 copies (1.5 on average).
    """
    own = time_bucket(us, bucket_us)
    last = F.floor((F.col(us) + F.lit(span_us - 1)) / F.lit(bucket_us)).cast("long")
    return (df.withColumn("_hb", F.explode(F.sequence(own, last)))
              .withColumn("_home", F.col("_hb") == own))


def carry_last(df: DataFrame, keys: Sequence[str], rn: str, cols: Sequence[str],
               block_rows: int = DEFAULT_BLOCK_ROWS, total: str | None = None, whole: bool = False, sorted_by: Sequence[str] = ()) -> DataFrame:
    """Forward fill: replace each column by its last non-null value at or before the row (by ``rn``).

    Local running fill per (keys, row block) plus the last non-null value of all earlier blocks.  With
    ``total`` (rows of the series) the block summaries are the running values at each block's last
    row; without it an extra whole-block frame provides them.  One summary row per block.  ``whole``: every series
    fits one task (``by_length``) and needs neither; ``sorted_by`` are columns that ascend with ``rn``, by which its rows may be sorted already.
    """
    keys, cols = list(keys), list(cols)
    if whole:
        up_to = _part(keys).orderBy(*sorted_by, rn).rowsBetween(_UNB, 0)
        return df.select(*[F.last(c, ignorenulls=True).over(up_to).alias(c) if c in cols else F.col(c) for c in df.columns])
    blk = F.floor((F.col(rn) - 1) / F.lit(block_rows)).cast("long")
    d = df.withColumn("_blk", blk)
    w = _part(keys, "_blk").orderBy(rn)
    wl = w.rowsBetween(_UNB, 0)
    filled = [F.last(c, ignorenulls=True).over(wl).alias(c) for c in cols]
    if total:
        d = d.select(*[c for c in d.columns if c not in cols], *filled)
        last_row = (F.pmod(F.col(rn), F.lit(block_rows)) == 0) | (F.col(rn) == F.col(total))
        d = _shared(d)
        summ = d.where(last_row).select(*keys, "_blk", *[F.col(c).alias(f"_s{i}") for i, c in enumerate(cols)])
    else:
        wall = w.rowsBetween(_UNB, Window.unboundedFollowing)
        d = d.select(*[c for c in d.columns if c not in cols], *filled,
                     *[F.last(c, ignorenulls=True).over(wall).alias(f"_s{i}") for i, c in enumerate(cols)])
        d = _shared(d)
        summ = d.where(F.pmod(F.col(rn) - 1, F.lit(block_rows)) == 0).select(
            *keys, "_blk", *[f"_s{i}" for i in range(len(cols))])
        d = d.drop(*[f"_s{i}" for i in range(len(cols))])
    sw = _series_window(keys, "_blk").rowsBetween(_UNB, -1)
    carry = summ.select(*keys, "_blk", *[F.last(f"_s{i}", ignorenulls=True).over(sw).alias(f"_c{i}")
                                         for i in range(len(cols))])
    d = join_pieces(d, carry, [*keys, "_blk"])
    return d.select(*[F.coalesce(F.col(c), F.col(f"_c{cols.index(c)}")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def carry_max(df: DataFrame, keys: Sequence[str], us: str, value: Column, name: str,
              bucket_us: int = DEFAULT_BUCKET_US, piece_rows: int = CROWDED_ROWS, whole: bool = False) -> DataFrame:
    """Running maximum of ``value`` over all rows with order key <= the row's (peers included).

    Per (keys, time bucket) a RANGE frame gives the local maximum; earlier buckets contribute through the
    bucket maxima (read from the first row of each bucket of the same windowed pass).  Time buckets, and the
    parts of crowded ones, never split rows with equal timestamps.  ``whole``: every series fits one task.
    """
    keys = list(keys)
    if whole:
        return df.withColumn(name, F.max(value).over(_part(keys).orderBy(us).rangeBetween(_UNB, 0)))
    w = _part(keys, "_bkt").orderBy(us)
    d = (in_pieces(df, keys, us, bucket_us, rows=piece_rows).withColumn("_v", value)
           .withColumn("_loc", F.max("_v").over(w.rangeBetween(_UNB, 0)))
           .withColumn("_s", F.max("_v").over(w.rowsBetween(_UNB, Window.unboundedFollowing)))
           .withColumn("_r", F.row_number().over(w)))
    d = _shared(d)
    summ = d.where(F.col("_r") == 1).select(*keys, "_bkt", "_s")
    carry = summ.select(*keys, "_bkt", F.max("_s").over(_series_window(keys, "_bkt").rowsBetween(_UNB, -1)).alias("_c"))
    d = join_pieces(d.drop("_s", "_r"), carry, [*keys, "_bkt"])
    return d.withColumn(name, F.greatest("_loc", "_c")).drop("_bkt", "_v", "_loc", "_c")


def prefix_sums(df: DataFrame, keys: Sequence[str], order: str, bucket: Column, cols: Sequence[str],
                prefix: str = "cum_", inclusive: bool = True) -> DataFrame:
    """Running sums of ``cols`` in ``order`` (unique per row) for each series ``keys``.

    ``bucket`` must be monotone in ``order``.  Local sums per (keys, bucket) plus carried totals of all
    earlier buckets (bucket totals read from the first row of each bucket of the same windowed pass).
    """
    keys, cols = list(keys), list(cols)
    upper = 0 if inclusive else -1
    w = _part(keys, "_bkt").orderBy(order)
    wall = w.rowsBetween(_UNB, Window.unboundedFollowing)
    d = df.withColumn("_bkt", bucket)
    d = d.select("*", *[F.coalesce(F.sum(c).over(w.rowsBetween(_UNB, upper)), F.lit(0)).alias(f"_l{i}")
                        for i, c in enumerate(cols)],
                 *[F.sum(c).over(wall).alias(f"_s{i}") for i, c in enumerate(cols)],
                 F.row_number().over(w).alias("_r"))
    d = _shared(d)
    summ = d.where(F.col("_r") == 1).select(*keys, "_bkt", *[f"_s{i}" for i in range(len(cols))])
    sw = _series_window(keys, "_bkt").rowsBetween(_UNB, -1)
    carry = summ.select(*keys, "_bkt", *[F.coalesce(F.sum(f"_s{i}").over(sw), F.lit(0)).alias(f"_c{i}")
                                         for i in range(len(cols))])
    d = join_pieces(d.drop("_r", *[f"_s{i}" for i in range(len(cols))]), carry, [*keys, "_bkt"])
    d = d.select("*", *[(F.col(f"_l{i}") + F.col(f"_c{i}")).alias(f"{prefix}{c}") for i, c in enumerate(cols)])
    return d.drop("_bkt", *[f"_l{i}" for i in range(len(cols))], *[f"_c{i}" for i in range(len(cols))])


def previous_rows(df: DataFrame, order: str, piece: Column, cols: dict[str, str]) -> DataFrame:
    """Add each column's value in the row before (by ``order``, unique) under a new name: ``lag`` inside a piece, and
    the last row of the piece before for its first row."""
    d = df.withColumn("_bkt", piece)
    w = Window.partitionBy("_bkt").orderBy(order)
    d = d.select("*", *[F.lag(c).over(w).alias(new) for c, new in cols.items()], F.row_number().over(w).alias("_r"))
    last = df.withColumn("_bkt", piece).groupBy("_bkt").agg(*[F.max_by(c, order).alias(f"_s{i}") for i, c in enumerate(cols)])
    carry = last.select("_bkt", *[F.lag(f"_s{i}").over(Window.orderBy("_bkt")).alias(f"_c{i}") for i in range(len(cols))])
    d = join_pieces(d, carry, ["_bkt"])
    first = F.col("_r") == 1
    return d.withColumns({new: F.when(first, F.col(f"_c{i}")).otherwise(F.col(new)) for i, new in enumerate(cols.values())}).drop(
        "_bkt", "_r", *[f"_c{i}" for i in range(len(cols))])


def range_cuts(df: DataFrame, col: str, rows_per_piece: int = DEFAULT_BLOCK_ROWS) -> list:
    """Values that cut ``df`` into ranges of ``col`` of about ``rows_per_piece`` rows, whatever its distribution.

    There are no more cuts than a few times the session's shuffle partitions (they come to the driver and into the plan): beyond
    that the ranges grow, and a range's sort spills."""
    n = df.count()
    pieces = min(-(-n // rows_per_piece), max(1024, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    if pieces < 2:
        return []
    share = [i / pieces for i in range(1, pieces)]
    return sorted(set(df.agg(F.percentile_approx(col, share, max(10_000, 10 * pieces))).first()[0]))


def range_piece(col: str | Column, cuts: list) -> Column:
    """Number of the range a value lies in: 0 below the first cut.  Two short searches, on the JVM."""
    c = F.col(col) if isinstance(col, str) else col
    if not cuts:
        return F.lit(0).cast("long")
    step = math.isqrt(len(cuts)) + 1
    block = F.size(F.filter(F.lit([*cuts[::step]]), lambda x: x <= c))
    inside = F.size(F.filter(F.slice(F.lit([*cuts]), F.greatest(block - 1, F.lit(0)) * step + 1, step), lambda x: x <= c))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * step + inside).cast("long")


def nth_keys(df: DataFrame, order: Sequence[str], positions: Sequence[int], bins: int = 65_536,
             small: int = 1_000) -> list[tuple | None]:
    """The values of the integer columns ``order`` in the rows at 1-based ``positions`` (None beyond the ends).

    Exact and without a sort or a shuffle of rows.  Each pass counts rows in equal parts of the ranges that still
    hold a position (``bins`` parts in all), for all positions at once, then narrows the ranges; one column after
    another, so ties and a table whose rows share one value cost no more.  Ranges of at most ``small`` rows are
    read out.  NULLs come first.  Only counts and such small ranges come to the driver."""
    order = list(order)

    def same(prefix: tuple) -> Column:
        out = F.lit(True)
        for c, v in zip(order, prefix):
            out = out & F.col(c).eqNullSafe(F.lit(v))
        return out

    def tagged(conditions: list[Column]) -> DataFrame:
        tags = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)]))
        return df.select(*order, F.explode(tags).alias("_i"))

    found: dict[int, tuple | None] = {}
    rest = {p: ((), p) for p in positions}  # values of the columns so far, rank among the rows that have them
    for c in order:
        if not rest:
            break
        prefixes = list(dict.fromkeys(prefix for prefix, _ in rest.values()))
        stats = {r["_i"]: r for r in tagged([same(x) for x in prefixes]).groupBy("_i").agg(
            F.min(c).alias("low"), F.max(c).alias("high"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count(F.lit(1)).alias("n")).collect()}
        spans: dict[int, tuple] = {}
        for p, (prefix, at) in rest.items():
            s = stats.get(prefixes.index(prefix))
            if s is None or not 1 <= at <= s["n"]:
                found[p] = None
            elif at <= s["nulls"]:
                spans[p] = (prefix, None, None, at, s["nulls"])
            else:
                spans[p] = (prefix, s["low"], s["high"], at - s["nulls"], s["n"] - s["nulls"])
        while wide := {p: x for p, x in spans.items() if x[1] is not None and x[1] < x[2]}:
            ranges = list(dict.fromkeys(x[:3] for x in wide.values()))
            inside = [same(prefix) & F.col(c).between(low, high) for prefix, low, high in ranges]
            if all(x[4] <= small for x in wide.values()):
                rows: dict[int, list] = {}
                for r in tagged(inside).collect():
                    rows.setdefault(r["_i"], []).append(tuple(r[k] for k in order))
                for p, x in wide.items():
                    found[p] = sorted(rows[ranges.index(x[:3])], key=lambda k: [(v is not None, v or 0) for v in k])[x[3] - 1]
                    del spans[p]
                break
            parts = max(2, bins // len(ranges))
            widths = [max(1, -(-(high - low + 1) // parts)) for _, low, high in ranges]
            at_range = lambda values: F.get(F.lit([int(v) for v in values]).cast("array<bigint>"), F.col("_i"))
            part = F.call_function("div", F.col(c) - at_range([r[1] for r in ranges]), at_range(widths))
            counts: dict[int, list] = {}
            for r in tagged(inside).groupBy("_i", part.alias("b")).count().collect():
                counts.setdefault(r["_i"], []).append((r["b"], r["count"]))
            for p, (prefix, low, high, at, _) in wide.items():
                i = ranges.index((prefix, low, high))
                for b, k in sorted(counts[i]):
                    if at <= k:
                        break
                    at -= k
                spans[p] = (prefix, low + b * widths[i], min(high, low + (b + 1) * widths[i] - 1), at, k)
        rest = {p: ((*x[0], x[1]), x[3]) for p, x in spans.items()}
    found |= {p: prefix for p, (prefix, _) in rest.items()}
    return [found[p] for p in positions]


def at_or_before(order: Sequence[str], key: tuple) -> Column:
    """Whether a row's ``order`` columns are at or before ``key`` (NULLs first)."""
    after, same = F.lit(False), F.lit(True)
    for c, v in zip(order, key):
        col = F.col(c)
        after = after | (same & (col.isNotNull() if v is None else F.coalesce(col > F.lit(v), F.lit(False))))
        same = same & col.eqNullSafe(F.lit(v))
    return ~after
