"""Time-series window operators with the reference's semantics, run per bounded piece of a series.

Rolling time windows are half-open (t - h, t]; lags, leads and EMA spans count rows.  Every operator
takes ``keys`` (the series key, possibly empty for one global series) and works through the scan
helpers, so no window ever holds a whole series in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from raretide.functions.timecols import half_open_us, hours_between, parse_span_us, ts_micros
from raretide.operators.scan import (DEFAULT_BLOCK_ROWS, DEFAULT_BUCKET_US, by_length, carry_max, join_pieces, row_block_halo,
                                     time_halo, with_row_index)
from raretide.session import written

# Fixed values of the reference's feature set.
ROLLING_SPANS = ["1h", "6h", "12h"]
EMA_SPANS = [12, 24]
LAGS = [1, 2]
SLOPE_SPAN = "6h"
NO_FAILURE_HOURS = 9999.0
LABEL_HORIZON = 24


def with_order(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: str | None = "row_id",
               bucket_us: int = DEFAULT_BUCKET_US, whole: bool = False) -> DataFrame:
    """Add ``_us`` (microseconds of ``ts``), ``rn`` (row position in the series ``keys``) and ``_n`` (rows
    of the series).  ``whole``, here and below: every series fits one task (``by_length``) and is not cut."""
    d = df if "_us" in df.columns else df.withColumn("_us", ts_micros(ts))
    if "rn" not in d.columns:
        tb = tiebreak if tiebreak and tiebreak in d.columns else None
        d = with_row_index(d, keys, "_us", tb, bucket_us, total_name="_n", whole=whole)
    return d


def label_lead(df: DataFrame, keys: Sequence[str] = ("entity_id",), horizon: int = LABEL_HORIZON,
               col: str = "failure", name: str = "failure_24h", ts: str = "ts", tiebreak: str | None = "row_id",
               block_rows: int = DEFAULT_BLOCK_ROWS, bucket_us: int = DEFAULT_BUCKET_US) -> DataFrame:
    """``col`` of the row ``horizon`` rows later in the same series; NULL for the last ``horizon`` rows."""
    keys = list(keys)

    def lead(part: DataFrame, whole: bool) -> DataFrame:
        d = with_order(part, keys, ts, tiebreak, bucket_us, whole)
        if whole:  # in the order of the row index, so the rows are sorted once
            order = ["_us", *([tiebreak] if tiebreak and tiebreak in part.columns else [])]
            return d.withColumn(name, F.lead(col, horizon).over(Window.partitionBy(*keys).orderBy(*order))).drop("_us", "rn", "_n")
        d = row_block_halo(d, "rn", max(block_rows, horizon), after=horizon)
        d = d.withColumn(name, F.lead(col, horizon).over(Window.partitionBy(*keys, "_hb").orderBy("rn")))
        return d.where("_home").drop("_hb", "_home", "_us", "rn", "_n")

    return by_length(df, keys, block_rows, lead)


def drop_unlabelled(df: DataFrame, label: str = "failure_24h") -> DataFrame:
    return df.na.drop(subset=[label])


def rolling_columns(sensors: Sequence[str], spans: Sequence[str] = ROLLING_SPANS) -> list[str]:
    return [f"{s}_rolling_{stat}_{span}" for s in sensors for span in spans
            for stat in ("mean", "std", "var", "max", "min", "range")]


def rolling_features(df: DataFrame, keys: Sequence[str], sensors: Sequence[str],
                     spans: Sequence[str] = ROLLING_SPANS, slope_span: str | None = SLOPE_SPAN,
                     with_last_failure: bool = False, failure: str = "failure",
                     bucket_us: int = DEFAULT_BUCKET_US, only: set[str] | None = None, whole: bool = False) -> DataFrame:
    """Rolling mean/std/var/max/min/range over half-open time windows, and the rolling OLS slope.

    Requires ``_us`` and ``rn``.  min_periods as in the reference: 1 for mean/max/min, 2 for std/var/slope
    (counted on non-null values).  The slope regresses on row position; it is shift-invariant, so the
    series position ``rn`` serves for every window.  Runs per (keys, day bucket) with a time halo.  ``only`` names
    the columns to compute (default: all).
    """
    keys = list(keys)
    wanted = (lambda c: True) if only is None else only.__contains__
    spans = [sp for sp in spans if any(wanted(c) for c in rolling_columns(sensors, [sp]))]
    slope_span = slope_span if slope_span and any(wanted(f"{s}_rolling_slope_{slope_span}") for s in sensors) else None
    if not spans and not slope_span:
        return df
    horizon = max([parse_span_us(s) for s in spans] + ([parse_span_us(slope_span)] if slope_span else []))
    d = df.where(F.col("_us").isNotNull()) if whole else time_halo(df, "_us", horizon, bucket_us)  # rows without a time lie in no window
    base = Window.partitionBy(*keys, *([] if whole else ["_hb"])).orderBy("_us")
    raw, cols = {}, []  # each aggregate of a window once; the columns are made of them

    def told(agg: Column) -> Column:
        raw[name := f"_w{len(raw)}"] = agg
        return F.col(name)

    pos = F.col("rn").cast("double")
    for s in sensors:
        x = F.col(s)
        for span in spans:
            w = base.rangeBetween(half_open_us(span), 0)
            made = [c for c in rolling_columns([s], [span]) if wanted(c)]
            has = lambda *stats: any(f"{s}_rolling_{st}_{span}" in made for st in stats)  # noqa: E731,B023
            stats = {}
            if has("mean"):
                stats["mean"] = told(F.avg(x).over(w))
            if has("std", "var"):
                stats["var"] = F.when(told(F.count(x).over(w)) >= 2, told(F.var_samp(x).over(w)))
                stats["std"] = F.sqrt(stats["var"])
            if has("max", "min", "range"):
                stats["max"], stats["min"] = told(F.max(x).over(w)), told(F.min(x).over(w))
                stats["range"] = stats["max"] - stats["min"]
            cols += [stats[c.split("_rolling_")[1].split("_")[0]].alias(c) for c in made]
        if slope_span and wanted(f"{s}_rolling_slope_{slope_span}"):
            w = base.rangeBetween(half_open_us(slope_span), 0)
            cols.append(F.when(told(F.count(x).over(w)) >= 2, told(F.regr_slope(x, pos).over(w)))
                        .alias(f"{s}_rolling_slope_{slope_span}"))
    out = d.select("*", *[c.alias(name) for name, c in raw.items()])
    out = (out if whole else out.where("_home")).select(*df.columns, *cols)
    if with_last_failure:
        out = hours_since_last_failure(out, keys, failure=failure, bucket_us=bucket_us, whole=whole)
    return out


def hours_since_last_failure(df: DataFrame, keys: Sequence[str], failure: str = "failure",
                             name: str = "hours_since_last_failure", bucket_us: int = DEFAULT_BUCKET_US, whole: bool = False) -> DataFrame:
    """Backward as-of self-join: hours since the latest failure at or before the row (ties included), 9999 if none."""
    d = df if "_us" in df.columns else df.withColumn("_us", ts_micros("ts"))
    d = carry_max(d, keys, "_us", F.when(F.col(failure) == 1, F.col("_us")), "_lf", bucket_us, whole=whole)
    hrs = F.when(F.col("_lf").isNotNull(), hours_between(F.col("_us"), F.col("_lf"))).otherwise(F.lit(NO_FAILURE_HOURS))
    out = d.withColumn(name, hrs).drop("_lf")
    return out if "_us" in df.columns else out.drop("_us")


def affine_scan(c: np.ndarray, b: np.ndarray) -> np.ndarray:
    """y[t] = c[t] * y[t-1] + b[t] for a whole array (c[0] = 0), by doubling ranges; ends once no row depends on an earlier one."""
    c, y, step = c.copy(), b.copy(), 1
    while step < len(y) and c.any():
        y[step:] += c[step:] * y[:-step]
        c[step:] *= c[:-step]
        step *= 2
    return y


class _ColdEma:
    """EMA of one sensor over sorted groups of rows that come in batches, each group from a cold start; a group may go on in the next batch."""

    def __init__(self, alphas: Sequence[float]):
        self.alphas = list(alphas)
        self.y, self.log, self.gap, self.seen = [0.0] * len(self.alphas), [0.0] * len(self.alphas), 0, False

    def batch(self, x: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(EMA, coefficient of the first reading) per alpha; ``starts`` marks the first row of each group."""
        at = np.arange(len(x))
        seen = ~np.isnan(x)
        begin = np.maximum.accumulate(np.where(starts, at, 0))
        last = np.maximum.accumulate(np.where(seen, at, -1))  # latest reading up to the row
        before = np.concatenate([[-1], last[:-1]])
        goes_on = (np.cumsum(starts) == 0) & self.seen  # rows of a group that has readings in earlier batches
        inside = before >= begin
        gap = np.where(inside, at - before, at + 1 + self.gap).astype(float)
        warm = seen & (inside | goes_on)
        known = (last >= begin) | goes_on
        out = []
        for i, alpha in enumerate(self.alphas):
            w = (1.0 - alpha) ** gap
            step = np.where(warm, w / (w + alpha), 1.0)
            c = np.where(seen, np.where(warm, step, 0.0), known.astype(float))
            b = np.where(seen, (1.0 - c) * np.nan_to_num(x), 0.0)
            b[0] += c[0] * self.y[i]
            c[0] = 0.0
            y = affine_scan(c, b)
            logs = np.log(step)
            total = np.cumsum(logs)
            log = total - (total - logs)[begin] + np.where(goes_on, self.log[i], 0.0)
            out.append((np.where(known, y, np.nan), np.where(known, np.exp(log), np.nan)))
            self.y[i], self.log[i] = float(y[-1]), float(log[-1])
        self.gap = int(at[-1] - last[-1]) if last[-1] >= begin[-1] else self.gap + len(x)
        self.seen = bool(known[-1])
        return out


class _BlockCarry:
    """State before each block of a series, from block summaries that come in batches: last EMA and rows without a reading since."""

    def __init__(self, alpha: float):
        self.alpha, self.y, self.gap, self.seen = alpha, 0.0, 0.0, False

    def batch(self, lead, first, coef, end, trail, rows, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(len(rows))
        seen = ~np.isnan(first)
        begin = np.maximum.accumulate(np.where(starts, at, 0))
        last = np.maximum.accumulate(np.where(seen, at, -1))
        before = np.concatenate([[-1], last[:-1]])
        goes_on, inside = (np.cumsum(starts) == 0) & self.seen, before >= begin
        upto = np.cumsum(rows)
        gap = np.where(inside, trail[before] + upto - rows - upto[before], self.gap + upto - rows)
        warm, known = inside | goes_on, (last >= begin) | goes_on
        w = (1.0 - self.alpha) ** (gap + lead + 1)
        c = np.where(seen, np.where(warm, coef * w / (w + self.alpha), 0.0), known.astype(float))
        b = np.where(seen, np.where(warm, end + coef * (self.alpha * first / (w + self.alpha) - first), end), 0.0)
        b[0] += c[0] * self.y
        c[0] = 0.0
        y = affine_scan(c, b)
        earlier = np.where(warm, np.concatenate([[self.y], y[:-1]]), np.nan)
        out = earlier, np.where(warm, gap, 0).astype(np.int64)
        self.y, self.seen = float(y[-1]), bool(known[-1])
        self.gap = float(trail[-1] if seen[-1] else (gap[-1] if warm[-1] else 0) + rows[-1])
        return out


def group_starts(batch: pa.RecordBatch, columns: Sequence[str], before: tuple | None) -> np.ndarray:
    """Whether each row's ``columns`` differ from those of the row before (``before``: the last row of the batch before); nulls are equal."""
    n = batch.num_rows
    starts = np.zeros(n, dtype=bool)
    starts[0] = before is None or before != tuple(batch.column(c)[0].as_py() for c in columns)
    for c in columns:
        a, b = batch.column(c).slice(1), batch.column(c).slice(0, n - 1)
        starts[1:] |= pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False) | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
    return starts


def ema_features(df: DataFrame, keys: Sequence[str], sensors: Sequence[str], spans: Sequence[int] = EMA_SPANS,
                 block_rows: int = DEFAULT_BLOCK_ROWS, whole: bool = False) -> DataFrame:
    """EMA (adjust=False, row-based span, seed = first value, missing values as in pandas).  Requires ``rn``.

    The recursion has no built-in; a scan over Arrow batches runs it per (keys, block of rows) from a cold start.  From its first
    reading on a block is an affine map of the EMA before it, so each row also keeps its coefficient; one summary row
    per block (first reading, its place, closing value, closing coefficient) gives the state before every block, and
    rows add coefficient * (warm first value - cold first value).  Exact for every block size, however far back a
    value lies.  Pieces are hash-distributed and sorted by (keys, block, rn).
    """
    keys, sensors, spans = list(keys), list(sensors), list(spans)
    gcols = [*keys] if whole else [*keys, "_blk"]
    d = df if whole else df.withColumn("_blk", F.floor((F.col("rn") - 1) / F.lit(block_rows)).cast("long"))
    names = {f"{s}_ema_{sp}": 2.0 / (sp + 1.0) for s in sensors for sp in spans}
    new = [*names] if whole else [c for n in names for c in (f"_cold_{n}", f"_coef_{n}")]  # from its first row on a series is cold
    schema = T.StructType([*d.schema.fields, *[T.StructField(c, T.DoubleType(), True) for c in new]])

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows arrive sorted by (keys, block, rn)
        states = {s: _ColdEma([2.0 / (sp + 1.0) for sp in spans]) for s in sensors}
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = group_starts(batch, gcols, before)
            before = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in gcols)
            add = []
            for s in sensors:
                x = batch.column(s).cast(pa.float64()).to_numpy(zero_copy_only=False)
                add += [pa.array(v, from_pandas=True) for pair in states[s].batch(x, starts) for v in (pair[:1] if whole else pair)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *add], names=schema.names)

    d = (d.repartition(*gcols) if gcols else d.repartition(1)).sortWithinPartitions(*gcols, "rn").mapInArrow(per_partition, schema)
    if whole:
        return d
    d = written(d, "ema")
    parts = [F.count(F.lit(1)).alias("_rows")]
    start, stop = F.min("rn"), F.max("rn")
    for n in names:
        x = F.col(n.split("_ema_")[0])
        at = F.when(x.isNotNull(), F.col("rn"))
        parts += [F.coalesce(F.min(at) - start, F.count(F.lit(1))).cast("double").alias(f"_lead_{n}"),
                  F.min_by(x.cast("double"), at).alias(f"_first_{n}"), F.max_by(f"_coef_{n}", "rn").alias(f"_coef_{n}"),
                  F.max_by(f"_cold_{n}", "rn").alias(f"_end_{n}"), F.coalesce(stop - F.max(at), F.lit(0)).cast("double").alias(f"_trail_{n}")]
    summary = d.groupBy(*gcols).agg(*parts)
    told = ("_lead_", "_first_", "_coef_", "_end_", "_trail_")
    carry_schema = T.StructType([*[d.schema[c] for c in gcols],
                                 *[f for n in names for f in (T.StructField(f"_y_{n}", T.DoubleType()), T.StructField(f"_g_{n}", T.LongType()))]])

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # summaries arrive sorted by (keys, block)
        states, before = {n: _BlockCarry(alpha) for n, alpha in names.items()}, None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = group_starts(batch, keys, before)
            before = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in keys)
            number = lambda c: batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False)  # noqa: E731,B023
            add = []
            for n, state in states.items():
                y, gap = state.batch(*[np.where(np.isnan(v), 0.0, v) if c != "_first_" else v for c, v in ((c, number(c + n)) for c in told)], number("_rows"), starts)
                add += [pa.array(y, from_pandas=True), pa.array(gap)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in gcols), *add], names=carry_schema.names)

    spread = summary.repartition(*keys) if keys else summary.coalesce(1)  # one row a block
    carry = spread.sortWithinPartitions(*gcols).mapInArrow(carried, carry_schema)
    firsts = summary.select(*gcols, *[c for n in names for c in (f"_lead_{n}", f"_first_{n}")])
    d = join_pieces(join_pieces(d, carry, gcols), firsts, gcols)
    out = []
    for n, alpha in names.items():
        y, cold, first = F.col(f"_y_{n}"), F.col(f"_cold_{n}"), F.col(f"_first_{n}")
        w = F.pow(F.lit(1.0 - alpha), F.col(f"_g_{n}") + F.col(f"_lead_{n}") + 1)
        warm = cold + F.col(f"_coef_{n}") * ((w * y + F.lit(alpha) * first) / (w + F.lit(alpha)) - first)
        out.append(F.when(y.isNull(), cold).when(cold.isNull(), y).otherwise(warm).alias(n))
    return d.select(*df.columns, *out)


def ema_lag_features(df: DataFrame, keys: Sequence[str], sensors: Sequence[str],
                     spans: Sequence[int] = EMA_SPANS, lags: Sequence[int] = LAGS,
                     block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """EMA, lags and 1-row rate of change: ``ema_features`` and ``lag_features``.  Requires ``rn``."""
    d = lag_features(df, keys, sensors, lags, block_rows)
    return ema_features(d, keys, sensors, spans, block_rows) if spans else d


def lag_features(df: DataFrame, keys: Sequence[str], sensors: Sequence[str], lags: Sequence[int] = LAGS,
                 block_rows: int = DEFAULT_BLOCK_ROWS, whole: bool = False) -> DataFrame:
    """Lags and 1-row rate of change with built-in windows only: row blocks with a halo of max(lags)
    rows from the previous block, ``lag`` per (keys, block).  Requires ``rn``; ``whole`` also ``_us``, so that rolling windows
    and fills that follow find the rows in their order."""
    keys = list(keys)
    d = df if whole else row_block_halo(df, "rn", max(block_rows, max(lags)), before=max(lags))
    w = Window.partitionBy(*keys).orderBy("_us", "rn") if whole else Window.partitionBy(*keys, "_hb").orderBy("rn")
    cols = {}
    for s in sensors:
        for k in lags:
            cols[f"{s}_lag_{k}"] = F.lag(F.col(s).cast("double"), k).over(w)
        cols[f"{s}_roc_1"] = F.col(s) - F.lag(F.col(s).cast("double"), 1).over(w)
    d = d.withColumns(cols)
    return d if whole else d.where("_home").drop("_hb", "_home")
