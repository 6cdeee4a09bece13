"""Features of whole series in one pass over Arrow batches: EMA, lags, rolling windows, deltas and fills.

For tables whose every series fits one task (``scan.by_length``) and whose sensors are doubles.  Spark deals the rows out by series and sorts them
while they are narrow; a task then makes all columns of some complete series at once.  A window's values are added in the order and by the
formulas of Spark's own aggregates, so results are those of ``windows.rolling_features``, ``lag_features``, ``ema_features`` and ``scan.carry_last``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from raretide.functions.timecols import half_open_us
from raretide.operators.windows import EMA_SPANS, LAGS, ROLLING_SPANS, SLOPE_SPAN, _ColdEma, group_starts, rolling_columns

OUT_ROWS = 10_000  # rows of a batch that goes back to Spark

Values = tuple[np.ndarray, np.ndarray]  # doubles, and which of them are not null


def complete_series(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted batches dealt anew, so that no series (``keys``) goes on in the next, each with the marks of the series' first rows."""
    held: list[tuple[pa.RecordBatch, np.ndarray]] = []
    before = None

    def out() -> tuple[pa.RecordBatch, np.ndarray]:
        return pa.concat_batches([b for b, _ in held]), np.concatenate([s for _, s in held])

    for batch in batches:
        if not batch.num_rows:
            continue
        starts = group_starts(batch, keys, before)
        before = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in keys)
        if starts.any():
            cut = int(np.flatnonzero(starts)[-1])
            if cut:
                held.append((batch.slice(0, cut), starts[:cut]))
            if held:
                yield out()
            held, batch, starts = [], batch.slice(cut), starts[cut:]
        held.append((batch, starts))
    if held:
        yield out()


def first_rows(starts: np.ndarray) -> np.ndarray:
    """Of each row, the first row of its series."""
    return np.maximum.accumulate(np.where(starts, np.arange(len(starts)), 0))


def window_bounds(us: np.ndarray, starts: np.ndarray, span: str) -> tuple[np.ndarray, np.ndarray]:
    """First row and end of each row's window (t - span, t], rows of the same instant included."""
    at, begin = np.arange(len(us)), first_rows(starts)
    lo, rows, least = at.copy(), at, us + half_open_us(span)
    while len(rows := rows[(lo[rows] > begin[rows]) & (us[lo[rows] - 1] >= least[rows])]):
        lo[rows] -= 1
    last = np.flatnonzero(np.concatenate([starts[1:] | (us[1:] != us[:-1]), [True]]))
    return lo, last[np.searchsorted(last, at)] + 1


def window_stats(x: Values, lo: np.ndarray, hi: np.ndarray, pos: np.ndarray | None = None) -> dict[str, Values]:
    """mean, std, var, max, min, range and, with ``pos``, slope of the values in each window, taken in their order as Spark's aggregates do."""
    value, has = x
    n, total, mean, m2, top, low, px, p2, ck = np.zeros((9, len(value)))
    rows, k = np.arange(len(value)), 0
    while len(rows := rows[lo[rows] + k < hi[rows]]):
        j = lo[rows] + k
        r, j = rows[has[j]], j[has[j]]
        v, first, m = value[j], n[r] == 0, n[r] + 1.0
        total[r] += v
        d = v - mean[r]
        dn = d / m
        mean[r] += dn
        m2[r] += d * (d - dn)
        top[r], low[r] = np.where(first, v, np.maximum(top[r], v)), np.where(first, v, np.fmin(low[r], v))
        if pos is not None:
            e = pos[j] - px[r]
            en = e / m
            px[r] += en
            p2[r] += e * (e - en)
            ck[r] += e * (v - mean[r])
        n[r], k = m, k + 1
    some, more = n > 0, n >= 2
    var = np.where(more, m2, 0.0) / np.where(more, n - 1.0, 1.0)
    out = {"mean": (total / np.maximum(n, 1.0), some), "var": (var, more), "std": (np.sqrt(var), more),
           "max": (top, some), "min": (low, some), "range": (top - low, some)}
    if pos is not None:
        out["slope"] = ck / np.where(p2 == 0, 1.0, p2), more & (p2 != 0)
    return out


def filled(x: Values, begin: np.ndarray) -> Values:
    """Each null replaced by the last value before it in its series."""
    last = np.maximum.accumulate(np.where(x[1], np.arange(len(begin)), -1))
    return x[0][np.maximum(last, 0)], last >= begin


def lagged(x: Values, k: int, begin: np.ndarray) -> Values:
    at = np.arange(len(begin)) - k
    return x[0][np.maximum(at, 0)], (at >= begin) & x[1][np.maximum(at, 0)]


def less(a: Values, b: Values) -> Values:
    return a[0] - b[0], a[1] & b[1]


def doubles(batch: pa.RecordBatch, name: str) -> Values:
    column = batch.column(name)
    has = column.is_valid().to_numpy(zero_copy_only=False)
    return np.where(has, column.to_numpy(zero_copy_only=False), 0.0), has


def series_features(df: DataFrame, keys: Sequence[str], sensors: Sequence[str], smooth: Sequence[str], steps: Sequence[str], rolled: set[str],
                    deltas: Sequence[str], fill: Sequence[str], zero: Sequence[str], wanted: Sequence[str], needed: Sequence[str]) -> DataFrame:
    """The columns ``wanted``, of ``df`` or made of EMA, lags and windows: ``fill`` columns filled forward, nulls of ``zero`` then 0.  Rows that
    hold a null or NaN in a column of ``needed`` go at last.  No wide row is left to be projected by Spark, whose code for it is too long to be compiled.

    Requires ``_us`` and ``rn``.  EMAs are those of the sensors ``smooth``, lags and rates of change those of ``steps``, rolling columns ``rolled``;
    rows without a time lie in no window and go if there is one, after lags and EMA have counted them."""
    keys, fill, zero = list(keys), set(fill), set(zero)
    spans = [sp for sp in ROLLING_SPANS if sp == SLOPE_SPAN or rolled.intersection(rolling_columns(sensors, [sp]))]
    slopes = {s for s in sensors if f"{s}_rolling_slope_{SLOPE_SPAN}" in rolled}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.DoubleType()), True) for c in wanted])

    def columns_of(batch: pa.RecordBatch, starts: np.ndarray) -> tuple[pa.RecordBatch, dict[str, Values], np.ndarray]:
        begin, out = first_rows(starts), {}
        for s in smooth:
            ema = _ColdEma([2.0 / (sp + 1.0) for sp in EMA_SPANS])
            x, has = doubles(batch, s)
            for sp, (y, _) in zip(EMA_SPANS, ema.batch(np.where(has, x, np.nan), starts)):
                out[f"{s}_ema_{sp}"] = y, ~np.isnan(y)
        for s in steps:
            x = doubles(batch, s)
            out |= {f"{s}_lag_{k}": lagged(x, k, begin) for k in LAGS}
            change, has = less(x, lagged(x, 1, begin))
            out[f"{s}_roc_1"] = np.where(has, change, 0.0), np.ones(len(has), bool)
        if not rolled:
            return batch, out, begin
        timed = batch.column("_us").is_valid().to_numpy(zero_copy_only=False)
        if not timed.all():
            number = np.cumsum(starts)[timed]
            batch, out = batch.filter(pa.array(timed)), {c: (v[timed], has[timed]) for c, (v, has) in out.items()}
            starts = np.concatenate([np.ones(min(1, len(number)), bool), number[1:] != number[:-1]])
            begin = first_rows(starts)
        if batch.num_rows:
            us, pos = batch.column("_us").to_numpy(), batch.column("rn").to_numpy().astype(float)
            for span in spans:
                lo, hi = window_bounds(us, starts, span)
                for s in sensors:
                    names = {"slope": f"{s}_rolling_slope_{span}"} | {c.split("_rolling_")[1].split("_")[0]: c for c in rolling_columns([s], [span])}
                    if rolled.intersection(names.values()):
                        stats = window_stats(doubles(batch, s), lo, hi, pos if span == SLOPE_SPAN and s in slopes else None)
                        out |= {names[k]: v for k, v in stats.items() if names[k] in rolled}
            out |= {f"{s}_delta_mean_1h_6h": less(out[f"{s}_rolling_mean_1h"], out[f"{s}_rolling_mean_6h"]) for s in deltas}
        return batch, out, begin

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in complete_series(batches, keys):
            with np.errstate(all="ignore"):
                batch, out, begin = columns_of(batch, starts)
            if not batch.num_rows:
                continue
            whole = {}
            for name in dict.fromkeys([*wanted, *needed]):
                if name not in out and name not in fill:
                    whole[name] = batch.column(name)
                    continue
                x = out[name] if name in out else doubles(batch, name)
                x = filled(x, begin) if name in fill else x
                whole[name] = pa.array(np.where(x[1], x[0], 0.0)) if name in zero else pa.array(x[0], mask=~x[1])
            made = pa.RecordBatch.from_arrays([whole[c] for c in wanted], names=schema.names)
            complete = np.ones(batch.num_rows, bool)
            for name in needed:
                if whole[name].null_count or pa.types.is_floating(whole[name].type):
                    complete &= whole[name].is_valid().to_numpy(zero_copy_only=False)
                if pa.types.is_floating(whole[name].type):
                    complete &= ~np.isnan(whole[name].to_numpy(zero_copy_only=False))
            made = made if complete.all() else made.filter(pa.array(complete))
            for at in range(0, made.num_rows, OUT_ROWS):
                yield made.slice(at, OUT_ROWS)

    return (df.repartition(*keys) if keys else df.repartition(1)).sortWithinPartitions(*keys, "rn").mapInArrow(per_partition, schema)
