"""The feature table on a stream: all columns of ``build_features`` per entity (``applyInPandasWithState``).

Order.  Readings may arrive out of order.  Each waits in the state until the watermark (newest event time seen, less ``delay``)
has passed it; then it is released together with all others of its time, in (time, row_id) order.  Late-row rule: a reading that arrives
at or behind the watermark is dropped, as Spark does for every stateful operator, and counted in the query's progress.  So the output equals the
batch operators on all readings but the late ones, whatever the files look like.  A reading without sensor values (a
heartbeat) completes no row but moves the watermark; one without a time has no place in the order and is left out.

State.  Entities are dealt into ``buckets`` groups by a hash of their key, and a group has one state and one call of the function per batch, as a
call costs far more than the few rows that an entity has in it.  Per entity: the readings of the last 12 hours, the waiting readings, EMA values and
rows since the last value per sensor, the last two values, the last failure time, and the last value of every forward-filled column, all as
arrays over the entities of the group.  A release works on the rows of all its entities at once: windows of a few rows are laid side by side, longer ones
are differences of sums since their series' start in extended precision and extremes from a table of doubling ranges; nothing is rebuilt per row,
and no value of one entity enters another's.  A batch reads and writes the state of every group that it touches: few groups suit large batches, many
suit small ones.  The number is part of a query's checkpoint.
An event-time timeout releases what waits when no further reading comes, and removes an entity that was silent for
``idle``; a reading after a longer gap than that starts a new series, whether the state was removed yet or not.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.state import GroupStateTimeout

from raretide.functions.scalar import RATIO_EPSILON, interactions_of
from raretide.functions.timecols import HOUR_US, parse_span_us, ts_micros
from raretide.operators.features import SENSORS, feature_names, is_filled_then_zero
from raretide.operators.series import first_rows
from raretide.operators.windows import EMA_SPANS, NO_FAILURE_HOURS, ROLLING_SPANS, SLOPE_SPAN

DELAY, IDLE, BUCKETS = "1 hour", "30 days", 256
SPANS = list(dict.fromkeys([*ROLLING_SPANS, SLOPE_SPAN]))
HORIZON_US = max(map(parse_span_us, SPANS))
DIRECT = 64  # rows of a window up to which its values are laid side by side
PIECE = 20_000  # readings released at once
NEVER = np.iinfo(np.int64).min  # time of a failure that has not been
# Arrays of the state: one row an entity of the group, one a reading of the last 12 hours, one a waiting reading; in bytes.
SERIES, PAST, WAIT = ("n", "last_us", "last_failure", "gap", "ema", "lags", "fill"), ("past_of", "past_us", "past_x"), ("wait_of", "wait_us", "wait_row", "wait_failure", "wait_x")
_DOUBLE = {"ema", "lags", "fill", "past_x", "wait_x"}
STATE_SCHEMA = T.StructType([T.StructField(n, T.BinaryType()) for n in ("keys", *SERIES, *PAST, *WAIT)])


def output_schema(sensors: Sequence[str] = SENSORS, key: str = "entity_id", key_type: T.DataType | None = None) -> T.StructType:
    fields = [T.StructField(key, key_type or T.LongType()), T.StructField("row_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
              T.StructField("failure", T.IntegerType())]
    return T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in feature_names(sensors)])


def sums_since(x: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Of each row, the sum of ``x`` (by column) from ``begin``, the first row of its series, on: doubling ranges, so that no series' values or
    rounding reach another's."""
    x, at, step = x.copy(), np.arange(len(x)), 1
    longest = int((at - begin).max(initial=0))
    while step <= longest:
        rows = at[step:][at[step:] - step >= begin[step:]]
        x[rows] += x[rows - step]
        step *= 2
    return x


def range_max(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Maximum of x[lo:hi] of each pair (hi > lo) from maxima of doubling ranges."""
    levels = [x]
    while 2 * (step := 1 << (len(levels) - 1)) <= int((hi - lo).max(initial=1)):
        levels.append(np.maximum(levels[-1][:-step], levels[-1][step:]))
    k = np.frexp((hi - lo).astype(float))[1] - 1
    out = np.empty((len(lo), x.shape[1]))
    for level in np.unique(k):
        at = k == level
        out[at] = np.maximum(levels[level][lo[at]], levels[level][hi[at] - (1 << level)])
    return out


def side_by_side(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, slope: bool) -> dict[str, np.ndarray]:
    """Statistics of x[lo:hi], by column, of each pair: for windows of a few rows."""
    out = {c: np.full((len(lo), x.shape[1]), np.nan) for c in ("mean", "var", "max", "min", *(["slope"] if slope else []))}
    rows, width = hi - lo, 1
    while width < 2 * rows.max(initial=0):
        at = np.flatnonzero((rows > width // 2) & (rows <= width))
        if len(at):
            j = lo[at][:, None] + np.arange(width)
            inside = j < hi[at][:, None]
            v = np.where(inside[:, :, None], x[np.where(inside, j, 0)], np.nan)
            has = ~np.isnan(v)
            n = has.sum(1)
            mean = np.where(has, v, 0.0).sum(1) / n
            out["mean"][at] = mean
            out["max"][at], out["min"][at] = np.where(n, np.where(has, v, -np.inf).max(1), np.nan), np.where(n, np.where(has, v, np.inf).min(1), np.nan)
            if width > 1:
                d = np.where(has, v - mean[:, None], 0.0)
                out["var"][at] = np.where(n >= 2, (d * d).sum(1) / (n - 1), np.nan)
                if slope:
                    pos = np.arange(width, dtype=float)[None, :, None] * has
                    e = (pos - pos.sum(1, keepdims=True) / n[:, None]) * has
                    out["slope"][at] = np.where(n >= 2, (e * d).sum(1) / (e * e).sum(1), np.nan)
        width *= 2
    return out


class _Sums:
    """Statistics of windows of any length: sums of a series since its start about its mean, and extremes of doubling ranges."""

    def __init__(self, x: np.ndarray, starts: np.ndarray):
        self.begin = first_rows(starts)
        seen = ~np.isnan(x)
        own = np.flatnonzero(starts)
        count = np.maximum(np.add.reduceat(seen.astype(np.int64), own), 1)
        self.shift = (np.add.reduceat(np.where(seen, x, 0.0), own) / count)[np.cumsum(starts) - 1]
        d = np.where(seen, x - self.shift, 0.0).astype(np.longdouble)
        pos = (np.arange(len(x)) - self.begin).astype(np.longdouble)[:, None] * seen
        self.k = x.shape[1]
        self.sums = sums_since(np.hstack([seen.astype(np.longdouble), d, d * d, pos, pos * pos, pos * d]), self.begin)
        self.ends = np.where(np.hstack([seen, seen]), np.hstack([x, -x]), -np.inf)

    def stats(self, lo: np.ndarray, hi: np.ndarray, slope: bool) -> dict[str, np.ndarray]:
        total = self.sums[hi - 1] - np.where((lo > self.begin[hi - 1])[:, None], self.sums[np.maximum(lo - 1, 0)], 0)
        n, t1, t2, q1, q2, qs = np.split(total, 6, axis=1)
        n = np.rint(n)
        top, bottom = np.hsplit(range_max(self.ends, lo, hi), 2)
        out = {"mean": np.where(n >= 1, t1 / n + self.shift[hi - 1], np.nan).astype(float), "var": np.where(n >= 2, np.maximum(t2 - t1 * t1 / n, 0) / (n - 1), np.nan).astype(float),
               "max": np.where(n >= 1, top, np.nan), "min": np.where(n >= 1, -bottom, np.nan)}
        if slope:
            out["slope"] = np.where(n >= 2, (qs - q1 * t1 / n) / (q2 - q1 * q1 / n), np.nan).astype(float)
        return out


def windowed(us: np.ndarray, x: np.ndarray, starts: np.ndarray, at: np.ndarray, sensors: Sequence[str]) -> dict[str, np.ndarray]:
    """Rolling columns of the rows ``at``; ``us`` ascends in each series, whose first row ``starts`` marks, ``x`` has a column per sensor, NaN is missing."""
    out, sums = {}, None
    step = np.diff(us, prepend=us[:1])
    step[starts] = HORIZON_US
    time = np.cumsum(np.minimum(step, HORIZON_US))  # one axis for all series: a gap as long as the longest window parts rows like any longer one
    hi = np.searchsorted(time, time[at], side="right")  # rows of the same time belong to the window
    with np.errstate(all="ignore"):
        for span in SPANS:
            lo = np.searchsorted(time, time[at] - parse_span_us(span), side="right")
            few = hi - lo <= DIRECT
            made = side_by_side(x, lo[few], hi[few], span == SLOPE_SPAN)
            if not few.all():
                sums = sums or _Sums(x, starts)
                long = sums.stats(lo[~few], hi[~few], span == SLOPE_SPAN)
                whole = {c: np.empty((len(at), len(sensors))) for c in made}
                for c, v in whole.items():
                    v[few], v[~few] = made[c], long[c]
                made = whole
            if span in ROLLING_SPANS:
                stats = {"mean": made["mean"], "std": np.sqrt(made["var"]), "var": made["var"], "max": made["max"], "min": made["min"], "range": made["max"] - made["min"]}
                out |= {f"{s}_rolling_{stat}_{span}": v[:, j] for stat, v in stats.items() for j, s in enumerate(sensors)}
            if span == SLOPE_SPAN:
                out |= {f"{s}_rolling_slope_{span}": made["slope"][:, j] for j, s in enumerate(sensors)}
    return out


def filled(x: np.ndarray, begin: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A column carried forward over its NaN, from ``before`` (of each row's series) on."""
    missing = np.isnan(x)
    if not missing.any():
        return x
    last = np.maximum.accumulate(np.where(missing, -1, np.arange(len(x))))
    return np.where(last >= begin, x[np.maximum(last, 0)], before)


def ema_after(x: np.ndarray, begin: np.ndarray, alpha: float, y: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """EMA (adjust=False, NaN as missing) of each row's series after an EMA ``y`` (NaN: none) that is ``gap`` rows without a value old."""
    at, seen = np.arange(len(x)), ~np.isnan(x)
    last = np.maximum.accumulate(np.where(seen, at, -1))
    before = np.concatenate([[-1], last[:-1]])
    inside = before >= begin
    warm = inside | ~np.isnan(y)
    w = (1.0 - alpha) ** np.where(inside, at - before, at - begin + 1 + gap).astype(float)
    c = np.where(seen, np.where(warm, w / (w + alpha), 0.0), 1.0)
    b = np.where(seen, (1.0 - c) * np.where(seen, x, 0.0), 0.0)
    first = at == begin
    b = np.where(first & warm & (c != 0), b + c * np.where(np.isnan(y), 0.0, y), b)
    c[first] = 0.0
    step = 1
    while step < len(x) and c.any():
        b[step:] += np.where(c[step:] != 0, c[step:] * b[:-step], 0.0)  # 0 times an infinity of another series is no number
        c[step:] *= c[:-step]
        step *= 2
    return np.where((last >= begin) | ~np.isnan(y), b, np.nan)


class Release:
    """Feature rows of some entities' readings, with the state they leave."""

    def __init__(self, sensors: Sequence[str]):
        self.sensors, self.pairs = list(sensors), interactions_of(sensors)
        self.names = feature_names(sensors)
        self.inter = [f"{a}_{b}" for a, b, _ in self.pairs]
        self.deltas = [f"{s}_delta_mean_1h_6h" for s in self.sensors]
        self.zeroed = [c for c in self.names if is_filled_then_zero(c)]
        self.carried = [*self.zeroed, *self.inter, *self.sensors, *self.deltas]
        k = len(self.sensors)
        self.width = {"gap": k, "ema": k * len(EMA_SPANS), "lags": 2 * k, "fill": len(self.carried), "past_x": k, "wait_x": k}

    def empty(self, series: int = 1) -> dict[str, np.ndarray]:
        """State of ``series`` entities that have not begun."""
        st = {c: np.full((series if c in SERIES else 0, *([self.width[c]] if c in self.width else [])), np.nan if c in _DOUBLE else 0, dtype=float if c in _DOUBLE else np.int64)
              for c in (*SERIES, *PAST, *WAIT)}
        st["last_failure"][:] = NEVER
        return st

    def series(self, st: dict, of: np.ndarray, us: np.ndarray, failure: np.ndarray, x: np.ndarray, idle_us: int) -> np.ndarray:
        """``rows`` of the entities numbered ``of``, ascending, each anew after every gap of more than ``idle_us``, whether or not its state was
        removed meanwhile."""
        entity = np.diff(of, prepend=-1) != 0
        before = np.concatenate([us[:1], us[:-1]])
        before[entity] = np.where(st["n"][of[entity]] > 0, st["last_us"][of[entity]], us[entity])
        anew = us - before > idle_us
        starts = entity | anew
        own, number = of[starts], np.cumsum(starts) - 1
        begun = self.empty(len(own))
        goes_on = ~anew[starts]
        for c in SERIES:
            begun[c][goes_on] = st[c][own[goes_on]]
        first = np.full(len(st["n"]), -1)
        first[own[goes_on]] = np.flatnonzero(goes_on)
        of_past = first[st["past_of"]]
        begun |= {"past_of": of_past[of_past >= 0], "past_us": st["past_us"][of_past >= 0], "past_x": st["past_x"][of_past >= 0]}
        out = self.rows(begun, us, failure, x, number)
        last = np.concatenate([own[1:] != own[:-1], [True]])
        for c in SERIES:
            st[c][own[last]] = begun[c][last]
        seen = np.zeros(len(st["n"]), bool)
        seen[own] = True
        rest, new = ~seen[st["past_of"]], last[begun["past_of"]]
        of_past = np.concatenate([st["past_of"][rest], own[begun["past_of"][new]]])
        order = np.argsort(of_past, kind="stable")
        st |= {"past_of": of_past[order]} | {c: np.concatenate([st[c][rest], begun[c][new]])[order] for c in ("past_us", "past_x")}
        return out

    def rows(self, st: dict, us: np.ndarray, failure: np.ndarray, x: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        """Features (columns ``names``) of the readings of series ``of``, ascending (default: one), in order, all behind those in ``st``, which is
        brought up to date.  Every series of ``st`` has readings."""
        of = np.zeros(len(us), dtype=np.int64) if of is None else of
        at = np.arange(len(us))
        starts = np.diff(of, prepend=-1) != 0
        begin, end = first_rows(starts), np.concatenate([np.flatnonzero(starts)[1:], [len(us)]]) - 1
        place, held = at - begin, len(st["past_us"])
        order = np.argsort(np.concatenate([st["past_of"], of]), kind="stable")
        all_of, all_us, all_x = np.concatenate([st["past_of"], of])[order], np.concatenate([st["past_us"], us])[order], np.vstack([st["past_x"], x])[order]
        f = windowed(all_us, all_x, np.diff(all_of, prepend=-1) != 0, np.flatnonzero(order >= held), self.sensors)
        rate, count = {}, end - np.flatnonzero(starts) + 1
        for j, s in enumerate(self.sensors):
            v, two, one = x[:, j], st["lags"][of, j], st["lags"][of, len(self.sensors) + j]
            f[s] = v
            f[f"{s}_lag_1"] = np.where(place >= 1, v[np.maximum(at - 1, 0)], one)
            f[f"{s}_lag_2"] = np.where(place >= 2, v[np.maximum(at - 2, 0)], np.where(place == 1, one, two))
            rate[f"{s}_roc_1"] = v - f[f"{s}_lag_1"]
            st["lags"][:, j], st["lags"][:, len(self.sensors) + j] = f[f"{s}_lag_1"][end], v[end]
            f[f"{s}_delta_mean_1h_6h"] = f[f"{s}_rolling_mean_1h"] - f[f"{s}_rolling_mean_6h"]
            for e, span in enumerate(EMA_SPANS):
                i = j * len(EMA_SPANS) + e
                f[f"{s}_ema_{span}"] = ema_after(v, begin, 2.0 / (span + 1.0), st["ema"][of, i], st["gap"][of, j])
                st["ema"][:, i] = f[f"{s}_ema_{span}"][end]
            known = np.maximum.accumulate(np.where(np.isnan(v), -1, at))[end]
            st["gap"][:, j] = np.where(known >= begin[end], end - known, st["gap"][:, j] + count)
        for a, b, op in self.pairs:
            f[f"{a}_{b}"] = f[a] * f[b] if op == "mul" else f[a] / (f[b] + RATIO_EPSILON)
        # a failure at a row's own time counts, also if it comes after the row
        tied = np.flatnonzero(np.concatenate([starts[1:] | (us[1:] != us[:-1]), [True]]))
        failed = np.maximum.accumulate(np.where(failure == 1, at, -1))[tied[np.searchsorted(tied, at)]]
        last = np.where(failed >= begin, us[np.maximum(failed, 0)], st["last_failure"][of])
        rate["hours_since_last_failure"] = np.where(last != NEVER, (us - np.where(last != NEVER, last, us)) / float(HOUR_US), NO_FAILURE_HOURS)
        made = np.empty((len(us), len(self.names)), order="F")
        place_of = {c: i for i, c in enumerate(self.names)}
        for i, c in enumerate(self.carried):
            whole = filled(f[c], begin, st["fill"][of, i])
            st["fill"][:, i] = whole[end]
            made[:, place_of[c]] = np.where(np.isnan(whole), 0.0, whole) if i < len(self.zeroed) else whole
        for c, v in rate.items():
            made[:, place_of[c]] = np.where(np.isnan(v), 0.0, v) if c.endswith("_roc_1") else v
        keep = all_us > us[end][all_of] - HORIZON_US
        st |= {"past_of": all_of[keep], "past_us": all_us[keep], "past_x": all_x[keep], "n": st["n"] + count, "last_us": us[end], "last_failure": last[end]}
        return made


def pieces(of: np.ndarray, us: np.ndarray, rows: int = PIECE) -> Iterator[slice]:
    """Cuts readings in (entity, time) order into pieces of about ``rows``; those of one entity and time stay together."""
    cuts = np.flatnonzero((of[1:] != of[:-1]) | (us[1:] != us[:-1])) + 1
    at = 0
    while at < len(of):
        i = int(np.searchsorted(cuts, at + rows))
        to = int(cuts[i]) if i < len(cuts) else len(of)
        yield slice(at, to)
        at = to


def _released(schema: T.StructType, sensors: Sequence[str], idle_us: int):
    """Rows leave as ``schema``."""
    epoch = np.datetime64("1970-01-01T00:00:00", "us")
    work, key_type, integral = Release(sensors), to_arrow_type(schema.fields[0].dataType), isinstance(schema.fields[0].dataType, T.IntegralType)
    key_schema = pa.schema([("key", key_type)])

    def loaded(values: tuple) -> tuple[dict, pa.Array]:
        st = {}
        for c, v in zip((*SERIES, *PAST, *WAIT), values[1:]):
            st[c] = np.frombuffer(v, dtype=float if c in _DOUBLE else np.int64).reshape(-1, *([work.width[c]] if c in work.width else [])).copy()
        return st, pa.ipc.read_record_batch(pa.py_buffer(values[0]), key_schema).column(0)

    def stored(st: dict, keys: pa.Array) -> tuple:
        return (pa.RecordBatch.from_arrays([keys], schema=key_schema).serialize().to_pybytes(), *(np.ascontiguousarray(st[c]).tobytes() for c in (*SERIES, *PAST, *WAIT)))

    def arrived(st: dict, keys: pa.Array, new: pd.DataFrame) -> pa.Array:
        """``new`` joins the waiting readings; entities that were not known get the next numbers."""
        mine = pa.array(new["_key"], type=key_type, mask=new["_none"].to_numpy(bool))
        coded = pc.dictionary_encode(pa.concat_arrays([keys, mine]), null_encoding="encode")
        for c, v in work.empty(len(coded.dictionary) - len(keys)).items():
            if c in SERIES:
                st[c] = np.concatenate([st[c], v])
        x = np.column_stack([new[s].to_numpy(dtype=float, na_value=np.nan) for s in sensors])
        for c, v in zip(WAIT, (coded.indices.to_numpy()[len(keys):], new["_us"].to_numpy(np.int64), new["row_id"].to_numpy(np.int64), new["failure"].fillna(0).to_numpy(np.int64), x)):
            st[c] = np.concatenate([st[c], v.astype(st[c].dtype, copy=False)])
        return coded.dictionary

    def func(key: tuple, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        st, keys = loaded(state.get) if state.exists else (work.empty(0), pa.array([], key_type))
        now = state.getCurrentWatermarkMs() * 1000
        if not state.hasTimedOut:
            parts = list(chunks)
            keys = arrived(st, keys, parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True))
        ready = st["wait_us"] <= now
        if ready.any():
            order = np.flatnonzero(ready)[np.lexsort((st["wait_row"][ready], st["wait_us"][ready], st["wait_of"][ready]))]
            of, us, row, failure, x = (st[c][order] for c in WAIT)
            st |= {c: st[c][~ready] for c in WAIT}
            for at in pieces(of, us):
                with np.errstate(all="ignore"):
                    out = work.series(st, of[at], us[at], failure[at], x[at], idle_us)
                whole = ~np.isnan(out).any(axis=1)
                if whole.any():
                    frame = pd.DataFrame(out if whole.all() else np.asfortranarray(out[whole]), columns=work.names, copy=False)
                    own = keys.take(pa.array(of[at][whole]))
                    told = pd.arrays.IntegerArray(own.fill_null(0).to_numpy(), own.is_null().to_numpy(zero_copy_only=False)) if integral else own.to_pandas()
                    told = (told, row[at][whole], epoch + us[at][whole].astype("timedelta64[us]"), failure[at][whole].astype(np.int32))
                    for i, (name, v) in enumerate(zip(schema.names, told)):
                        frame.insert(i, name, v)
                    yield frame
        waits = np.zeros(len(keys), bool)
        waits[st["wait_of"]] = True
        alive = waits | (st["last_us"] + idle_us >= now)
        if not alive.all():
            number = np.cumsum(alive) - 1
            past = alive[st["past_of"]]
            st |= {c: st[c][alive] for c in SERIES} | {c: st[c][past] for c in PAST}
            st |= {"past_of": number[st["past_of"]], "wait_of": number[st["wait_of"]]}
            keys, waits = keys.filter(pa.array(alive)), waits[alive]
        if not len(keys):
            state.remove()
            return
        state.update(stored(st, keys))
        due = min([*st["wait_us"].min(initial=np.iinfo(np.int64).max, keepdims=True), *(st["last_us"][~waits] + idle_us)])
        state.setTimeoutTimestamp(max(int(due) // 1000, now // 1000 + 1))

    return func


def stream_features(readings: DataFrame, sensors: Sequence[str] = SENSORS, key: str = "entity_id", delay: str = DELAY, idle: str = IDLE, buckets: int = BUCKETS) -> DataFrame:
    """A stream of readings (``key``, row_id, ts, sensors, failure) -> key, row_id, ts, failure and the feature columns."""
    kind = readings.schema[key].dataType
    schema = output_schema(sensors, key, kind)
    us = ts_micros("ts")
    ets = F.timestamp_micros(us)  # watermarks need an instant: the wall clock read as UTC, whatever the session's zone
    whole = F.coalesce(key, F.lit(0).cast(kind)) if isinstance(kind, T.IntegralType) else F.col(key)  # pandas has no null among integers
    rows = readings.where(F.col("ts").isNotNull()).select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket"), whole.alias("_key"), F.col(key).isNull().alias("_none"),
                                                          "row_id", us.alias("_us"), "failure", *sensors, ets.alias("ets")).withWatermark("ets", delay)
    idle_us = int(pd.Timedelta(idle) / pd.Timedelta(microseconds=1))
    return rows.groupBy("_bucket").applyInPandasWithState(_released(schema, list(sensors), idle_us), schema, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
