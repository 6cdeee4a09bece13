"""The reference's 82-feature table, built as one lazy plan.

Order of work as in the reference: per sensor EMA, lags, rate of change, rolling statistics and slope;
pairwise interactions; 1h-6h mean deltas; hours since the last failure; then the null policy
(lag / rolling / EMA columns forward-filled then 0, rate of change 0, everything else forward-filled,
rows still holding a null dropped).  Train and validation are separate series when ``split_col`` is
given, so validation windows start cold as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from raretide.functions.scalar import interaction_columns, interaction_names, interactions_of
from raretide.operators.scan import DEFAULT_BLOCK_ROWS, DEFAULT_BUCKET_US, by_length, carry_last
from raretide.operators.series import series_features
from raretide.operators.windows import (EMA_SPANS, LAGS, NO_FAILURE_HOURS, ROLLING_SPANS, SLOPE_SPAN, ema_features, hours_since_last_failure,
                                        lag_features, rolling_features, with_order)

SENSORS = ["temperature", "vibration", "pressure"]
NON_FEATURES = ("ts", "timestamp", "failure", "failure_24h")


def feature_names(sensors: Sequence[str] = SENSORS, spans: Sequence[str] = ROLLING_SPANS,
                  ema_spans: Sequence[int] = EMA_SPANS, lags: Sequence[int] = LAGS,
                  interactions: Sequence[str] | None = None) -> list[str]:
    """Lexicographically sorted feature names (the model's column contract)."""
    names = list(sensors)
    for s in sensors:
        for span in spans:
            names += [f"{s}_rolling_{st}_{span}" for st in ("mean", "std", "var", "max", "min", "range")]
        names += [f"{s}_ema_{e}" for e in ema_spans] + [f"{s}_lag_{k}" for k in lags]
        names += [f"{s}_roc_1", f"{s}_rolling_slope_{SLOPE_SPAN}", f"{s}_delta_mean_1h_6h"]
    names += list(interactions if interactions is not None else interaction_names(interactions_of(sensors)))
    names.append("hours_since_last_failure")
    return sorted(names)


def is_filled_then_zero(name: str) -> bool:
    return "_lag_" in name or "rolling_" in name or "ema_" in name


def build_features(df: DataFrame, keys: Sequence[str] = ("entity_id",), sensors: Sequence[str] = SENSORS,
                   split_col: str | None = None, ts: str = "ts", tiebreak: str | None = "row_id",
                   block_rows: int = DEFAULT_BLOCK_ROWS, bucket_us: int = DEFAULT_BUCKET_US,
                   drop_incomplete: bool = True, only: Sequence[str] | None = None, one_pass: bool = False) -> DataFrame:
    """All features of ``create_time_series_features`` for every series ``keys`` (+ ``split_col``), or the features
    ``only``: operators that none of them needs do not run.

    Output: the input columns, then the feature columns; row order is not defined.  Rows that hold a null in the full
    table are dropped in either case: those before a series' first complete reading.

    Series of at most ``block_rows`` rows, nearly all as a rule, are made whole: two shuffles of narrow rows, then all windows in
    one pass.  Longer ones are cut into pieces with summaries.  Which sensors miss values is counted first, as most
    columns of a sensor without gaps have nothing to fill.  With ``one_pass`` whole series of double sensors get all their columns in one pass
    over Arrow batches (``series``): the same values, without windows over wide rows; other series and sensors are made as without it.
    """
    pkeys = list(keys) + ([split_col] if split_col else [])
    every = feature_names(sensors)
    feats = every if only is None else [c for c in only]
    if unknown := set(feats) - set(every):
        raise ValueError(f"unknown features: {sorted(unknown)}")
    counts = df.agg(*[F.count_if(F.col(s).isNull()) for s in sensors]).first()
    gaps = {s for s, n in zip(sensors, counts) if n}
    return by_length(df, pkeys, block_rows, lambda part, whole: _features_of(part, pkeys, sensors, feats, gaps, ts, tiebreak, block_rows, bucket_us, whole, drop_incomplete, one_pass))


def _features_of(df: DataFrame, pkeys: list[str], sensors: Sequence[str], feats: list[str], gaps: set[str], ts: str, tiebreak: str | None,
                 block_rows: int, bucket_us: int, whole: bool, drop_incomplete: bool, one_pass: bool) -> DataFrame:
    """The input columns but for the sensors, and ``feats``, filled; ``gaps`` are the sensors that miss values somewhere."""
    d = with_order(df, pkeys, ts, tiebreak, bucket_us, whole)
    # the as-of scan needs only keys, time and failure: run it while the table is still narrow
    if "hours_since_last_failure" in feats:
        d = hours_since_last_failure(d, pkeys, bucket_us=bucket_us, whole=whole)

    def of(mark: str) -> list[str]:
        return [s for s in sensors if any(c.startswith(f"{s}_") and mark in c for c in feats)]

    deltas = of("_delta_mean")
    rolled = {c for c in feats if "_rolling_" in c} | {f"{s}_rolling_mean_{h}" for s in deltas for h in ("1h", "6h")}
    smooth = of("_ema_")
    steps = [s for s in sensors if s in of("_lag_") or s in of("_roc_")]
    inter = interaction_columns(interactions_of(sensors))
    zero_after_fill = [c for c in feats if is_filled_then_zero(c)]
    # raw sensors and interactions decide which rows are complete, so they are filled in any case
    fill_only = [*inter, *sensors, *(f"{s}_delta_mean_1h_6h" for s in deltas)]
    # without a gap a window has its own row's value, an EMA begins with the series and a lag misses only its first rows
    filled = [c for c in zero_after_fill + fill_only if c in inter or any(c == s or c.startswith(f"{s}_") for s in gaps)
              or any(f"_rolling_{st}_" in c for st in ("std", "var", "slope"))]
    kept = [c for c in df.columns if c not in sensors]
    needed = [*kept, *inter, *sensors, *feats] if drop_incomplete else []
    if one_pass and whole and (smooth or steps or rolled) and all(isinstance(df.schema[s].dataType, DoubleType) for s in sensors):
        return series_features(d.withColumns(inter), pkeys, sensors, smooth, steps, rolled, deltas, filled, zero_after_fill, [*kept, *feats], needed)
    if smooth:
        d = ema_features(d, pkeys, smooth, EMA_SPANS, block_rows, whole)
    # lags, rolling windows and fills of whole series share one order: rows are sorted once, while they are narrow
    if steps:
        d = lag_features(d, pkeys, steps, LAGS, block_rows, whole)
    if rolled:
        d = rolling_features(d, pkeys, sensors, bucket_us=bucket_us, only=rolled, whole=whole)
    d = d.withColumns(inter)
    d = d.withColumns({f"{s}_delta_mean_1h_6h": F.col(f"{s}_rolling_mean_1h") - F.col(f"{s}_rolling_mean_6h") for s in deltas})
    d = d.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in (f"{s}_roc_1" for s in steps)})
    d = carry_last(d, pkeys, "rn", filled, block_rows=block_rows, total="_n", whole=whole, sorted_by=["_us"])
    d = d.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in zero_after_fill})
    return (d.na.drop(how="any", subset=needed) if drop_incomplete else d).select(*kept, *feats)


def single_reading_features(df: DataFrame, sensors: Sequence[str] = SENSORS) -> DataFrame:
    """The features of readings that have no history, each a series of one row: column expressions only.

    What ``build_features`` gives for a series with a single reading, as the online path does for a request; rows that miss a
    sensor are dropped."""
    names = feature_names(sensors)
    same = {c: F.col(s).cast("double") for s in sensors for c in names if c.startswith(f"{s}_")
            and ("_ema_" in c or any(f"_rolling_{st}_" in c for st in ("mean", "max", "min")))}
    same |= {s: F.col(s).cast("double") for s in sensors} | interaction_columns(interactions_of(sensors))
    same["hours_since_last_failure"] = F.lit(NO_FAILURE_HOURS)
    rest = [c for c in df.columns if c not in sensors]
    return df.na.drop(subset=list(sensors)).select(*rest, *[same.get(c, F.lit(0.0)).alias(c) for c in names])
