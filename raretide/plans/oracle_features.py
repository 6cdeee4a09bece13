"""SQL twin of ``build_features`` for the DuckDB oracle: plain global windows per series, the EMA as a
recursive CTE (the reference's recurrence, null rule included), and the fill policy with
``last_value(... IGNORE NULLS)``."""

from __future__ import annotations

from raretide.operators.features import feature_names
from raretide.operators.windows import EMA_SPANS, LAGS, ROLLING_SPANS

_FRAME = {"1h": "INTERVAL '59 minutes 59.999999 seconds'",
          "6h": "INTERVAL '5 hours 59 minutes 59.999999 seconds'",
          "12h": "INTERVAL '11 hours 59 minutes 59.999999 seconds'"}


def _zero_after_fill(name: str) -> bool:
    return "_lag_" in name or "rolling_" in name or "ema_" in name


def features_sql(src: str, pkeys: list[str], sensors: list[str], order_tiebreak: str | None,
                 carry_cols: list[str]) -> str:
    """CTEs ``fbase`` .. ``feat`` over CTE ``src``; ``feat`` has ``carry_cols`` + all features."""
    part = ("PARTITION BY " + ", ".join(pkeys)) if pkeys else ""
    order = "ORDER BY ts" + (f", {order_tiebreak}" if order_tiebreak else "")
    on = " AND ".join([f"b.{k} IS NOT DISTINCT FROM r.{k}" for k in pkeys] + ["b.rn = r.rn + 1"])
    keysel_b = "".join(f"b.{k}, " for k in pkeys)
    keysel = "".join(f"{k}, " for k in pkeys)
    ctes = [f"fbase AS (SELECT *, row_number() OVER ({part} {order}) AS rn FROM {src})"]
    # EMA recursion
    init, step = [], []
    for s in sensors:
        for sp in EMA_SPANS:
            a = f"{2.0 / (sp + 1.0)!r}::DOUBLE"
            y, w = f"y_{s}_{sp}", f"w_{s}_{sp}"
            init += [f"{s} AS {y}", f"1.0::DOUBLE AS {w}"]
            step += [f"CASE WHEN r.{y} IS NULL THEN b.{s} WHEN b.{s} IS NULL THEN r.{y} "
                     f"ELSE ((r.{w} * (1 - {a})) * r.{y} + {a} * b.{s}) / ((r.{w} * (1 - {a})) + {a}) END",
                     f"CASE WHEN r.{y} IS NULL THEN 1.0::DOUBLE WHEN b.{s} IS NULL THEN r.{w} * (1 - {a}) "
                     f"ELSE 1.0::DOUBLE END"]
    ctes.append(f"""ema AS (SELECT {keysel}rn, {', '.join(init)} FROM fbase WHERE rn = 1
  UNION ALL
  SELECT {keysel_b}b.rn, {', '.join(step)} FROM ema r JOIN fbase b ON {on})""")
    # windows
    cols = []
    for s in sensors:
        for span in ROLLING_SPANS:
            fr = f"OVER ({part} ORDER BY ts RANGE BETWEEN {_FRAME[span]} PRECEDING AND CURRENT ROW)"
            cols += [f"avg({s}) {fr} AS {s}_rolling_mean_{span}",
                     f"CASE WHEN count({s}) {fr} >= 2 THEN stddev_samp({s}) {fr} END AS {s}_rolling_std_{span}",
                     f"CASE WHEN count({s}) {fr} >= 2 THEN var_samp({s}) {fr} END AS {s}_rolling_var_{span}",
                     f"max({s}) {fr} AS {s}_rolling_max_{span}", f"min({s}) {fr} AS {s}_rolling_min_{span}",
                     f"max({s}) {fr} - min({s}) {fr} AS {s}_rolling_range_{span}"]
        fr6 = f"OVER ({part} ORDER BY ts RANGE BETWEEN {_FRAME['6h']} PRECEDING AND CURRENT ROW)"
        cols.append(f"CASE WHEN count({s}) {fr6} >= 2 THEN regr_slope({s}, rn::DOUBLE) {fr6} END AS {s}_rolling_slope_6h")
        for k in LAGS:
            cols.append(f"lag({s}, {k}) OVER ({part} ORDER BY rn) AS {s}_lag_{k}")
        cols.append(f"{s} - lag({s}, 1) OVER ({part} ORDER BY rn) AS {s}_roc_1")
    cols.append(f"max(CASE WHEN failure = 1 THEN ts END) OVER ({part} ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING "
                f"AND CURRENT ROW) AS _lf")
    ctes.append(f"fwin AS (SELECT *, {', '.join(cols)} FROM fbase)")
    ema_cols = ", ".join(f"e.y_{s}_{sp} AS {s}_ema_{sp}" for s in sensors for sp in EMA_SPANS)
    join_on = " AND ".join([f"e.{k} IS NOT DISTINCT FROM w.{k}" for k in pkeys] + ["e.rn = w.rn"])
    extra = [
        "w.temperature * w.vibration AS temperature_vibration",
        "w.temperature / (w.pressure + 1e-9::DOUBLE) AS temperature_pressure",
        "w.vibration * w.pressure AS vibration_pressure",
        *[f"w.{s}_rolling_mean_1h - w.{s}_rolling_mean_6h AS {s}_delta_mean_1h_6h" for s in sensors],
        "coalesce((epoch_us(w.ts) - epoch_us(w._lf)) / 3600000000.0, 9999.0) AS hours_since_last_failure",
    ]
    ctes.append(f"fpre AS (SELECT w.*, {ema_cols}, {', '.join(extra)} FROM fwin w JOIN ema e ON {join_on})")
    feats = feature_names(sensors)
    fills = []
    for c in feats:
        lv = f"last_value({c} IGNORE NULLS) OVER ({part} ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        if c.endswith("_roc_1"):
            fills.append(f"coalesce({c}, 0.0) AS {c}")
        elif c == "hours_since_last_failure":
            fills.append(c)
        elif _zero_after_fill(c):
            fills.append(f"coalesce({lv}, 0.0) AS {c}")
        else:
            fills.append(f"{lv} AS {c}")
    ctes.append(f"ffill AS (SELECT {', '.join(carry_cols)}, {', '.join(fills)} FROM fpre)")
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in feats + carry_cols)
    ctes.append(f"feat AS MATERIALIZED (SELECT * FROM ffill WHERE {notnull})")
    return ",\n".join(ctes)
