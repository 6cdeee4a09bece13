"""Row-level column expressions (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's decisions.
ALERT_THRESHOLD = 0.3          # decision ALERT when p >= 0.3 (inclusive)
RISK_THRESHOLD = 0.5           # decision high_risk when p > 0.5 (strict)
RATIO_EPSILON = 1e-9           # temperature / (pressure + 1e-9)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num / den, ``default`` when den is 0 or NULL (ANSI-safe)."""
    q = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def threshold_predict(score: str | Column, t: float | Column) -> Column:
    """1 when score >= t (inclusive), else 0."""
    tc = t if isinstance(t, Column) else F.lit(float(t))
    return (_c(score) >= tc).cast("int")


def decision_alert(p: str | Column, threshold: float = ALERT_THRESHOLD) -> Column:
    return F.when(_c(p) >= F.lit(threshold), F.lit("ALERT")).otherwise(F.lit("SAFE"))


def decision_risk(p: str | Column, threshold: float = RISK_THRESHOLD) -> Column:
    return F.when(_c(p) > F.lit(threshold), F.lit("high_risk")).otherwise(F.lit("low_risk"))


def round_response(p: str | Column, digits: int = 4) -> Column:
    return F.round(_c(p), digits)


def iso_time(ts: str | Column) -> Column:
    """A time without zone as ISO 8601 text with microseconds."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def clean_double(c: str | Column) -> Column:
    """NaN -> NULL (Spark aggregates skip NULL but propagate NaN)."""
    x = _c(c).cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


DEFAULT_INTERACTIONS = [("temperature", "vibration", "mul"), ("temperature", "pressure", "ratio"),
                        ("vibration", "pressure", "mul")]


def interactions_of(sensors) -> list[tuple[str, str, str]]:
    """The default interactions between the given sensors."""
    return [p for p in DEFAULT_INTERACTIONS if p[0] in sensors and p[1] in sensors]


def interaction_names(pairs: list[tuple[str, str, str]] | None = None) -> list[str]:
    return [f"{a}_{b}" for a, b, _ in (DEFAULT_INTERACTIONS if pairs is None else pairs)]


def interaction_columns(pairs: list[tuple[str, str, str]] | None = None) -> dict[str, Column]:
    """Pairwise sensor interactions.  Each pair is (left, right, op) with op 'mul' or 'ratio'.

    The default reproduces the reference: temperature*vibration, temperature/(pressure+1e-9)
    (named temperature_pressure although it is a ratio), vibration*pressure.
    """
    pairs = DEFAULT_INTERACTIONS if pairs is None else pairs
    out = {}
    for a, b, op in pairs:
        if op == "mul":
            out[f"{a}_{b}"] = F.col(a) * F.col(b)
        elif op == "ratio":
            out[f"{a}_{b}"] = F.col(a) / (F.col(b) + F.lit(RATIO_EPSILON))
        else:
            raise ValueError(f"unknown interaction op {op!r}")
    return out


def fmt_fixed(x: Column, digits: int) -> Column:
    """Non-negative number as text with ``digits`` decimals, rounding half up on the double value.

    Integer arithmetic on floor(x * 10^d + 0.5), so every engine renders the same text."""
    scale = 10 ** digits
    r = F.floor(x * F.lit(float(scale)) + F.lit(0.5)).cast("long")
    whole = F.floor(r / F.lit(scale)).cast("long").cast("string")
    if digits == 0:
        return whole
    return F.concat(whole, F.lit("."), F.lpad(F.pmod(r, F.lit(scale)).cast("string"), digits, "0"))


def literal_table(spark, rows: list[tuple], names: list[str]):
    """A small parameter table (thresholds, k values, targets) as a JVM-side local relation."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
